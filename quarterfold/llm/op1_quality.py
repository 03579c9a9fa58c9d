"""Quality classifier: histogram gradient-boosted trees over statistics of the text.

Trees are fitted on a bounded sample of labelled rows (``labelled.SAMPLE``), of which only the statistics
reach the driver, and sent to the tasks as flat arrays; a batch of documents is scored by numpy at once.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterfold.llm import boost, labelled
from quarterfold.llm.common import table, text_of

MODULUS, HELD_OUT = 3, 1
FEATURES = (
    "log_bytes", "log_words", "mean_word", "longest_word", "distinct_words", "top_word", "repeated_pairs", "upper", "digits",
    "marks", "symbols", "spaces", "beyond_ascii", "odd_words", "word_ends", "log_lines", "mean_line", "repeated_lines",
    "stops", "packed",
)
_SPLIT = re.compile(r"[^\x20\x09-\x0D]+")
_PLAIN = re.compile(r"[^\W\d_]+[.,;:!?]?")


def _classes() -> np.ndarray:
    """For each byte: 0 other, 1 upper case, 2 digit, 3 mark of prose, 4 symbol, 5 white space, 6 beyond ASCII."""
    kind = np.zeros(256, dtype=np.int64)
    kind[ord("A") : ord("Z") + 1], kind[ord("0") : ord("9") + 1] = 1, 2
    for chars, k in ((".,;:!?'\"()-", 3), ("#$%&*+/<=>@[\\]^_`{|}~", 4), (" \t\n\r\v\f", 5)):
        kind[[ord(c) for c in chars]] = k
    kind[128:] = 6
    return kind


KIND = _classes()


def statistics(text: str) -> list[float]:
    """FEATURES of a whole text. An empty text has zeros."""
    data = text.encode("utf-8", "replace")
    if not data:
        return [0.0] * len(FEATURES)
    by_byte = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    by_kind = np.bincount(KIND, by_byte, 7) / len(data)
    words = _SPLIT.findall(text)
    n = max(len(words), 1)
    counts = Counter(words)
    pairs = Counter(zip(words, words[1:]))
    lines = [x for x in text.split("\n") if x.strip()]
    return [
        np.log1p(len(data)), np.log1p(len(words)), sum(map(len, words)) / n, max(map(len, words), default=0),
        len(counts) / n, max(counts.values(), default=0) / n, 1 - len(pairs) / max(len(words) - 1, 1),
        by_kind[1], by_kind[2], by_kind[3], by_kind[4], by_kind[5], by_kind[6],
        sum(c for w, c in counts.items() if not _PLAIN.fullmatch(w)) / n,
        sum(c for w, c in counts.items() if w[-1] in ".!?") / n,
        np.log1p(len(lines)), len(text) / max(len(lines), 1), 1 - len(set(lines)) / max(len(lines), 1),
        (by_byte[ord(".")] + by_byte[ord("!")] + by_byte[ord("?")]) / n, len(zlib.compress(data, 1)) / len(data),
    ]


def table_of(texts: pa.Array) -> np.ndarray:
    return np.array([statistics(t.as_py() or "") for t in texts], dtype=float).reshape(-1, len(FEATURES))


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = table_of(batch.column("text"))
        yield pa.RecordBatch.from_arrays([pa.array(list(values), pa.list_(pa.float64())), batch.column("label")], names=["f", "label"])


def train(docs: DataFrame, labels: DataFrame) -> tuple[list[np.ndarray], boost.Trees]:
    """Bin edges and trees. At most about ``labelled.SAMPLE`` rows of numbers come to the driver."""
    rows = labelled.with_labels(docs, labelled.sample(labels, "quality", MODULUS, HELD_OUT))
    got = rows.mapInArrow(_measured, "f array<double>, label int").toPandas()
    values = np.array(got["f"].tolist(), dtype=float).reshape(-1, len(FEATURES))
    order = np.lexsort(values.T)  # so that the result doesn't depend on the order of rows
    values, y = values[order], got["label"].to_numpy(float)[order]
    cuts = boost.edges(values) if len(values) else [np.zeros(0)] * len(FEATURES)
    return cuts, boost.fit(boost.binned(values, cuts), y)


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``. labels: doc_id, quality.

    Rows whose crc32(doc_id as text) mod 3 is 1 are held out: their labels aren't learned from. The score depends on the
    text alone, a null one counts as empty; repeated rows get equal scores. Without labels every score is one half.
    """
    cuts, trees = train(docs, labels)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = boost.sigmoid(trees.margin(boost.binned(table_of(batch.column("text")), cuts)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"])

    held = (labelled.remainder(MODULUS) == HELD_OUT).alias("held_out")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held, text_of("text").alias("text"))
    return rows.mapInArrow(scored, "doc_id long, held_out boolean, score double, predicted int")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
