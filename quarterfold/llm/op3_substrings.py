"""Repeated passages by difference-cover anchors.

Runs of ANCHOR words are hashed only at positions whose remainder modulo PERIOD is in COVER. Every
difference modulo PERIOD is one between two members of COVER, so two equal windows of WINDOW words
share an anchor at the same offset, wherever they begin. Windows around an anchor that occurs twice
are candidates; extending the anchor to the whole window, its 128-bit hash is compared. So only
about a quarter of all positions is shuffled, and whole windows only near repeated anchors.

A task sends each anchor or window once, saying whether it has seen it twice itself, so a passage in
a third of all texts is one row for each task. Texts with the same words are one class, of which
one is searched.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quarterfold.llm import wordhash
from quarterfold.llm.common import table, text_of, written

WINDOW = 35
PERIOD = 21
COVER = (0, 1, 4, 14, 16)  # a perfect difference set modulo 21
ANCHOR = WINDOW - PERIOD + 1
HELD = 6_000_000  # rows that a task holds to find repeats among its own; beyond it begins anew
OUT = 1 << 16
NOTHING = hashlib.sha256(b"").hexdigest()


def stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of words, and the digest of the words joined by one space."""
    for batch in batches:
        counts, digests = [], []
        for text in batch.column("text"):
            found = (text.as_py() or "").encode().split()  # at ASCII white space
            counts.append(len(found))
            digests.append(hashlib.sha256(b" ".join(found)).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("key"), pa.array(counts, pa.int64()), pa.array(digests, pa.string())],
            names=["doc_id", "key", "n_words", "seq"])


def _sent(kept: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
    """Rows (h, g, key, pos, times): of those with one hash the first with times 1 or, if there are more, 2; the others have
    times 0, as they are known to be repeated and need no answer. Rows that weigh 2 from the start need none either."""
    h, g, key, pos, weight = (np.concatenate(x) for x in zip(*kept, strict=True))
    order = np.lexsort((g, h))
    h, g, key, pos, weight = h[order], g[order], key[order], pos[order], weight[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
    begins = np.flatnonzero(new)
    times = np.zeros(len(h), dtype=np.int32)
    if len(h):
        times[begins] = np.minimum(np.add.reduceat(weight, begins), 2)
    keep = (times > 0) | (weight == 1)
    columns = [x[keep] for x in (h.view(np.int64), g.view(np.int64), key, pos, times, weight)]
    for i in range(0, int(keep.sum()), OUT):
        yield pa.RecordBatch.from_arrays(
            [pa.array(x[i : i + OUT]) for x in columns], names=["h", "g", "key", "pos", "times", "weight"])


SENT = "h long, g long, key long, pos int, times int, weight int"


def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cover = np.zeros(PERIOD, dtype=bool)
    cover[list(COVER)] = True
    kept, held = [], 0
    for batch in batches:
        for begin, n in wordhash.pieces(batch, "text"):
            w = wordhash.words(batch.column("text").slice(begin, n))
            h = wordhash.runs(w.hashes(), ANCHOR)
            row, at = w.row[: len(h)], w.at[: len(h)]
            left = w.counts[row] - at
            i = np.flatnonzero(cover[at % PERIOD] & (left >= ANCHOR) & (w.counts[row] >= WINDOW))
            key = batch.column("key").slice(begin, n).to_numpy(zero_copy_only=False)[row[i]]
            kept.append((h[i], np.zeros(len(i), np.uint64), key, at[i].astype(np.int32), np.ones(len(i), np.int32)))
            held += len(i)
            if held > HELD:
                yield from _sent(kept)
                kept, held = [], 0
    if kept:
        yield from _sent(kept)


def _starts(positions: np.ndarray, n_words: int) -> np.ndarray:
    """Where windows begin that hold a whole anchor at one of ``positions``."""
    near = np.zeros(n_words + 1, dtype=np.int32)
    np.add.at(near, np.maximum(positions - (PERIOD - 1), 0), 1)
    np.add.at(near, positions + 1, -1)
    return np.flatnonzero(np.cumsum(near)[: max(n_words - WINDOW + 1, 0)] > 0)


def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kept, held = [], 0
    for batch in batches:
        for begin, n in wordhash.pieces(batch, "text"):
            part = batch.slice(begin, n)
            w = wordhash.words(part.column("text"))
            hashes = w.hashes()
            h, g = wordhash.runs(hashes, WINDOW, 0), wordhash.runs(hashes, WINDOW, 1)
            keys = part.column("key").to_numpy(zero_copy_only=False)
            weights = part.column("weight").to_numpy(zero_copy_only=False)
            for r, first in enumerate(w.first):
                at = _starts(np.asarray(part.column("positions")[r].values, dtype=np.int64), int(w.counts[r]))
                i = first + at
                kept.append((h[i], g[i], np.full(len(i), keys[r]), at.astype(np.int32), np.full(len(i), weights[r], np.int32)))
                held += len(i)
            if held > HELD:
                yield from _sent(kept)
                kept, held = [], 0
    if kept:
        yield from _sent(kept)


def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Removes the words of the windows that begin at ``positions``."""
    for batch in batches:
        removed, digests = [], []
        for text, at in zip(batch.column("text"), batch.column("positions"), strict=True):
            found = (text.as_py() or "").encode().split()
            gone = np.zeros(len(found) + 1, dtype=np.int32)
            at = np.asarray(at.values, dtype=np.int64)
            np.add.at(gone, at, 1)
            np.add.at(gone, at + WINDOW, -1)
            gone = np.cumsum(gone)[:-1] > 0
            removed.append(int(gone.sum()))
            digests.append(hashlib.sha256(b" ".join(found[i] for i in np.flatnonzero(~gone))).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), pa.array(removed, pa.int64()), pa.array(digests, pa.string())],
            names=["key", "removed", "kept"])


def _repeated(sent: DataFrame, by: list[str]) -> DataFrame:
    """key, positions: where rows stand whose hash comes more than once. A key's rows are at most those of its text."""
    total = F.sum("times").over(W.partitionBy(*by))
    asked = sent.where("times > 0").withColumn("total", total).where("total > 1 AND weight = 1")
    known = sent.where("times = 0")
    return asked.select("key", "pos").unionByName(known.select("key", "pos")).groupBy("key").agg(F.collect_set("pos").alias("positions"))


def substring_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for every row of ``docs``.

    Removed is every word covered by a window of 35 words whose word sequence begins anywhere else
    too, in the same text or another; windows are judged on the input. Words are what stands between
    ASCII white space; a null or empty text has none, and nothing is removed from fewer than 35
    words. Repeated rows are rows like others, so each is removed for the other's sake.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
    rows = rows.withColumn("key", F.xxhash64("text"))  # same text, same key; a shared key only adds candidates
    counted = written(rows.mapInArrow(stats, "doc_id long, key long, n_words long, seq string"), "words")
    classes = counted.where(F.col("n_words") >= WINDOW).groupBy("seq").agg(
        F.count("*").alias("n"), F.min(F.struct("key", F.coalesce("doc_id", F.lit(0)).alias("id"))).alias("first"))
    classes = written(classes, "classes")

    at = _repeated(rows.mapInArrow(anchors, SENT), ["h"])
    searched = classes.select(
        F.col("first.key").alias("key"), F.col("first.id").alias("id"), F.when(F.col("n") > 1, 2).otherwise(1).alias("weight"))
    near = written(at.join(searched, "key"), "near")
    texts = written(
        rows.withColumn("id", F.coalesce("doc_id", F.lit(0))).join(near, ["key", "id"]).select("key", "text", "positions", "weight"),
        "texts")
    found = _repeated(texts.mapInArrow(windows, SENT), ["h", "g"])
    one = texts.where("weight = 1").select("key", "text")
    cuts = one.join(found, "key").mapInArrow(cut, "key long, removed long, kept string")
    cuts = written(cuts.dropDuplicates(["key"]), "cuts")

    alike = classes.where("n > 1").select("seq", F.lit(True).alias("all"))
    whole = F.coalesce("all", F.lit(False))
    return counted.join(alike, "seq", "left").join(cuts, "key", "left").select(
        "doc_id", "n_words",
        F.when(whole, F.col("n_words")).otherwise(F.coalesce("removed", F.lit(0))).alias("n_removed"),
        F.when(whole, F.lit(NOTHING)).otherwise(F.coalesce("kept", "seq")).alias("kept_sha256"),
    )


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"))


# The windows of every text as they stand, and what none of the repeated ones covers.
SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, CAST(doc_id AS BIGINT) AS doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
win AS (
  SELECT r, i, sha256(array_to_string(w[i:i + {WINDOW - 1}], ' ')) AS h
  FROM (SELECT r, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM d WHERE len(w) >= {WINDOW})),
covered AS (
  SELECT DISTINCT r, j FROM (
    SELECT r, unnest(range(i, i + {WINDOW})) AS j FROM win WHERE h IN (SELECT h FROM win GROUP BY h HAVING count(*) > 1))),
kept AS (
  SELECT k.r, string_agg(k.word, ' ' ORDER BY k.j) AS words
  FROM (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM d) k
  ANTI JOIN covered c ON c.r = k.r AND c.j = k.j GROUP BY k.r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
  CAST((SELECT count(*) FROM covered c WHERE c.r = d.r) AS BIGINT) AS n_removed,
  sha256(coalesce((SELECT words FROM kept k WHERE k.r = d.r), '')) AS kept_sha256
FROM d"""
