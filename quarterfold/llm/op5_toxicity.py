"""Toxicity by maximum-scoring segments.

Words and word beginnings get log-odds of standing in a toxic rather than in a clean document, smoothed by
a Dirichlet prior in proportion to the corpus; what is significant becomes a positive score, every other
word a small negative one. A linear scan finds all maximal scoring passages of a text. By extreme-value
theory chance brings about K * n * exp(-L * S) passages of score S or more in n words, so each passage counts with its excess
over that, and a logistic curve turns a document's sum into a score.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterfold.llm import labelled
from quarterfold.llm.common import table, text_of

MODULUS, HELD_OUT = 4, 2
THRESHOLD = 0.3
PRIOR, LEAST = 500.0, 0.5  # the prior's weight shared out like the corpus, and what every word gets of it besides
SURE, STRONG = 4.0, 2.0  # least log-odds, in standard errors and as they are
STEMS = (3, 4, 5)  # letters of a word's beginning, looked at after the whole word, longest first
MEMO = 1 << 17  # words whose score a task remembers at a time
_WORD = re.compile(r"[^\W_]+")


class Scores(dict):
    """Score of a word; remembers what it has looked up."""

    def __init__(self, odds: dict[str, float], other: float):
        self.odds, self.other = odds, other

    def __missing__(self, word: str) -> float:
        found = self.odds.get(word)
        for n in sorted(STEMS, reverse=True):
            if found is None and len(word) > n:
                found = self.odds.get(f"{word[:n]}*")
        if len(self) >= MEMO:
            self.clear()
        self[word] = found = self.other if found is None else found
        return found


def segments(hits: list[tuple[int, float]], other: float) -> list[tuple[float, int, int]]:
    """All maximal scoring passages (score, first word, last word). hits: place and score of positive words in order; every
    word between them scores ``other`` < 0. Each hit is pushed and merged once, so time is linear."""
    stack: list[list] = []  # total before, total after, first, last
    total, at = 0.0, -1
    for place, score in hits:
        total += other * (place - at - 1)
        new = [total, total + score, place, place]
        total, at = total + score, place
        while True:
            i = len(stack) - 1
            while i >= 0 and stack[i][0] >= new[0]:
                i = stack[i][4]
            if i < 0 or stack[i][1] >= new[1]:
                stack.append([*new[:4], i])
                break
            new = [stack[i][0], new[1], stack[i][2], new[3]]
            del stack[i:]
    return [(s[1] - s[0], s[2], s[3]) for s in stack]


class Model:
    """Positive log-odds, the score of other words, and L, K and the curve of the calibration."""

    def __init__(self, odds: dict[str, float], other: float, rate: float, k: float):
        self.odds, self.other, self.rate, self.k, self.curve = odds, other, rate, k, (0.0, 0.0)

    def passages(self, text: str, memo: Scores) -> tuple[int, list[tuple[float, int, int]]]:
        """Number of words, and the maximal segments with their scores."""
        scores = list(map(memo.__getitem__, _WORD.findall(text.lower())))
        hits = [(i, s) for i, s in enumerate(scores) if s > 0]
        return len(scores), segments(hits, self.other) if hits else []

    def evidence(self, n: int, found: list[tuple[float, int, int]]) -> tuple[float, list[tuple[int, int]]]:
        """Summed excess of the significant passages, and where they are, in words."""
        chance = math.log(max(self.k * n, 1e-12))
        found = [(self.rate * s - chance, a, b) for s, a, b in found]
        return sum(max(e, 0.0) for e, _, _ in found), [(a, b + 1) for e, a, b in found if e > 0]

    def score(self, evidence: np.ndarray) -> np.ndarray:
        a, b = self.curve
        return 1 / (1 + np.exp(-np.clip(a * np.log1p(evidence) + b, -40, 40)))


def log_odds(rows: DataFrame) -> tuple[dict[str, float], float, float, float]:
    """Significant positive log-odds by word or ``beginning*``, the other words' score, and the calibration's L and K."""
    # A word counts once a document, and documents with one text once: words cluster, copies even more.
    word = F.explode(F.array_distinct(F.regexp_extract_all(F.lower(text_of("text")), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))).alias("w")
    toxic = F.col("label") == 1
    words = rows.withColumn("h", F.xxhash64("text")).dropDuplicates(["h", "label"]).select("label", word).groupBy("w").agg(
        F.count(F.when(toxic, 1)).alias("t"), F.count(F.when(~toxic, 1)).alias("c"))
    units = F.array(F.col("w"), *[F.when(F.length("w") > n, F.concat(F.left("w", F.lit(n)), F.lit("*"))) for n in STEMS])
    counted = words.withColumn("u", F.explode(units)).where("u IS NOT NULL").groupBy("u").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    sums = words.agg(F.sum("t").alias("t"), F.sum("c").alias("c")).first()
    t_all, c_all = float(sums["t"] or 0), float(sums["c"] or 0)
    if not t_all or not c_all:
        return {}, -0.01, 1.0, 1e-3
    prior = F.lit(LEAST) + F.lit(PRIOR) * (F.col("t") + F.col("c")) / (t_all + c_all)
    t, c = F.col("t") + prior, F.col("c") + prior
    odds = F.log(t / (t_all + PRIOR - t)) - F.log(c / (c_all + PRIOR - c))
    sure = counted.select("u", "t", "c", odds.alias("odds"), (odds / F.sqrt(1 / t + 1 / c)).alias("z"))
    kept = sure.where(F.col("z") >= SURE).where(F.col("odds") >= STRONG).collect()  # a small part of the words of a bounded sample
    scores = {r["u"]: float(r["odds"]) for r in kept}
    own = [r for r in kept if "*" not in r["u"]] + [
        r for r in kept if "*" in r["u"] and r["u"][:-2] + "*" not in scores]  # nested beginnings count once
    p_t = min(sum(r["t"] for r in own) / t_all, 0.5)
    p_c = max(sum(r["c"] for r in own) / c_all, 1 / c_all)
    other = min(math.log((1 - p_t) / (1 - min(p_c, p_t / 2 + 1e-9))), -0.01)
    # L: where the mean of exp(L * score) over clean words is 1, each score weighed by how often clean words have it.
    weighed = [(r["c"] / c_all, scores[r["u"]]) for r in own]
    low, high = 0.0, 20.0
    for _ in range(60):
        middle = (low + high) / 2
        total = sum(p * math.exp(min(middle * s, 500)) for p, s in weighed) + (1 - p_c) * math.exp(middle * other)
        low, high = (middle, high) if total < 1 else (low, middle)
    return scores, other, max(low, 0.05), p_c


def extreme_value_k(rate: float, lengths: np.ndarray, best: np.ndarray, otherwise: float) -> float:
    """K by maximum likelihood from clean texts: K * words * exp(-L * best score) is exponential with mean 1."""
    chances = float((lengths * np.exp(-np.clip(rate * best, 0, 500))).sum())
    return len(lengths) / chances if chances > 0 else otherwise


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Learns from a bounded sample of labelled rows; significant words and a number for each row reach the driver."""
    rows = labelled.with_labels(docs, labelled.sample(labels, "toxic", MODULUS, HELD_OUT))
    # words are weighed on two thirds of the texts, the calibration and the curve fitted on the others
    part = F.pmod(F.xxhash64(text_of("text")), F.lit(3))
    model = Model(*log_odds(rows.where(part > 0)))

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Scores(model.odds, model.other)
        for batch in batches:
            found = [model.passages(t.as_py() or "", memo) for t in batch.column("text")]
            lengths, scores = [n for n, _ in found], [[s for s, _, _ in f] for _, f in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(lengths, pa.int64()), pa.array(scores, pa.list_(pa.float64())), batch.column("label")],
                names=["n", "scores", "label"])

    # a few numbers for each text of the bounded sample
    got = rows.where(part == 0).mapInArrow(measured, "n long, scores array<double>, label int").toPandas()
    clean = got[(got["label"] == 0) & (got["n"] > 0)]
    best = np.array([max(s, default=0.0) for s in clean["scores"]])
    model.k = extreme_value_k(model.rate, clean["n"].to_numpy(float), best, model.k)
    got["e"] = [model.evidence(n, [(s, 0, 0) for s in found])[0] for n, found in zip(got["n"], got["scores"])]
    got = got.sort_values(["e", "label"])
    x, y = np.log1p(got["e"].to_numpy(float)), got["label"].to_numpy(float)
    a, b = 1.0, -2.0
    for _ in range(50 if len(y) else 0):  # Newton's steps for the curve, slightly damped towards (1, -2)
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -40, 40)))
        g = np.array([x @ (p - y) + 1e-2 * (a - 1), (p - y).sum() + 1e-2 * (b + 2)])
        w = p * (1 - p)
        h = np.array([[x @ (w * x) + 1e-2, w @ x], [w @ x, w.sum() + 1e-2]])
        step = np.linalg.solve(h, g)
        a, b = a - float(np.clip(step[0], -1, 1)), b - float(np.clip(step[1], -1, 1))
    model.curve = (max(a, 0.0), b)
    return model


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, passages for every row of ``docs``. labels: doc_id, toxic.

    Passages are pairs of word numbers, the end exclusive. Rows whose crc32(doc_id as text) mod 4 is 2 are held out: their
    labels aren't learned from. The score depends on the text alone, a null one counts as empty; repeated rows get equal
    scores. Without labels no word is significant, and nothing is predicted toxic.
    """
    held = (labelled.remainder(MODULUS) == HELD_OUT).alias("held_out")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held, text_of("text").alias("text"))
    return _scored(rows, train(docs, labels), ["doc_id", "held_out"])


def _scored(rows: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Scores(model.odds, model.other)
        for batch in batches:
            found = [model.evidence(*model.passages(t.as_py() or "", memo)) for t in batch.column("text")]
            p = model.score(np.array([e for e, _ in found], dtype=float))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(p), pa.array((p >= THRESHOLD).astype(np.int32)),
                 pa.array([[list(s) for s in spans] for _, spans in found], pa.list_(pa.list_(pa.int32())))],
                names=[*keep, "score", "predicted", "passages"])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name in keep)
    return rows.mapInArrow(scored, f"{kept}, score double, predicted int, passages array<array<int>>")


def clean_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that aren't predicted toxic."""
    model = train(docs, labels)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Scores(model.odds, model.other)
        for batch in batches:
            p = model.score(np.array([model.evidence(*model.passages(t.as_py() or "", memo))[0] for t in batch.column("text")], dtype=float))
            yield batch.filter(pa.array(p < THRESHOLD))

    return docs.mapInArrow(clean, docs.schema)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
