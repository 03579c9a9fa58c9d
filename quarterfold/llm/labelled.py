"""The bounded sample of labelled rows that classifiers are fitted on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE = 20_000  # labelled rows that a classifier is fitted on, about; fewer labels are all taken
_STEPS = 1 << 20


def remainder(modulus: int, column: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % modulus


def sample(labels: DataFrame, label: str, modulus: int, held_out: int, most: int = SAMPLE) -> DataFrame:
    """_id and label of rows that aren't held out; by hash, about ``most`` rows. Several labels of one id: the smallest."""
    rows = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("label")).dropna()
    rows = rows.where(remainder(modulus, "_id") != held_out).groupBy("_id").agg(F.min("label").alias("label"))
    share = min(1.0, most / max(rows.count(), 1))
    return rows.where(F.pmod(F.xxhash64("_id"), F.lit(_STEPS)) < int(share * _STEPS))


def with_labels(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text, label of the sampled rows. The sample is bounded, so it is broadcast and texts stay where they are."""
    return docs.select("doc_id", "text").join(F.broadcast(labels), F.col("doc_id") == F.col("_id")).select("doc_id", "text", "label")
