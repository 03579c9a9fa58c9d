"""Sharding by minimax contiguous partition.

Rows with equal texts form an atomic group. Groups are ordered by size, largest first, then by
digest, and cut into contiguous shards so that the largest shard is as small as this order allows:
a binary search for the capacity, each candidate checked by filling shards greedily, and again for the rest after each cut. Groups of one
size are interchangeable, so the order is described by how many groups have each size; there are at
most sqrt(2 * total bytes) different sizes, which bounds what the driver holds.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quarterfold.llm.common import table, text_of, written

SHARDS = 16
DIGITS = 3  # hex digits of the digest a step, when a cut falls between groups of one size
BUCKETS = 1024  # of each shard, for numbering; at most SHARDS * BUCKETS rows are broadcast


def fill(sizes: np.ndarray, counts: np.ndarray, capacity: int, shards: int, start: int = 0) -> list[tuple[int, int]] | None:
    """Greedy cuts (index of size, groups of it before the cut) of what lies ``start`` bytes on, or None if it doesn't fit."""
    ends = np.cumsum(sizes * counts)
    total, cuts = int(ends[-1]), []
    for _ in range(shards):
        if total - start <= capacity:
            return cuts
        i = int(np.searchsorted(ends, start + capacity, "right"))
        before = int(ends[i] - sizes[i] * counts[i])
        taken = (start + capacity - before) // int(sizes[i])
        if before + taken * int(sizes[i]) <= start:
            return None
        start = before + taken * int(sizes[i])
        cuts.append((i, taken))
    return None


def smallest_capacity(sizes: np.ndarray, counts: np.ndarray, shards: int, start: int = 0) -> int:
    """sizes: decreasing. The smallest capacity with which greedy filling needs ``shards`` shards at most."""
    ends = np.cumsum(sizes * counts)
    left = int(ends[-1]) - start
    low, high = max(-(-left // shards), int(sizes[np.searchsorted(ends, start, "right")])), left
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if fill(sizes, counts, middle, shards, start) is not None else (middle + 1, high)
    return low


def balanced_cuts(sizes: np.ndarray, counts: np.ndarray, shards: int) -> list[tuple[int, int]]:
    """Cuts under the smallest capacity, which is found again for what is left after each cut: no shard is larger than need
    be, the shards after a large group share the rest evenly, and none is empty while there are groups for it."""
    ends = np.cumsum(sizes * counts)
    cuts, start = [], 0
    for left in range(shards, 1, -1):
        cut = fill(sizes, counts, smallest_capacity(sizes, counts, left, start), left, start)
        if not cut:
            break
        i, taken = cut[0]
        start = int(ends[i] - sizes[i] * counts[i]) + taken * int(sizes[i])
        cuts.append((i, taken))
    return cuts


def _digests_at(groups: DataFrame, cuts: list[tuple[int, int]]) -> list[str]:
    """For each cut (size, k) the digest of the k-th group of this size, from 0. Narrows a prefix down; at most
    len(cuts) * 16**DIGITS rows come to the driver at a time."""
    most = 16**DIGITS
    todo = {i: (size, "", k) for i, (size, k) in enumerate(cuts)}
    found: dict[int, str] = {}

    def among(wanted) -> DataFrame:
        return groups.where(reduce(lambda a, b: a | b, [
            (F.col("bytes") == s) & F.col("digest").startswith(p) for s, p, _ in wanted]))

    while todo:
        depth = len(next(iter(todo.values()))[1]) + DIGITS
        counted: dict[tuple[int, str], int] = {
            (r["bytes"], r["p"]): r["count"]
            for r in among(todo.values()).groupBy("bytes", F.substring("digest", 1, depth).alias("p")).count().collect()
        }
        small = {}
        for i, (size, prefix, k) in list(todo.items()):
            for p in sorted(p for s, p in counted if s == size and p.startswith(prefix)):
                if k < counted[size, p]:
                    break
                k -= counted[size, p]
            todo[i] = (size, p, k)
            if counted[size, p] <= most:
                small[i] = todo.pop(i)
        if small:
            rows = among(small.values()).select("bytes", "digest").distinct().collect()
            for i, (size, prefix, k) in small.items():
                found[i] = sorted(r["digest"] for r in rows if r["bytes"] == size and r["digest"].startswith(prefix))[k]
    return [found[i] for i in range(len(cuts))]


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of ``docs``.

    Size: UTF-8 bytes of the text plus 1; null counts as an empty text. Law ``bytes``: the largest
    shard is as small as whole groups of equal texts allow, and so is the largest of those after it; a group larger than an
    even share makes a shard of its own size. Slots of a shard run from 0 without gaps. With fewer groups than shards
    the last shards stay empty. Repeated rows are rows like others; no rows: no rows.
    """
    text = text_of("text")
    rows = written(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.sha2(text, 256).alias("digest"),
    ), "sized")
    groups = written(rows.groupBy("digest").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")), "groups")
    histogram = groups.groupBy("bytes").agg(F.count("*").alias("n")).toPandas().sort_values("bytes", ascending=False)
    after = F.lit(0)
    if len(histogram):
        sizes, counts = histogram["bytes"].to_numpy("int64"), histogram["n"].to_numpy("int64")
        cuts = balanced_cuts(sizes, counts, shards)
        inside = [(int(sizes[i]), k) for i, k in cuts if 0 < k < counts[i]]
        at = dict(zip(inside, _digests_at(groups, inside), strict=True)) if inside else {}
        for i, k in cuts:
            size = int(sizes[i])
            beyond = F.col("bytes") < size if k else F.col("bytes") <= size
            if (size, k) in at:
                beyond |= (F.col("bytes") == size) & (F.col("digest") >= at[size, k])
            after = after + beyond.cast("int")
    copies = groups.where("n > 1").select("digest", F.col("bytes").alias("together"))
    placed = written(
        rows.join(copies, "digest", "left").withColumn("bytes", F.coalesce("together", "size"))
        .select("doc_id", "size", "text_crc32", "digest", after.alias("shard"),
                F.pmod(F.xxhash64("doc_id", "digest"), F.lit(BUCKETS)).alias("bucket")), "placed")
    per_bucket = placed.groupBy("shard", "bucket").count()
    before = F.sum("count").over(W.partitionBy("shard").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1))
    offsets = per_bucket.select("shard", "bucket", F.coalesce(before, F.lit(0)).alias("offset"))
    within = F.row_number().over(W.partitionBy("shard", "bucket").orderBy("doc_id", "digest")) - 1
    return placed.withColumn("within", within).join(F.broadcast(offsets), ["shard", "bucket"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("offset") + F.col("within")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"))
