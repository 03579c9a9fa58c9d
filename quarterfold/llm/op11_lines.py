"""Line dedup that can be taken back: sharded cuckoo filters before exact reference-count tables.

A line's key is its text without white space at its ends and with A-Z in lower case, as a 128-bit hash. Keys are dealt to shards.
Each operation on the index is a version of its own, in folders that count once its log is written:

    <path>/held/v=1/       documents and the keys of their lines
    <path>/entries/v=1/    reference counts: key, lines that hold it, smallest and largest document; filters of shards
    <path>/gone/v=2/       documents deleted
    <path>/log/v=1/        written last

Insertion. Every partition first adds up its lines by key, so that a very common line is one row a partition. The rows
go to their shards, past the shard's cuckoo filter: a key that the filter doesn't know is new and goes in, and nothing
else need be asked of it. Only keys that it knows are counted exactly, over the reference-count rows of all versions. Most
lines stand in one place, so the exact count meets few of them. A filter may take a new key for a known one; the exact
count tells, and the key then gets its fingerprint.

Deletion. The keys of the deleted documents are counted anew from the documents left; counts of this version
replace the earlier ones. Keys that nobody holds any more leave their filter. The next holder of a line thereby gets it back.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quarterfold.llm.common import ascii_lower, partitions, table, text_of, written
from quarterfold.llm.cuckoo import Cuckoo
from quarterfold.sources.scratch import exists, fresh_path

LEAST = 10  # code points of a key that counts
BUCKETS = 1 << 14  # of a segment of a filter, 256 KB
COMBINED = 1 << 20  # lines that a task adds up at a time
HOT = 1000  # keys with more than a HOT-th of all repeated lines are broadcast; there are fewer than HOT
BLANK = " \t\n\x0b\x0c\r"
KEY = ["k1", "k2"]
COUNTS = "shard int, k1 long, k2 long, n long, lo long, hi long"
#: known: the filter knew the key. reset: earlier counts are void. filter: set in a shard's last row only.
ENTRIES = f"{COUNTS}, known boolean, reset boolean, filter binary"
HELD = "doc_id long, keys array<struct<k1: long, k2: long>>"


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def keys_of(text: Column) -> Column:
    """For each line (k1, k2), or null if the line doesn't count. Whole texts are folded, as lambdas are evaluated anew for
    each use; lower() is the quicker fold where a text is ASCII."""
    folded = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(ascii_lower(text))
    key = F.transform(lines_of(folded), lambda line: F.btrim(line, F.lit(BLANK)))
    return F.transform(key, lambda k: F.when(
        F.char_length(k) >= LEAST, F.struct(F.xxhash64(k).alias("k1"), F.xxhash64(F.lit(1), k).alias("k2"))))


def shard_of(k1, shards: int):
    return k1 % shards if isinstance(k1, np.ndarray) else F.pmod(k1, F.lit(shards)).cast("int")


def added_up(k1, k2, n, lo, hi) -> list[np.ndarray]:
    """Counts by key."""
    order = np.lexsort((k2, k1))
    k1, k2, n, lo, hi = (x[order] for x in (k1, k2, n, lo, hi))
    new = np.ones(len(k1), dtype=bool)
    new[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
    at = np.flatnonzero(new)
    return [k1[at], k2[at], np.add.reduceat(n, at), np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at)]


def _combined(shards: int):
    """(doc_id, keys) to counts, COMBINED lines at a time, or one document if it has more."""
    def sent(parts: list[tuple]) -> pa.RecordBatch:
        k1, k2, doc = (np.concatenate(p) for p in zip(*parts, strict=True))
        found = added_up(k1, k2, np.ones(len(k1), dtype=np.int64), doc, doc)
        return pa.RecordBatch.from_arrays(
            [pa.array(shard_of(found[0], shards).astype(np.int32)), *map(pa.array, found)], names=["shard", *KEY, "n", "lo", "hi"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            flat, counts = batch.column("keys").flatten(), pc.list_value_length(batch.column("keys")).to_numpy()
            if not len(flat):
                continue
            k1, k2 = (flat.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            parts.append((k1, k2, np.repeat(batch.column("doc_id").to_numpy(), counts)))
            held += len(k1)
            if held >= COMBINED:
                yield sent(parts)
                parts, held = [], 0
        if held:
            yield sent(parts)
    return run


def _shards(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[tuple[int, Cuckoo, pa.RecordBatch | None]]:
    """(shard, its filter, some of its rows); without rows when a shard ends. Rows come by shard, a shard's filter first."""
    shard, cuckoo = None, None
    for batch in batches:
        at = batch.column("shard").to_numpy()
        cuts = [0, *(np.flatnonzero(at[1:] != at[:-1]) + 1).tolist(), len(at)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a == b:
                continue
            part = batch.slice(a, b - a)
            if at[a] != shard:
                if shard is not None:
                    yield shard, cuckoo, None
                shard, before = int(at[a]), part.column("filter")[0].as_py()
                cuckoo = Cuckoo(buckets, before or b"")
                part = part.slice(0 if before is None else 1)
            if part.num_rows:
                yield shard, cuckoo, part
    if shard is not None:
        yield shard, cuckoo, None


def _entries(shard: int, counts: list, known: np.ndarray | None, cuckoo: Cuckoo | None = None) -> pa.RecordBatch:
    if cuckoo is not None:
        counts, known, blobs = [[None]] * 5, [None], [cuckoo.to_bytes()]
    else:
        blobs = [None] * len(known)
    n = len(known)
    return pa.RecordBatch.from_arrays(
        [pa.array([shard] * n, pa.int32()), *(pa.array(c, pa.int64()) for c in counts), pa.array(known, pa.bool_()),
         pa.array([False] * n), pa.array(blobs, pa.binary())],
        names=["shard", *KEY, "n", "lo", "hi", "known", "reset", "filter"])


def _admitted(buckets: int):
    """Counts that went past their shard's filter, which takes in the keys it doesn't know; then the filter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, cuckoo, part in _shards(batches, buckets):
            if part is None:
                yield _entries(shard, [], None, cuckoo)
                continue
            counts = added_up(*(part.column(c).to_numpy() for c in (*KEY, "n", "lo", "hi")))
            known = cuckoo.contains(counts[0])
            cuckoo.insert(counts[0][~known])
            yield _entries(shard, counts, known)
    return run


def _changed(buckets: int, add: bool):
    """Filters that the keys given were put into or taken out of."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, cuckoo, part in _shards(batches, buckets):
            if part is None:
                yield _entries(shard, [], None, cuckoo)
            else:
                (cuckoo.insert if add else cuckoo.delete)(part.column("k1").to_numpy())
    return run


class LineIndex:
    """Lines of a growing and shrinking set of documents.

    Ids are integers. A document without an id holds no line and keeps all of its own; rows with one id are one document.
    A null or empty text has one empty line, which is too short to count. Other columns are not looked at. Empty tables
    change nothing. One operation at a time; one that broke off leaves nothing that is read.
    """

    def __init__(self, spark: SparkSession, path: str, shards: int | None = None, buckets: int = BUCKETS):
        self.spark, self.path, self.shards, self.buckets = spark, path, shards or partitions(spark), buckets
        if exists(spark, f"{path}/log"):
            made = self._log().first()
            self.shards, self.buckets = made["shards"], made["buckets"]

    # versions ---------------------------------------------------------------

    def _log(self) -> DataFrame:
        return self.spark.read.schema("shards int, buckets int, v int").parquet(f"{self.path}/log")

    def versions(self) -> list[int]:
        """Complete operations: one number each."""
        return sorted(r["v"] for r in self._log().select("v").collect()) if exists(self.spark, f"{self.path}/log") else []

    def _begun(self) -> int:
        """Above every version begun."""
        last = [self.spark.read.schema("doc_id long, v int").parquet(f"{self.path}/{t}").agg(F.max("v")).first()[0] or 0
                for t in ("held", "gone") if exists(self.spark, f"{self.path}/{t}")]
        return max([0, *last, *self.versions()]) + 1

    def _committed(self, version: int) -> int:
        done = self.spark.createDataFrame([(self.shards, self.buckets)], "shards int, buckets int").coalesce(1)
        done.write.mode("overwrite").parquet(f"{self.path}/log/v={version}")
        return version

    def _table(self, name: str, schema: str, also: Sequence[int] = ()) -> DataFrame:
        counts = [*self.versions(), *also]
        if not counts or not exists(self.spark, f"{self.path}/{name}"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}").where(F.col("v").isin(counts))

    # state ------------------------------------------------------------------

    def held(self) -> DataFrame:
        """(doc_id, keys) of the documents in the index."""
        gone = self._table("gone", "doc_id long, v int").groupBy("doc_id").agg(F.max("v").alias("until"))
        rows = self._table("held", f"{HELD}, v int").join(gone, "doc_id", "left")
        return rows.where("until IS NULL OR until < v").select("doc_id", "keys")

    def _counts(self, also: Sequence[int] = ()) -> DataFrame:
        return self._table("entries", f"{ENTRIES}, v int, step int", also).where("k1 IS NOT NULL")

    def _filters(self, also: Sequence[int] = ()) -> DataFrame:
        """The newest filter of each shard."""
        rows = self._table("entries", f"{ENTRIES}, v int, step int", also).where("filter IS NOT NULL")
        newest = rows.groupBy("shard").agg(F.max(F.struct("v", "step")).alias("newest"))  # a row a shard
        rows = rows.join(F.broadcast(newest), "shard").where(F.struct("v", "step") == F.col("newest"))
        return rows.select(*(c.strip().split(" ")[0] for c in COUNTS.split(",")), "filter")

    def totals(self, keys: DataFrame, also: Sequence[int] = ()) -> DataFrame:
        """(k1, k2, n, lo, hi) over all versions: lines with the key, smallest and largest document that holds it."""
        rows = self._counts(also).join(keys, KEY, "left_semi").groupBy(*KEY, "v").agg(
            F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.bool_or("reset").alias("reset"))
        since = F.max(F.when(F.col("reset"), F.col("v"))).over(W.partitionBy(*KEY))  # a row a version
        rows = rows.withColumn("since", since).where("since IS NULL OR v >= since")
        return rows.groupBy(*KEY).agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))

    def repeated(self) -> DataFrame:
        """(k1, k2, n, lo, hi) of keys that two documents or more hold. Only keys that a filter knew, or that a partition met
        in two documents, are counted."""
        met = self._counts().where("known OR lo < hi OR reset").select(*KEY).distinct()
        return self.totals(met).where("lo < hi")

    # operations -------------------------------------------------------------

    def _past_filters(self, rows: DataFrame, run, path: str, also: Sequence[int] = ()) -> None:
        """Rows (in the form of COUNTS) go to their shards, where ``run`` sees them after the shard's filter."""
        both = self._filters(also).unionByName(rows.withColumn("filter", F.lit(None).cast("binary")))
        both = both.repartitionById(self.shards, F.col("shard")).sortWithinPartitions("shard", F.col("filter").isNull())
        both.mapInArrow(run, ENTRIES).write.parquet(path)

    def insert(self, docs: DataFrame) -> int:
        """Adds those documents (doc_id, text) that aren't in the index; returns the version."""
        version = self._begun()
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text")).where("doc_id IS NOT NULL")
        if self.versions():
            rows = rows.join(self.held().select("doc_id"), "doc_id", "left_anti")
        keys = F.array_compact(keys_of(F.col("text")))
        rows.select("doc_id", keys.alias("keys")).write.parquet(f"{self.path}/held/v={version}")
        held = self.spark.read.schema(HELD).parquet(f"{self.path}/held/v={version}")
        at = f"{self.path}/entries/v={version}"
        self._past_filters(held.mapInArrow(_combined(self.shards), COUNTS), _admitted(self.buckets), f"{at}/step=1")
        mistaken = written(self._mistaken(version), "mistaken")
        if not mistaken.isEmpty():
            self._past_filters(mistaken, _changed(self.buckets, True), f"{at}/step=2", [version])
        return self._committed(version)

    def _mistaken(self, version: int) -> DataFrame:
        """Keys that a filter took for known ones though nobody held them."""
        now = self._counts([version]).where(F.col("v") == version)
        keys = now.where("known").select("shard", *KEY).distinct().join(now.where("NOT known").select(*KEY), KEY, "left_anti")
        before = self.totals(keys.select(*KEY)).where("n > 0").select(*KEY)
        none = F.lit(None).cast("long")
        return keys.join(before, KEY, "left_anti").select("shard", *KEY, none.alias("n"), none.alias("lo"), none.alias("hi"))

    def delete(self, ids: DataFrame) -> int:
        """Takes documents (doc_id) out; returns the version. Ids that aren't in the index are passed over."""
        version = self._begun()
        ids = ids.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id IS NOT NULL").distinct()
        ids.write.parquet(f"{self.path}/gone/v={version}")
        ids = self.spark.read.schema("doc_id long").parquet(f"{self.path}/gone/v={version}")
        held, key = self.held(), F.explode("keys").alias("key")
        touched = written(held.join(ids, "doc_id", "left_semi").select(key).select("key.*").distinct(), "touched")
        left = held.join(ids, "doc_id", "left_anti").select("doc_id", key).select("doc_id", "key.*")
        left = left.join(touched, KEY, "left_semi").groupBy(*KEY).agg(
            F.count("*").alias("n"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
        counts = touched.join(left, KEY, "left").select(
            shard_of(F.col("k1"), self.shards).alias("shard"), *KEY, F.coalesce("n", F.lit(0).cast("long")).alias("n"), "lo", "hi")
        at = f"{self.path}/entries/v={version}"
        flags = {"known": F.lit(True), "reset": F.lit(True), "filter": F.lit(None).cast("binary")}
        counts.withColumns(flags).write.parquet(f"{at}/step=1")
        counts = self.spark.read.schema(COUNTS).parquet(f"{at}/step=1")
        self._past_filters(counts.where("n = 0"), _changed(self.buckets, False), f"{at}/step=2")
        return self._committed(version)

    def kept(self, docs: DataFrame) -> DataFrame:
        """doc_id, n_lines, n_dropped, kept (text) for every row of ``docs``, which are in the index.

        A key that two documents hold stays in the one with the smaller id; all of its lines there stay. A document's
        lines are read once; texts meet only the places of their dropped lines.
        """
        text = text_of("text")
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                           F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2"))
        of_row = ["doc_id", "h1", "h2"]
        repeated = written(self.repeated().select(*KEY, "n", "lo"), "repeated")
        lines = repeated.agg(F.sum("n")).first()[0] or 0
        hot = F.broadcast(repeated.where(F.col("n") * HOT > lines).select(*KEY, F.col("lo").alias("hot")))
        rest = repeated.where(F.col("n") * HOT <= lines).select(F.col("k1").alias("r1"), F.col("k2").alias("r2"), "lo")
        keyed = rows.select(*of_row, F.posexplode(keys_of(F.col("text"))).alias("pos", "key"))
        keyed = keyed.where("key IS NOT NULL").select(*of_row, "pos", "key.*").join(hot, KEY, "left")
        # lines with a hot key have their answer and go anywhere
        plain = F.col("hot").isNull()
        keyed = keyed.withColumn("k1", F.when(plain, F.col("k1")).otherwise(F.xxhash64("doc_id", "pos")))
        found = keyed.join(rest, (F.col("k1") == F.col("r1")) & (F.col("k2") == F.col("r2")) & plain, "left")
        drops = found.where(F.coalesce("hot", "lo") < F.col("doc_id")).groupBy(*of_row).agg(
            F.sort_array(F.collect_set("pos")).alias("drops"))
        return rows.join(drops, of_row, "left").select(
            "doc_id", F.size(lines_of(F.col("text"))).cast("long").alias("n_lines"),
            F.coalesce(F.size("drops"), F.lit(0)).cast("long").alias("n_dropped"),
            F.when(F.col("drops").isNull(), F.col("text")).otherwise(_without(lines_of(F.col("text")), F.col("drops"))).alias("kept"))


def _without(lines: Column, drops: Column) -> Column:
    """The text of the lines that lie between dropped places (from 0, in order)."""
    begins = F.concat(F.array(F.lit(0)), F.transform(drops, lambda p: p + 1))
    ends = F.concat(drops, F.array(F.size(lines)))
    kept = F.zip_with(begins, ends, lambda a, b: F.slice(lines, a + 1, b - a))
    return F.array_join(F.flatten(kept), "\n")


def op11_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, index = table(spark, sf_dir, "documents"), LineIndex(spark, fresh_path(spark, "lines"))
    index.insert(docs)
    return index.kept(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


_SQL_BLANK = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
SQL = f"""
WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM docs),
keyed AS (
  SELECT *, translate(trim(line, {_SQL_BLANK}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
), marked AS (
  SELECT doc_id, pos, line, length(key) >= {LEAST} AND doc_id > min(doc_id) OVER (PARTITION BY key) AS gone FROM keyed
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
