"""An audit of row ids that answers "which of these are in it?" without reading all of it.

Ids are dealt to slots by hash. Each slot has Bloom filters of one bitmap (32,768 bits) each beside its rows, among which its
ids are dealt. Before a batch asks the rows, its ids ask the filters: an id that a filter doesn't know is new, and only slots
in which an id may be known are read. A batch of new ids thus reads one folder of filters, of ``slots * maps`` bitmaps, however
long the audit is; only ids that come again cost reading their slots. Too few filters for the ids make them answer "maybe"
more often, which costs reading and changes no answer.

The folder of a batch also has the ids of the batches right before it, as many as the lowest bit of its place says (the
places are 1, 2, ...; as in a Fenwick tree). So the ids of the first n batches are in as many folders as n has bits set, an
id is written again only as often as their number doubles, and no folder changes when later batches come.

    <path>/rows/batch=3/slot=17/...     ids of the batches 0 to 3      <path>/filters/batch=3/...   all filters after it
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quarterfold.sources.scratch import exists

BITS, HASHES = 32_768, 3


class Audit:
    def __init__(self, spark: SparkSession, path: str, key: str, slots: int = 16, maps: int = 64):
        self.spark, self.path, self.key, self.slots, self.maps = spark, path, key, slots, maps

    def _map(self) -> Column:
        """Number of the bitmap of an id."""
        return F.pmod(F.xxhash64(self.key), F.lit(self.slots * self.maps)).cast("int")

    def _slot(self) -> Column:
        return F.pmod(self._map(), F.lit(self.slots))

    def _places(self) -> Column:
        return F.array(*[F.pmod(F.xxhash64(F.lit(k), self.key), F.lit(BITS)) for k in range(HASHES)])

    def _filters(self, before: int) -> DataFrame | None:
        """Filters as batch ``before - 1`` left them. Batches follow each other, so it is complete."""
        at = f"{self.path}/filters/batch={before - 1}"
        return self.spark.read.schema("map int, bits binary").parquet(at) if exists(self.spark, at) else None

    def _rows(self, kind: str, before: int, after: int = 0) -> DataFrame:
        """Ids of the batches ``after`` to ``before - 1``, ``after`` being where a folder of ``before`` begins."""
        folders, place = [], before
        while place > after:
            folders.append(f"{self.path}/rows/batch={place - 1}")
            place &= place - 1  # without its lowest bit: what the folder doesn't have
        rows = self.spark.read.schema(f"{self.key} {kind}, batch bigint, slot int").option("basePath", f"{self.path}/rows")
        return rows.parquet(*folders)

    def maybe(self, ids: DataFrame, before: int) -> DataFrame:
        """(key, slot) of the ids that may be in the audit of the batches before."""
        filters = self._filters(before)
        rows = ids.select(self.key, self._slot().alias("slot"), self._map().alias("map"), self._places().alias("places"))
        if filters is None:
            return rows.select(self.key, "slot").limit(0)
        rows = rows.join(F.broadcast(filters), "map")  # at most ``slots * maps`` bitmaps of 4 KB
        byte = lambda p: F.conv(F.hex(F.substring("bits", (p / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        known = F.forall("places", lambda p: byte(p).bitwiseAND(F.pow(F.lit(2), p % 8).cast("int")) != 0)
        return rows.where(known).select(self.key, "slot")

    def known(self, ids: DataFrame, before: int) -> DataFrame:
        """Those of the ids that batches before ``before`` audited. Slots without a candidate aren't read."""
        candidates = self.maybe(ids, before)
        slots = [r[0] for r in candidates.select("slot").distinct().collect()]  # at most ``slots``
        if not slots:
            return ids.select(self.key).limit(0)
        rows = self._rows(ids.schema[self.key].dataType.simpleString(), before)
        rows = rows.where(F.col("slot").isin(slots) & (F.col("batch") < before)).select(self.key)
        return rows.join(candidates.select(self.key), self.key, "left_semi").distinct()

    def add(self, ids: DataFrame, batch: int) -> None:
        """Audits the ids of a batch; running it again replaces what it wrote."""
        bits = ids.select(self._map().alias("map"), F.explode(self._places()).alias("place")).groupBy("map").agg(
            F.bitmap_construct_agg("place").alias("bits"))
        before = self._filters(batch)
        if before is not None:
            bits = bits.unionByName(before).groupBy("map").agg(F.bitmap_or_agg("bits").alias("bits"))
        rows, covered = ids.select(self.key, self._slot().alias("slot")), batch & (batch + 1)
        if covered < batch:
            kind = ids.schema[self.key].dataType.simpleString()
            rows = rows.unionByName(self._rows(kind, batch, covered).select(self.key, "slot"))
        rows.repartition(self.slots, "slot").write.mode("overwrite").partitionBy("slot").parquet(f"{self.path}/rows/batch={batch}")
        bits.write.mode("overwrite").parquet(f"{self.path}/filters/batch={batch}")
