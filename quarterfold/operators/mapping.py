"""Declarative column mapping between two schemas."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from quarterfold.functions import row_uuid
from quarterfold.operators.lookups import fixed_table
from quarterfold.sources.scratch import fresh_path

# Over how many keys rows without a key are spread, should a join shuffle them.
SPREAD = 4096


@dataclass(frozen=True)
class MappingSpec:
    """How one target table is made from one source table.

    ``columns`` are target names, or ``target = SQL over source columns``.
    ``actors`` go through the user map, ``concepts`` through the concept map.
    ``key`` names the columns of the source row that make the row identifier; together they must be unique.
    """

    target: str
    source: str
    columns: tuple[str, ...]
    key: tuple[str, ...]
    where: str | None = None
    actors: tuple[str, ...] = ()
    concepts: tuple[str, ...] = ()

    def select_list(self) -> list[str]:
        return [
            f"{expr} AS {name}" for name, _, expr in (c.partition(" = ") for c in self.columns) if expr
        ] + [c for c in self.columns if " = " not in c]


class KeyMaps:
    """The maps a migration needs, one row per old key."""

    def __init__(self, users: DataFrame, concepts: DataFrame, drugs: DataFrame):
        self.concept_names = concepts
        self.users = self._pairs(users, "old_user_id", "new_user_id")
        self.concepts = self._pairs(concepts, "old_concept_id", "new_concept_id")
        self.drugs = self._pairs(drugs, "drug_id", "new_drug_id")

    def stored(self, spark: SparkSession) -> KeyMaps:
        """The maps as tables. They are derived once for all columns that go through them, and their sizes are known when
        a join is planned: Spark broadcasts those below its own threshold and shuffles the others."""
        path, kept = fresh_path(spark, "key-maps"), object.__new__(KeyMaps)
        for name, df in vars(self).items():
            df.write.parquet(f"{path}/{name}")
            setattr(kept, name, spark.read.schema(df.schema).parquet(f"{path}/{name}"))
        return kept

    @staticmethod
    def _pairs(table: DataFrame, old: str, new: str) -> DataFrame:
        pairs = table.groupBy(F.col(old).alias("_old")).agg(F.min(new).alias("_new"))
        return pairs


def left_lookup(df: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Left join to a table with one row per ``key``.

    Rows without a key match nothing; where the join is a shuffle they are spread rather than sent to one task.
    """
    spread = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(*df.columns), F.lit(SPREAD)) + 1).otherwise(F.lit(0).cast("bigint"))
    # zero for all, but not a literal, which the optimizer would take out of the join's keys
    met = F.pmod(F.xxhash64(key), F.lit(1).cast("bigint"))
    return df.withColumn("_spread", spread).join(table.withColumn("_spread", met), [key, "_spread"], "left").drop("_spread")


def remap_columns(df: DataFrame, columns: tuple[str, ...], pairs: DataFrame, missing: str = "null") -> DataFrame:
    """Replaces keys by their mapped values; without one: NULL, or the old key with ``missing="keep"``."""
    order = df.columns
    for c in columns:
        value = "_new" if missing == "null" else f"coalesce(_new, {c})"
        df = left_lookup(df, pairs.withColumnRenamed("_old", c), c).withColumn("_value", F.expr(value))
        df = df.drop("_new", c).withColumnRenamed("_value", c)
    return df.select(*order)


def remap_actor(df: DataFrame, columns: tuple[str, ...], maps: KeyMaps, missing: str = "null") -> DataFrame:
    """User columns of a row, old user to new user."""
    return remap_columns(df, columns, maps.users, missing)


def apply_mapping(spec: MappingSpec, src, maps: KeyMaps, missing: str = "null") -> DataFrame:
    """The target rows of a specification."""
    rows = src[spec.source]
    if spec.where:
        rows = rows.filter(spec.where)
    rows = rows.withColumn("uuid", row_uuid(spec.target, *[F.col(k) for k in spec.key]))
    rows = rows.selectExpr(*spec.select_list(), "uuid")
    rows = remap_columns(rows, spec.actors, maps.users, missing)
    return remap_columns(rows, spec.concepts, maps.concepts, missing)


def recode(df: DataFrame, column: str, pairs, out: str, otherwise=None) -> DataFrame:
    """Recodes an integer or text column by a table of fixed pairs; the rest becomes ``otherwise``."""
    kind = "string" if isinstance(pairs[0][0], str) else "bigint"
    value = "string" if isinstance(pairs[0][1], str) else "bigint"
    table = fixed_table(df.sparkSession, pairs, f"_from {kind}, _to {value}")
    joined = df.join(table, F.col(column) == F.col("_from"), "left")
    return joined.withColumn(out, F.coalesce("_to", F.lit(otherwise))).drop("_from", "_to")
