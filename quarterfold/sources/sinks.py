"""Upserts, appends, quarantine and exports."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from quarterfold.operators.rows import any_per


def upsert(target: DataFrame, batch: DataFrame, key: str, order: str | None = None, reset: tuple[str, ...] = ()) -> DataFrame:
    """Target with the new keys of a batch added; an existing key is left as it is.

    Of equal keys within the batch the one lowest in ``order`` counts. Columns
    in ``reset`` are set from the batch on existing rows too.
    """
    first = any_per(batch, key, order) if order else batch
    added = first.join(target.select(key), key, "left_anti").select(*target.columns)
    if not reset:
        return target.unionByName(added)
    changes = first.select(key, *[F.col(c).alias(f"_{c}") for c in reset], F.lit(True).alias("_given"))
    kept = target.join(changes, key, "left")
    for c in reset:
        kept = kept.withColumn(c, F.when(F.col("_given"), F.col(f"_{c}")).otherwise(F.col(c)))
    return kept.select(*target.columns).unionByName(added)


def write_upsert(target: DataFrame, batch: DataFrame, key: str, path: str, order: str | None = None) -> None:
    """Writes the upserted table as a new version; the version read stays untouched."""
    upsert(target, batch, key, order).write.mode("error").parquet(path)


def append(batch: DataFrame, path: str, number: int) -> None:
    """Adds the rows of a numbered batch without looking at keys. A batch that is run again replaces what it wrote, so
    every batch is in the table once; ``appended`` reads it."""
    batch.write.mode("overwrite").parquet(f"{path}/batch={number}")


def appended(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of all batches."""
    rows = spark.read.schema(StructType([*schema.fields, StructField("batch", LongType())])).parquet(path)
    return rows.drop("batch")


def split_valid(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that break no rule, and the others with their ``errors``.

    A rule is a condition that must not hold; an unknown condition is not an error.
    """
    errors = F.filter(F.array(*[F.when(broken, F.lit(name)) for name, broken in rules.items()]), lambda e: e.isNotNull())
    marked = df.withColumn("errors", errors)
    return marked.filter(F.size("errors") == 0).drop("errors"), marked.filter(F.size("errors") > 0)


def without_rejected(df: DataFrame, rejects: DataFrame, key: str = "patient_id") -> DataFrame:
    """The rest of a rejected patient is skipped."""
    return df.join(rejects.select(key).distinct(), key, "left_anti")


def export_tables(order: Iterable[str], table: Callable[[str], DataFrame], path: str, null_value: str | None = None) -> None:
    """Writes tables in dependency order: parquet, or CSV with ``null_value`` for missing values."""
    for name in order:
        df = table(name)
        if null_value is None:
            df.write.mode("overwrite").parquet(f"{path}/{name}")
        else:
            df.write.mode("overwrite").option("header", True).option("nullValue", null_value).csv(f"{path}/{name}")
