"""Readers for relational sources and whole-table copies."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, StringType, StructType, TimestampNTZType, TimestampType

from quarterfold.sources.scratch import exists


@dataclass(frozen=True)
class Source:
    """Where the tables of an environment are: a folder of parquet tables, or a JDBC database."""

    path: str | None = None
    url: str | None = None
    options: Mapping[str, str] | None = None


def read_table(
    spark: SparkSession, source: Source, name: str, schema: StructType | None = None,
    partition_key: str | None = None, bounds: tuple[int, int] | None = None, partitions: int = 200,
) -> DataFrame:
    """A table of a source with clean dates.

    A JDBC read is split over ``partitions`` by ``partition_key`` within
    ``bounds``; rows outside the bounds are read too, by the outer partitions.
    """
    if source.path is not None:
        # with the files' own types: dates may be kept as text, which a read by ``schema`` would refuse
        return clean_dates(spark.read.parquet(f"{source.path}/{name}"), schema)
    if source.url is None:
        raise ValueError("a source needs a path or a url")
    reader = spark.read.format("jdbc").option("url", source.url).option("dbtable", name).options(**(source.options or {}))
    if partition_key is not None:
        if bounds is None:
            raise ValueError("bounds go with a partition key")
        reader = reader.options(
            partitionColumn=partition_key, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=partitions
        )
    return clean_dates(reader.load(), schema)


def clean_dates(df: DataFrame, schema: StructType | None = None) -> DataFrame:
    """Turns zero dates and blank or broken date texts into NULL, typed as in ``schema``."""
    if schema is None:
        return df
    cleaned = []
    for field in schema.fields:
        c = F.col(field.name)
        is_date = isinstance(field.dataType, (DateType, TimestampType, TimestampNTZType))
        if is_date and isinstance(df.schema[field.name].dataType, StringType):
            c = F.when(~c.startswith("0000-00-00"), c.try_cast(field.dataType))
        cleaned.append(c.alias(field.name))
    return df.select(*cleaned)


def copy_tables(
    spark: SparkSession, source: Source, names: Iterable[str], target: str, schemas: Mapping[str, StructType] | None = None
) -> int:
    """Copies whole reference tables as a new version of the set; returns its number.

    Each table is one distributed read and write. The manifest is written last, so readers see the old set until the new
    one is whole, and a copy that broke off leaves the old one.
    """
    names, version = list(names), (_copied_version(spark, target) or 0) + 1
    for name in names:
        table = read_table(spark, source, name, (schemas or {}).get(name))
        table.write.mode("overwrite").parquet(f"{target}/v={version}/{name}")
    manifest = spark.createDataFrame([(n,) for n in names], "name string").coalesce(1)
    manifest.write.mode("overwrite").parquet(f"{target}/manifest/v={version}")
    return version


def _copied_version(spark: SparkSession, target: str) -> int | None:
    if not exists(spark, f"{target}/manifest"):
        return None
    return spark.read.schema("name string, v int").parquet(f"{target}/manifest").agg(F.max("v")).first()[0]


def read_copied(spark: SparkSession, target: str, name: str) -> DataFrame:
    """A table of the newest complete copy."""
    version = _copied_version(spark, target)
    if version is None:
        raise ValueError(f"nothing is copied to {target}")
    return spark.read.parquet(f"{target}/v={version}/{name}")
