"""Row selection and grouping steps shared by the jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from quarterfold.operators.numbering import with_position


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt by keys over as many tasks as the session's shuffles have, ahead of steps that sort or hash them there.

    Wide rows with few values shrink very much in a shuffle. Were tasks sized by what is left of them, as adaptive execution
    does, their rows would not fit the memory of a task and be spilled.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def latest_per(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The last row of each key in the given order. Partially aggregated before the shuffle."""
    return _extreme(df, key, order, F.max)


def earliest_per(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The first row of each key in the given order."""
    return _extreme(df, key, order, F.min)


def any_per(df: DataFrame, key: str, id_column: str) -> DataFrame:
    """One row of each key, made repeatable by taking the lowest id."""
    return _extreme(df, key, [id_column], F.min)


def _extreme(df: DataFrame, key: str, order: Sequence[str], pick) -> DataFrame:
    # The order columns lead the struct, so the extreme struct is the wanted row.
    rest = [c for c in df.columns if c != key and c not in order]
    packed = df.groupBy(key).agg(pick(F.struct(*order, *rest)).alias("_row"))
    return packed.select(*[F.col(c) if c == key else F.col(f"_row.{c}").alias(c) for c in df.columns])


def semi(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    return df.join(keys, on, "left_semi")


def not_processed(df: DataFrame, audit: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in the audit table."""
    return df.join(audit.select(key), key, "left_anti")


def sequential_ids(df: DataFrame, order_id: str, start: int, out: str, ranges: int | None = None) -> DataFrame:
    """Numbers rows ``start, start + 1, ...`` in the order of a unique id, by counts of ranges: no task sees all rows, and
    sparse ids make no more ranges than dense ones."""
    return with_position(df, [order_id], out, ranges).withColumn(out, F.col(out) + start)
