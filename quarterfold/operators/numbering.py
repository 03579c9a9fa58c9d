"""Places of rows in an order, without one global sort and without a window over everything.

Rows are dealt to ranges of the order and written as a table that remembers each row's range. A row's place is the
number of rows in the ranges before, from one count a range, and its place inside its range. Ranges are cut by
sampling, so a task sees about an even share of the rows, however sparse or crowded the keys are. The table is needed:
a second sample would cut elsewhere.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, functions as F

from quarterfold.sources.scratch import fresh_path


def _free(name: str, taken: Sequence[str]) -> str:
    while name.lower() in {t.lower() for t in taken}:
        name = f"_{name}"
    return name


@dataclass
class Ranges:
    """Rows dealt to ranges of an order; ``part`` is the column with the range."""

    rows: DataFrame
    part: str
    order: list[Column]

    def counts(self) -> list[int]:
        """Rows of each range in order: one number a range comes to the driver."""
        found = {r[0]: r[1] for r in self.rows.groupBy(self.part).agg(F.count(F.lit(1))).collect()}
        return [found.get(i, 0) for i in range(max(found, default=-1) + 1)]


def _columns(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def ranges(df: DataFrame, order: Sequence[Column | str], group: Sequence[str] = (), n: int | None = None) -> Ranges:
    """Deals the rows to ``n`` ranges of the groups and the order, by default one a shuffle partition."""
    spark = df.sparkSession
    n = n or int(spark.conf.get("spark.sql.shuffle.partitions"))
    part, path, order = _free("_part", df.columns), fresh_path(spark, "ranges"), _columns(order)
    dealt = df.repartitionByRange(n, *group, *order).withColumn(part, F.spark_partition_id())
    dealt.write.parquet(path)
    return Ranges(spark.read.schema(dealt.schema).parquet(path), part, order)


def _inside(r: Ranges, group: Sequence[str] = ()) -> Column:
    return F.row_number().over(Window.partitionBy(*group, r.part).orderBy(*r.order)) - 1


def with_position(df: DataFrame, order: Sequence[Column | str], name: str, n: int | None = None) -> DataFrame:
    """``df`` with the place of each row in the order, from 0. Rows that are equal in the order get places in any order."""
    r = ranges(df, order, n=n)
    before = [0, *accumulate(r.counts())]
    offset = F.element_at(F.lit(before).cast("array<bigint>"), F.col(r.part) + 1)
    return r.rows.withColumn(name, (offset + _inside(r)).cast("bigint")).drop(r.part)


def with_position_in(df: DataFrame, group: str, order: Sequence[Column | str], name: str, total: str) -> DataFrame:
    """``df`` with the place of each row among those of its group, from 0, and their number. Groups may be of any size; a
    group's counts are one a range. The group must not be null."""
    r = ranges(df, order, [group])
    taken = [*df.columns, r.part]
    n, before = _free("_n", taken), _free("_before", taken)
    counts = r.rows.groupBy(group, r.part).agg(F.count(F.lit(1)).alias(n))
    of_group = Window.partitionBy(group)
    offsets = counts.select(
        group, r.part, F.sum(n).over(of_group).alias(total),
        (F.sum(n).over(of_group.orderBy(r.part)) - F.col(n)).alias(before))
    placed = r.rows.withColumn(name, _inside(r, [group])).join(offsets, [group, r.part])
    return placed.withColumn(name, (F.col(before) + F.col(name)).cast("bigint")).select(*df.columns, name, total)


def page(df: DataFrame, order: Sequence[Column | str], offset: int, size: int, n: int | None = None) -> DataFrame:
    """The rows in places ``offset`` to ``offset + size - 1``. Only ranges that the page touches are read again."""
    r = ranges(df, order, n=n)
    before = [0, *accumulate(r.counts())]
    touched = [i for i in range(len(before) - 1) if before[i] < offset + size and before[i + 1] > offset]
    if not touched:
        return r.rows.drop(r.part).limit(0)
    place = _free("_place", [*df.columns, r.part])
    offsets = F.element_at(F.lit(before).cast("array<bigint>"), F.col(r.part) + 1)
    rows = r.rows.filter(F.col(r.part).between(touched[0], touched[-1]))
    placed = rows.withColumn(place, offsets + _inside(r))
    return placed.filter((F.col(place) >= offset) & (F.col(place) < offset + size)).select(*df.columns)
