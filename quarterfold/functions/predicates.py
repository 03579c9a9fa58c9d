"""Predicate builders."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from quarterfold.functions.text import ci, ci_prefix


def any_of(*preds: Column) -> Column:
    return reduce(or_, preds)


def is_set(c: Column) -> Column:
    """Known value. Zero dates are turned into NULL when a table is read."""
    return c.isNotNull()


def band(c: Column, lo: float | None = None, hi: float | None = None) -> Column:
    """``lo <= c <= hi`` with open ends."""
    if lo is None:
        return c <= hi
    if hi is None:
        return c >= lo
    return c.between(lo, hi)


def eq_default(c: Column, default, value) -> Column:
    """Equality after NULL is replaced by ``default``; text compares without case."""
    filled = F.coalesce(c, F.lit(default))
    if isinstance(value, str):
        return ci(filled) == F.lit(value.rstrip().lower())
    return filled == F.lit(value)


def none_of(c: Column, values: Iterable[str], prefixes: Iterable[str] = ()) -> Column:
    """Two-valued "none of these texts": NULL counts as the empty text."""
    filled = F.coalesce(c, F.lit(""))
    keys = [v.rstrip().lower() for v in values]
    return ~any_of(ci(filled).isin(keys), *[ci_prefix(filled, p) for p in prefixes])


def not_any3(*preds: Column) -> Column:
    """Three-valued "none of these": an unknown arm leaves the row out of a filter."""
    return ~any_of(*preds)


def case_pred(cond: Column, pred: Column) -> Column:
    """``pred`` where ``cond`` holds, else false."""
    return F.when(cond, pred).otherwise(F.lit(False))


def not_voided(df: DataFrame) -> DataFrame:
    """Rows that were not soft-deleted."""
    return df.filter(F.col("voided") == 0)
