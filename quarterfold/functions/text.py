"""Text comparison and formatting.

The record system compares text without regard to case and trailing blanks.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F


def ci(c: Column) -> Column:
    """Comparison key of a text column."""
    return F.lower(F.rtrim(c))


def ci_equals(c: Column, value: str) -> Column:
    return ci(c) == F.lit(value.rstrip().lower())


def ci_in(c: Column, values: Iterable[str]) -> Column:
    return ci(c).isin([v.rstrip().lower() for v in values])


def ci_prefix(c: Column, prefix: str) -> Column:
    return F.lower(c).startswith(prefix.lower())


def title_case(c: Column) -> Column:
    """Each word capitalised, runs of blanks collapsed."""
    return F.initcap(F.regexp_replace(F.trim(c), r"\s+", " "))


def row_uuid(table: str, *key: Column) -> Column:
    """Identifier that is the same whenever the same row is written again."""
    h = F.sha2(F.concat_ws(":", F.lit(table), *[k.cast("string") for k in key]), 256)
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *[F.substring(h, at, n) for at, n in cuts])
