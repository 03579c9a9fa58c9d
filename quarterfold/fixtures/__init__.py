"""Clinical tables projected from the benchmark star schema.

Every table is one SELECT text that runs unchanged on Spark and on the SQL
engine used for checking; only the name of the zone-less timestamp type
differs. ``{name}`` stands for another table of the set.
"""

from __future__ import annotations

import string
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from quarterfold.fixtures.source_side import SOURCE_SIDE
from quarterfold.fixtures.target_side import TARGET_SIDE
from quarterfold.operators.rows import dealt

RAW = ("customer", "orders", "lineitem", "part", "nation", "events")
TABLES: dict[str, str] = {**TARGET_SIDE, **SOURCE_SIDE}


@lru_cache(maxsize=None)
def references(name: str) -> tuple[str, ...]:
    """Tables a projection reads, in order of first use."""
    seen: list[str] = []
    for _, ref, _, _ in string.Formatter().parse(TABLES[name]):
        if ref and ref != "ts" and ref not in seen:
            seen.append(ref)
    return tuple(seen)


def with_dependencies(names: list[str]) -> list[str]:
    """``names`` and all they read, each after what it reads, raw tables left out."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name.startswith("raw_") or name in ordered:
            return
        for ref in references(name):
            visit(ref)
        ordered.append(name)

    for n in names:
        visit(n)
    return ordered


class Fixtures:
    """Lazily built clinical DataFrames over one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            if name.startswith("raw_"):
                self._built[name] = self.spark.read.parquet(f"{self.sf_dir}/{name[4:]}.parquet")
            else:
                refs = {r: self[r] for r in references(name)}
                if name == "li":  # grouped, and joined to orders, where the rows of an order are
                    refs["raw_lineitem"] = dealt(refs["raw_lineitem"], "l_orderkey")
                text = TABLES[name].replace("{ts}", "TIMESTAMP_NTZ")
                self._built[name] = self.spark.sql(text, **refs)
        return self._built[name]


_known: dict[tuple[str, str], Fixtures] = {}


def fixtures_of(spark: SparkSession, sf_dir: str) -> Fixtures:
    """The fixtures of a folder, with the same (lazy) DataFrames throughout a session."""
    return _known.setdefault((spark.sparkContext.applicationId, sf_dir), Fixtures(spark, sf_dir))


class Renamed:
    """Tables of a prefix under their plain names; a name without a prefixed table stays as it is."""

    def __init__(self, tables: Fixtures, prefix: str):
        self.tables, self.prefix = tables, prefix

    def __getitem__(self, name: str) -> DataFrame:
        prefixed = self.prefix + name
        return self.tables[prefixed if prefixed in TABLES else name]
