"""Headline timings. Prints one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1) and ``BENCH_CPUS`` choose data and cores.
The clinical tables are projected and written once beforehand, untimed, as a record system
would hold them. Each timing covers building the plan and running it to the end on all rows;
the best of ``BENCH_RUNS`` runs counts.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession

from checks import queries
from checks.queries_migration import Run
from quarterfold.fixtures import TABLES, Renamed, fixtures_of
from quarterfold.operators import rules
from quarterfold.plans import migration, readmodel, report
from quarterfold.plans.indicators import INDICATORS
from quarterfold.sources.scratch import fresh_path


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


class StoredTables:
    """The clinical tables as parquet, written once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.fixtures, self.path = spark, fixtures_of(spark, sf_dir), fresh_path(spark, "clinical")
        self.stored: dict[str, DataFrame] = {}
        for name in TABLES:
            if name not in ("li", "visit_item", "drug_item", "first_art"):
                self.fixtures[name].write.parquet(f"{self.path}/{name}")
                self.stored[name] = spark.read.parquet(f"{self.path}/{name}")

    def __getitem__(self, name: str) -> DataFrame:
        return self.stored[name]


def timed(run, runs: int) -> float:
    best = float("inf")
    for _ in range(runs):
        began = time.perf_counter()
        run()
        best = min(best, time.perf_counter() - began)
    return round(best, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false")
        .config("spark.sql.codegen.hugeMethodLimit", "8000")  # larger methods are not compiled to machine code
        .config("spark.driver.memory", "12g").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    tables = StoredTables(spark, sf_dir)
    model_path = fresh_path(spark, "model")
    readmodel.write(spark, tables, queries.AS_OF, model_path)
    model = readmodel.read(spark, model_path)

    def write_model():
        readmodel.write(spark, tables, queries.AS_OF, fresh_path(spark, "bench"))

    def migrate():
        r = Run(spark, sf_dir, tables)
        for step in (
            lambda: migration.patient_to_person(r.src, r.maps)[0], lambda: migration.encounters(r.src, r.dst, r.maps),
            lambda: migration.obs_mapped(r.src, r.dst, r.maps), lambda: migration.orders_mapped(r.src, r.maps),
            lambda: migration.drug_orders(r.src, r.maps), lambda: migration.states_from_orders(r.src, r.dst, r.maps),
            lambda: migration.regimen_obs(r.src, r.dst, r.maps, queries.AS_OF),
            lambda: migration.eligibility_obs(r.src, r.dst, r.maps, queries.AS_OF),
        ):
            drain(step())

    took = {
        "read_model_write": timed(write_model, runs),
        "patient_quarter": timed(lambda: drain(readmodel.build(tables, queries.AS_OF).details), runs),
        "cohort_report": timed(lambda: report.cohort_report(
            spark, model.report, model.details, *queries.PERIOD_B).collect(), runs),
        "cohort_report_all_quarters": timed(
            lambda: drain(report.report_all_quarters(spark, model.report, model.details, *queries.YEARS)), runs),
        "migration": timed(migrate, runs),
        "rule_reason": timed(lambda: drain(rules.art_eligibility_reason(Renamed(tables, "src_"), queries.AS_OF)), runs),
    }
    separate = timed(
        lambda: [report.indicator(n, model.report, model.details, *queries.PERIOD_B).collect() for n in INDICATORS], 1)
    print(json.dumps({
        "metric": "headline queries, total wall time", "value": round(sum(took.values()), 3), "unit": "sec",
        "queries": took, "sf": os.path.basename(sf_dir),
        "report_in_82_separate_passes": separate,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
