"""Registered streaming queries: clinical tables arrive as files, the model is read back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks.queries_migration import Run
from checks.sql_readmodel import AS_OF
from quarterfold.fixtures import Fixtures, fixtures_of
from quarterfold.plans import migration, readmodel
from quarterfold.plans.events import Ordering
from quarterfold.sources.scratch import delete, fresh_path, shuffles_removed
from quarterfold.streaming import store, upkeep

ALL_NOW = {"availableNow": True}
FILES_PER_BATCH = 12
# Time column that splits a source into arriving files.
SPLIT_BY = {"obs": "obs_datetime", "patient_state": "start_date", "drug_order": None, "person": "date_created"}
_streamed: dict[tuple[str, str], str] = {}


def _arriving(spark: SparkSession, fixtures: Fixtures, name: str, folder: str, files: int) -> DataFrame:
    """The rows of a table as a stream of files, a year at a time."""
    split = SPLIT_BY[name]
    rows = fixtures[name]
    year = F.year(split) if split else F.lit(0)
    # files of even size, so that there are more of them, and more batches, only as there are more rows
    rows = rows.withColumn("arrival_year", year).hint("rebalance", "arrival_year")
    rows.write.partitionBy("arrival_year").parquet(f"{folder}/{name}")
    schema = spark.read.parquet(f"{folder}/{name}").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(f"{folder}/{name}")
    return stream.drop("arrival_year")


def _stream_model(spark: SparkSession, sf_dir: str) -> readmodel.ReadModel:
    """Streams everything once per session and folder, compacting half way."""
    fixtures = fixtures_of(spark, sf_dir)
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _streamed:
        target, folder = fresh_path(spark, "upkeep"), fresh_path(spark, "arriving")
        obs = {"obs": _arriving(spark, fixtures, "obs", folder, FILES_PER_BATCH)}
        rest = {n: _arriving(spark, fixtures, n, folder, 1000) for n in SPLIT_BY if n != "obs"}
        for q in upkeep.start_quarter_stream(obs, fixtures, target, trigger=ALL_NOW):
            q.awaitTermination()
        upkeep.compact(spark, target, fixtures)
        for q in upkeep.start_quarter_stream(rest, fixtures, target, trigger=ALL_NOW):
            q.awaitTermination()
        _streamed[key] = target
    return upkeep.current_model(spark, _streamed[key], fixtures, AS_OF)


def _late_lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events are streamed and compacted before any visit, enrolment or order is there."""
    fixtures = fixtures_of(spark, sf_dir)
    late = {name for name, _ in upkeep.REFERS_TO.values()}

    class Before:
        def __getitem__(self, name: str) -> DataFrame:
            return fixtures[name].filter("false") if name in late else fixtures[name]

    target, folder = fresh_path(spark, "upkeep"), fresh_path(spark, "arriving")
    sources = {n: _arriving(spark, fixtures, n, folder, 1000) for n in SPLIT_BY}
    for q in upkeep.start_quarter_stream(sources, Before(), target, trigger=ALL_NOW):
        q.awaitTermination()
    upkeep.compact(spark, target, Before())
    return upkeep.current_model(spark, target, fixtures, AS_OF).report


# What an earlier state of a row said, by table: values that the read model would show.
EARLIER = {
    "obs": {"obs_datetime": "obs_datetime + INTERVAL 100 DAYS", "value_coded": "coalesce(value_coded, 0L) + 1", "value_text": "'9Z'"},
    "person": {"dead": "CAST(1 AS SMALLINT)", "death_date": "TIMESTAMP_NTZ'2001-01-01 00:00:00'", "gender": "'?'"},
    "drug_order": {"quantity": "quantity * 7"},
}
_stored: dict[tuple[str, str], store.PatientStore] = {}


def _earlier(table: str, rows: DataFrame, where: str = "TRUE") -> DataFrame:
    """The rows, those that the condition names in an earlier state."""
    return rows.withColumns({c: F.when(F.expr(where), F.expr(e).cast(rows.schema[c].dataType)).otherwise(F.col(c))
                             for c, e in EARLIER[table].items()})


def _stored_model(spark: SparkSession, sf_dir: str) -> readmodel.ReadModel:
    """Rows arrive in earlier states, then as they are, then once more in states older still; the rest is loaded first."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stored:
        with shuffles_removed(spark):
            _stored[key] = _stored_by_streams(spark, fixtures_of(spark, sf_dir))
    return _stored[key].model()


def _stored_by_streams(spark: SparkSession, fixtures: Fixtures) -> store.PatientStore:
    made = store.PatientStore(spark, fresh_path(spark, "store"), fixtures, AS_OF, "ver", buckets=16)
    first, waves, folder = {}, [{}, {}], fresh_path(spark, "arriving")
    for name in store.TABLES:
        rows, id_column = fixtures[name].withColumn("ver", F.lit(2)), store.TABLES[name][0]
        if name not in EARLIER:
            first[name] = rows
            continue
        rows.write.parquet(f"{folder}/now/{name}")  # made once, read by all that follows
        rows = spark.read.parquet(f"{folder}/now/{name}")
        first[name] = _earlier(name, rows.filter(F.col(id_column).isNotNull()), f"{id_column} % 5 = 0")
        waves[0][name] = rows.filter(F.col(id_column) % 5 == 0).withColumn("ver", F.lit(3))
        waves[1][name] = _earlier(name, rows.filter(F.col(id_column) % 7 == 0)).withColumn("ver", F.lit(1))
    made.load(first)
    for number, wave in enumerate(waves):  # a wave is a batch of each source; streams go on where they stopped
        streams = {}
        for name, rows in wave.items():
            rows.write.parquet(f"{folder}/{name}/wave={number}")
            streams[name] = spark.readStream.schema(rows.schema).parquet(f"{folder}/{name}/wave=*")
        for q in store.start_report_stream(made, streams, ALL_NOW):
            q.awaitTermination()
        made.vacuum()
    delete(spark, f"{folder}/now")
    return made


def _by_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last arrival wins; rows arrive in an order unrelated to their dates."""
    keys = {"obs": "obs_id", "patient_state": "patient_state_id", "drug_order": "order_id", "person": "person_id"}
    fixtures = fixtures_of(spark, sf_dir)

    class Numbered:
        def __getitem__(self, name: str) -> DataFrame:
            table = fixtures[name]
            return table.withColumn("arrived", F.expr(f"({keys[name]} * 7919) % 100003")) if name in keys else table

    return readmodel.build(Numbered(), AS_OF, Ordering(arrival="arrived")).report


def _status_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status observations offered twice, as two waves of files."""
    run = Run(spark, sf_dir)
    folder, target = fresh_path(spark, "status"), fresh_path(spark, "status-states")
    obs = migration.obs_mapped(run.src, run.dst, run.maps).drop("uuid")
    obs.write.parquet(f"{folder}/first")
    again = spark.read.parquet(f"{folder}/first")
    again.write.parquet(f"{folder}/waves/wave=1")
    again.write.parquet(f"{folder}/waves/wave=2")
    stream = (
        spark.readStream.schema(spark.read.parquet(f"{folder}/waves").schema)
        .option("maxFilesPerTrigger", 3).parquet(f"{folder}/waves").drop("wave")
    )
    upkeep.start_status_stream(stream, run.src, run.dst, target, ALL_NOW).awaitTermination()
    return spark.read.parquet(f"{target}/states").drop("batch")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stream_patient_report": lambda s, d: _stream_model(s, d).report,
    "stream_patient_quarter": lambda s, d: _stream_model(s, d).details,
    "stream_late_lookups": _late_lookups,
    "stream_updates_report": lambda s, d: _stored_model(s, d).report,
    "stream_updates_quarter": lambda s, d: _stored_model(s, d).details,
    "stream_states_once": _status_stream,
    "patient_report_by_arrival": _by_arrival,
}
