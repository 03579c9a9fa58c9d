"""Continuous upkeep of the read model.

Every micro-batch is folded to one row per patient and quarter it touches and
written as a delta of its own; reading folds the deltas. Since the fold is a
``max`` per slot, order and repetition of batches do not matter: a batch that
is run again overwrites its delta, late events find their quarter, and updates
are just later versions of the same row. The state is the delta table, so no
watermark is needed and nothing is dropped. ``compact`` folds deltas into a
base from time to time.

An event may come before the visit, enrolment or order that it refers to. Such
rows are kept as they are, and looked up again by every reading and every
``compact``, until what they refer to is there.

    <target>/deltas/source=obs/batch=0/...
    <target>/pending/obs/batch=0/...    rows that refer to what isn't there yet
    <target>/bases/v=1/...      folded deltas
    <target>/waiting/v=1/obs/...        rows of the folded batches that still wait
    <target>/index/v=1/...      which batches a base covers, written last
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from quarterfold.plans import readmodel
from quarterfold.plans.events import SLOTS, ClinicalEvents, Ordering
from quarterfold.operators.rows import not_processed
from quarterfold.plans.migration import latest_program, states_of_status, status_obs
from quarterfold.sources.scratch import delete, exists
from quarterfold.streaming.audit import Audit

FOLD_COLUMNS = ("patient_id", "quarter_start", *SLOTS)
INDEX_SCHEMA = "source string, last_batch bigint, v bigint"

EVENTS_OF: Mapping[str, Callable[[ClinicalEvents, DataFrame], DataFrame]] = {
    "obs": lambda e, batch: e.observations(batch),
    "patient_state": lambda e, batch: e.states(batch),
    "drug_order": lambda e, batch: e.drug_expiry(batch),
    "person": lambda e, batch: e.deaths(batch),
}
# What the rows of a source refer to: table and its key, which the source has too.
REFERS_TO: Mapping[str, tuple[str, str]] = {
    "obs": ("encounter", "encounter_id"),
    "patient_state": ("patient_program", "patient_program_id"),
    "drug_order": ("orders", "order_id"),
}


def _without_reference(source: str, rows: DataFrame, tables) -> DataFrame:
    """Rows that refer to a row which isn't there yet."""
    name, key = REFERS_TO[source]
    return rows.filter(F.col(key).isNotNull()).join(tables[name].select(key), key, "left_anti").select(*rows.columns)


def apply_batch(source: str, batch: DataFrame, batch_id: int, tables, target: str, ordering: Ordering = Ordering()) -> None:
    """Writes the fold of one micro-batch. Running it again has no further effect.

    What must wait is written first: a row that is referred to and comes in between makes an event twice, which changes
    nothing, rather than not at all.
    """
    if source in REFERS_TO:
        waits = _without_reference(source, batch, tables)
        waits.write.mode("overwrite").parquet(f"{target}/pending/{source}/batch={batch_id}")
    events = EVENTS_OF[source](ClinicalEvents(tables, ordering), batch)
    readmodel.fold(events).write.mode("overwrite").parquet(f"{target}/deltas/source={source}/batch={batch_id}")


def start_quarter_stream(
    sources: Mapping[str, DataFrame], tables, target: str, ordering: Ordering = Ordering(),
    trigger: Mapping[str, object] | None = None,
) -> list[StreamingQuery]:
    """Starts one query per event table (``obs``, ``patient_state``, ``drug_order``, ``person``).

    ``tables`` are the lookup tables, read anew by every batch.
    """
    started = []
    for name, stream in sources.items():
        def sink(batch: DataFrame, batch_id: int, name: str = name) -> None:
            apply_batch(name, batch, batch_id, tables, target, ordering)

        started.append(
            stream.writeStream.foreachBatch(sink)
            .option("checkpointLocation", f"{target}/checkpoints/{name}")
            .trigger(**(trigger or {"processingTime": "1 minute"}))
            .start()
        )
    return started


def _newest_base(spark: SparkSession, target: str) -> tuple[int, dict[str, int]]:
    """Version of the newest complete base (0: none) and the last batch it covers per source."""
    if not exists(spark, f"{target}/index"):  # nothing compacted yet
        return 0, {}
    index = spark.read.schema(INDEX_SCHEMA).parquet(f"{target}/index")
    newest = index.agg(F.max("v")).first()[0]
    return newest, _by_source(index.filter(F.col("v") == newest).select("source", "last_batch"))


def _by_source(last: DataFrame) -> dict[str, int]:
    """Last batch of each source, one row per source; a source nobody knows is an error."""
    found = {r.source: r.last_batch for r in last.collect()}
    if unknown := sorted(set(found) - set(EVENTS_OF)):
        raise ValueError(f"unknown sources {unknown}; known: {sorted(EVENTS_OF)}")
    return found


def _deltas(spark: SparkSession, target: str, covered: Mapping[str, int]) -> DataFrame:
    deltas = spark.read.parquet(f"{target}/deltas")
    for source, last in covered.items():
        deltas = deltas.filter((F.col("source") != source) | (F.col("batch") > last))
    return deltas


def _pending(spark: SparkSession, target: str, version: int, covered: Mapping[str, int], upto: Mapping[str, int] | None = None) -> dict[str, DataFrame]:
    """By source the rows that wait: those of the base, and those of the batches after it (as far as ``upto``)."""
    found = {}
    for source in REFERS_TO:
        parts = []
        if exists(spark, f"{target}/pending/{source}"):
            rows = spark.read.parquet(f"{target}/pending/{source}").filter(F.col("batch") > covered.get(source, -1))
            if upto is not None:
                rows = rows.filter(F.col("batch") <= upto.get(source, -1))
            parts.append(rows.drop("batch"))
        if version and exists(spark, f"{target}/waiting/v={version}/{source}"):
            parts.append(spark.read.parquet(f"{target}/waiting/v={version}/{source}"))
        if parts:
            found[source] = reduce(DataFrame.unionByName, parts)
    return found


def _found_late(pending: Mapping[str, DataFrame], tables, ordering: Ordering) -> list[DataFrame]:
    events = ClinicalEvents(tables, ordering)
    return [EVENTS_OF[source](events, rows).select(*FOLD_COLUMNS) for source, rows in pending.items()]


def current_quarters(spark: SparkSession, target: str, tables, ordering: Ordering = Ordering()) -> DataFrame:
    """Folded quarters as of now: the newest base, the deltas after it, and what waited and is found by now."""
    version, covered = _newest_base(spark, target)
    parts = [_deltas(spark, target, covered).select(*FOLD_COLUMNS)]
    if version:
        parts.append(spark.read.parquet(f"{target}/bases/v={version}").select(*FOLD_COLUMNS))
    parts += _found_late(_pending(spark, target, version, covered), tables, ordering)
    return readmodel.fold(reduce(DataFrame.unionByName, parts))


def compact(spark: SparkSession, target: str, tables, ordering: Ordering = Ordering()) -> int:
    """Folds all deltas present, and what waited and is found by now, into a new base; returns its version."""
    version, covered = _newest_base(spark, target)
    deltas = _deltas(spark, target, covered)
    seen = deltas.groupBy("source").agg(F.max("batch").cast("bigint").alias("last_batch"))
    last = covered | _by_source(seen)
    upto = F.lit(False)
    for source, batch in last.items():
        upto = upto | ((F.col("source") == source) & (F.col("batch") <= batch))
    pending = _pending(spark, target, version, covered, last)
    for source, rows in pending.items():  # before the fold, as in apply_batch
        _without_reference(source, rows, tables).write.mode("overwrite").parquet(f"{target}/waiting/v={version + 1}/{source}")
    parts = [deltas.filter(upto).select(*FOLD_COLUMNS), *_found_late(pending, tables, ordering)]
    if version:
        parts.append(spark.read.parquet(f"{target}/bases/v={version}").select(*FOLD_COLUMNS))
    readmodel.fold(reduce(DataFrame.unionByName, parts)).write.mode("overwrite").parquet(f"{target}/bases/v={version + 1}")
    index = spark.createDataFrame(list(last.items()), "source string, last_batch bigint")
    index.coalesce(1).write.mode("overwrite").parquet(f"{target}/index/v={version + 1}")
    _remove_covered(spark, target, version, covered)
    return version + 1


def _remove_covered(spark: SparkSession, target: str, version: int, covered: Mapping[str, int]) -> None:
    """Removes what neither the newest base nor the one before it needs, so that a reader that began before this
    compaction still finds all it reads: batches that the base before had folded, but for the last, and the bases before."""
    removed = _removed(spark, target)
    for source, last in covered.items():
        for batch in range(removed.get(source, 0), last):
            delete(spark, f"{target}/deltas/source={source}/batch={batch}")
            delete(spark, f"{target}/pending/{source}/batch={batch}")
    if version:
        delete(spark, f"{target}/bases/v={version - 1}")
        delete(spark, f"{target}/waiting/v={version - 1}")


def _removed(spark: SparkSession, target: str) -> dict[str, int]:
    """By source the batch before which an earlier compaction removed all."""
    index = spark.read.schema(INDEX_SCHEMA).parquet(f"{target}/index")
    newest = index.agg(F.max("v")).first()[0]
    return _by_source(index.filter(F.col("v") == newest - 2).select("source", "last_batch"))


def current_model(spark: SparkSession, target: str, tables, as_of: str, ordering: Ordering = Ordering()) -> readmodel.ReadModel:
    """The read model of everything that has arrived."""
    words = ClinicalEvents(tables, ordering).words
    return readmodel.from_quarters(current_quarters(spark, target, tables, ordering), tables, words, as_of, ordering)


def start_status_stream(
    obs: DataFrame, src, dst, target: str, trigger: Mapping[str, object] | None = None
) -> StreamingQuery:
    """States from treatment-status observations, each observation once.

    Every batch takes out what earlier batches have audited, then writes its states and its audit rows under its own
    number, so a batch that is run again replaces what it wrote. A batch reads only those parts of the audit that it may hit.
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        audit = Audit(batch.sparkSession, f"{target}/audit", "obs_id")
        offered = status_obs(batch, dst).persist()
        fresh = not_processed(offered, audit.known(offered, batch_id), "obs_id").persist()
        try:
            fresh.count()  # kept from here on, so that its size is known to the joins
            states, done = states_of_status(fresh, latest_program(src, fresh.select("person_id")), dst)
            states.write.mode("overwrite").parquet(f"{target}/states/batch={batch_id}")
            audit.add(done, batch_id)
        finally:
            fresh.unpersist()
            offered.unpersist()

    return (
        obs.writeStream.foreachBatch(sink)
        .option("checkpointLocation", f"{target}/checkpoints/status")
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )
