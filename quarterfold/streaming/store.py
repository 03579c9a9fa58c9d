"""The per-patient tables, stored and kept current by streams, updates of rows included.

Rows of all clinical tables are kept by the bucket of their patient. A row may come again with a higher version, in any
order: of each key the row with the highest version counts, of equal ones the last to arrive. An update thereby takes
back what the row said before. A micro-batch

1. adds its rows to the buckets of their patients (drug orders and states find theirs by a keyed index; a row whose
   owner isn't there yet waits, and is looked for again by later batches); a row that comes after a higher version of it
   can't count any more and is left out, so its patient isn't derived again;
2. derives the patients it touches anew, from their own buckets alone, some buckets at a time; where they are most of the
   patients of these buckets, all of them are derived, which saves picking rows and patients out;
3. writes the touched buckets of ``report`` and ``details`` under its own number, other patients' rows as they were;
4. writes the manifest, which says where each bucket's newest rows are and which batches are in. Readers go by the newest
   manifest, so they see all of a batch or nothing; a batch that is run again is passed over, one that broke off is redone.

Batches of other sources that come in while one is taken in wait, and are then taken in together, as one. A batch waits a
little for streams that are at work on one of theirs, as streams started together mostly are: patients that several of them
touch are then derived once.

The work of a batch grows with the buckets it touches, not with the tables. What its steps shuffle is removed as soon as they
are done, so adding takes the disk of the batch's rows, deriving that of ``at_once`` rows or of one bucket. Rows without a key
count as one in each round of buckets, and a visit only for patients of the same round, so for its own patient always.
``vacuum`` removes what no manifest needs.

    <path>/rows/<table>/op=3/bucket=7/...      <path>/owners/<table>/op=3/slot=7/...     <path>/waiting/<table>/op=3/...
    <path>/report/op=3/bucket=7/...            <path>/details/op=3/bucket=7/...          <path>/manifest/op=3/...
"""

from __future__ import annotations

import threading
import time
from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from quarterfold.plans import readmodel
from quarterfold.plans.events import ClinicalEvents
from quarterfold.sources.scratch import delete, exists, shuffles_removed

# Key of each table, and the column with its patient.
TABLES: Mapping[str, tuple[str, str | None]] = {
    "obs": ("obs_id", "person_id"), "person": ("person_id", "person_id"), "patient": ("patient_id", "patient_id"),
    "encounter": ("encounter_id", "patient_id"), "orders": ("order_id", "patient_id"),
    "patient_program": ("patient_program_id", "patient_id"), "patient_state": ("patient_state_id", None),
    "drug_order": ("order_id", None),
}
# Tables whose patient is that of another table's row, with the key they share.
OWNED_BY: Mapping[str, tuple[str, str]] = {
    "patient_state": ("patient_program", "patient_program_id"), "drug_order": ("orders", "order_id"),
}
# Of the patients of the touched buckets, the share from which on all are derived.
MOST = 0.8
MANIFEST = "kind string, name string, number bigint, at bigint"


@dataclass(eq=False)
class Offer:
    """A micro-batch that waits to be taken in, and how that ended."""

    source: str
    batch: DataFrame
    number: int
    taken: bool = False
    error: BaseException | None = None


@dataclass
class State:
    """What the newest manifest says: its number, the number that wrote each bucket, the last batch of each source, and
    where rows of a table wait."""

    op: int = 0
    buckets: dict[int, int] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)
    waiting: dict[str, int] = field(default_factory=dict)

    def rows(self) -> list[tuple]:
        return [("bucket", None, b, at) for b, at in self.buckets.items()] + [
            ("batch", s, n, None) for s, n in self.batches.items()] + [("waiting", s, None, at) for s, at in self.waiting.items()]


def _by(rows: DataFrame, column: str) -> DataFrame:
    """Rows of one value together, in files of even size: a value of very many rows is written by several tasks."""
    return rows.hint("rebalance", column)


class _Touched:
    """Clinical tables of the touched patients; dictionaries as they are."""

    def __init__(self, own: Mapping[str, DataFrame], tables):
        self.own, self.tables = own, tables

    def __getitem__(self, name: str) -> DataFrame:
        return self.own[name] if name in self.own else self.tables[name]


class PatientStore:
    """``tables`` gives the dictionaries, and the schemas of the clinical tables. ``version`` names a column of the sources; a
    table without it goes by arrival. One store object writes at a time. ``at_once`` bounds the stored rows derived from in
    one go, down to those of one bucket. ``linger`` bounds the seconds that a batch waits for streams that are at work."""

    def __init__(
        self, spark: SparkSession, path: str, tables, as_of: str, version: str | None = None, buckets: int = 64,
        at_once: int = 16_000_000, linger: float = 20,
    ):
        self.spark, self.path, self.tables, self.as_of, self.version, self.n = spark, path, tables, as_of, version, buckets
        self.at_once, self.linger = at_once, linger
        self._streams: dict[str, StreamingQuery | None] = {}  # by source; None: being started
        self._lock, self._offered, self._queue = threading.Lock(), [], threading.Lock()

    # state ------------------------------------------------------------------

    def state(self) -> State:
        if not exists(self.spark, f"{self.path}/manifest"):
            return State()
        manifests = self.spark.read.schema(f"{MANIFEST}, op bigint").parquet(f"{self.path}/manifest")
        op = manifests.agg(F.max("op")).first()[0]
        found = State(op)
        for r in manifests.filter(F.col("op") == op).collect():  # a row a bucket and a source
            if r.kind == "bucket":
                found.buckets[r.number] = r["at"]
            elif r.kind == "batch":
                found.batches[r.name] = r.number
            elif r.kind == "waiting":
                found.waiting[r.name] = r["at"]
        return found

    def _write_state(self, state: State) -> None:
        rows = self.spark.createDataFrame(state.rows(), MANIFEST).coalesce(1)
        rows.write.mode("overwrite").parquet(f"{self.path}/manifest/op={state.op}")

    def _newest(self, table: str, state: State, buckets: list[int] | None = None) -> DataFrame:
        """Rows of a read-model table as the manifest has them."""
        wanted = {b: at for b, at in state.buckets.items() if buckets is None or b in buckets}
        schema = self._model_schemas[table]
        if not wanted or not exists(self.spark, f"{self.path}/{table}"):
            return self.spark.createDataFrame([], schema)
        pairs = F.create_map(*[F.lit(x).cast("bigint") for pair in wanted.items() for x in pair])
        placed = StructType([*schema.fields, StructField("op", LongType()), StructField("bucket", IntegerType())])
        rows = self.spark.read.schema(placed).parquet(f"{self.path}/{table}")
        return rows.filter(F.col("op") == F.element_at(pairs, F.col("bucket").cast("bigint"))).drop("op", "bucket")

    @cached_property
    def _model_schemas(self) -> dict[str, StructType]:
        nobody = {name: self.tables[name].limit(0) for name in TABLES}
        model = readmodel.build(_Touched(nobody, self.tables), self.as_of)
        return {"report": model.report.schema, "details": model.details.schema}

    def model(self) -> readmodel.ReadModel:
        """Both tables as of the newest manifest: read, not derived."""
        state = self.state()
        return readmodel.ReadModel(self._newest("report", state), self._newest("details", state))

    # rows -------------------------------------------------------------------

    def _bucket(self, column: str) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(self.n)).cast("int")

    def _schema(self, table: str, *more: str) -> str:
        columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in self.tables[table].schema if f.name != self.version]
        columns += [f"`{self.version}` bigint"] if self.version else []
        return ", ".join([*columns, *more])

    def _in_form(self, table: str, rows: DataFrame) -> DataFrame:
        """The table's columns, and the version, which is the same for all rows where the source has none."""
        columns = [F.col(c) for c in self.tables[table].columns if c != self.version]
        if self.version:
            columns.append((F.col(self.version) if self.version in rows.columns else F.lit(0)).cast("bigint").alias(self.version))
        return rows.select(*columns)

    def _owners(self, table: str, keys: DataFrame, key: str, op: int) -> DataFrame:
        """(key, owner) of the keys given. Only slots of the index that they fall into are read."""
        if not exists(self.spark, f"{self.path}/owners/{table}"):
            return keys.select(key, F.lit(None).cast("bigint").alias("owner")).limit(0)
        slots = [r[0] for r in keys.select(self._bucket(key)).distinct().collect()]  # at most as many as there are buckets
        index = self.spark.read.schema(f"{key} bigint, owner bigint, op bigint, slot int").parquet(f"{self.path}/owners/{table}")
        index = index.filter((F.col("op") <= op) & F.col("slot").isin(slots)).join(keys.select(key).distinct(), key, "left_semi")
        return index.groupBy(key).agg(F.max_by("owner", "op").alias("owner"))

    def _add(self, table: str, rows: DataFrame, op: int) -> DataFrame:
        """Writes rows to their patients' buckets, and those without an owner where they wait; returns the owners."""
        key, owner = TABLES[table]
        rows = self._in_form(table, rows)
        if owner:
            rows = rows.withColumn("owner", F.col(owner))
        else:
            through, shared = OWNED_BY[table]
            rows = rows.join(self._owners(through, rows.select(shared), shared, op), shared, "left")
        at = f"{self.path}/rows/{table}/op={op}"
        known = self._not_outdated(table, rows.filter("owner IS NOT NULL"), op).withColumn("bucket", self._bucket("owner"))
        _by(known, "bucket").write.mode("overwrite").partitionBy("bucket").parquet(at)
        if table in (t for t, _ in OWNED_BY.values()):
            stored = self._rows(table, op, None).filter(F.col("op") == op)  # read back rather than made again
            index = _by(stored.select(key, "owner", self._bucket(key).alias("slot")), "slot")
            index.write.mode("overwrite").partitionBy("slot").parquet(f"{self.path}/owners/{table}/op={op}")
        if not owner:
            left = rows.filter("owner IS NULL").drop("owner")
            left.write.mode("overwrite").parquet(f"{self.path}/waiting/{table}/op={op}")
        return self._rows(table, op, None).filter(F.col("op") == op).select("owner")

    def _not_outdated(self, table: str, rows: DataFrame, op: int) -> DataFrame:
        """The rows without those of which a higher version came in before."""
        if not self.version or not exists(self.spark, f"{self.path}/rows/{table}"):
            return rows
        key = TABLES[table][0]
        before = self._rows(table, op - 1, None).select(F.col(key).alias("_key"), F.col(self.version).alias("_version"))
        return rows.join(before, (F.col(key) == F.col("_key")) & (F.col("_version") > F.col(self.version)), "left_anti")

    def _rows(self, table: str, op: int, buckets: list[int] | None) -> DataFrame:
        """Stored rows, all versions."""
        if not exists(self.spark, f"{self.path}/rows/{table}"):
            return self._in_form(table, self.tables[table].limit(0)).selectExpr("*", "0L AS owner", "0L AS op", "0 AS bucket")
        rows = self.spark.read.schema(self._schema(table, "owner bigint, op bigint, bucket int")).parquet(f"{self.path}/rows/{table}")
        rows = rows.filter(F.col("op") <= op)
        return rows if buckets is None else rows.filter(F.col("bucket").isin(buckets))

    def _current(self, table: str, op: int, buckets: list[int], touched: DataFrame | None) -> DataFrame:
        """The rows that count, of the touched patients or else of all."""
        rows = self._rows(table, op, buckets)
        rows = rows if touched is None else rows.join(touched, "owner", "left_semi")
        ranking = [F.col(c).desc() for c in ([self.version] if self.version else []) + ["op"]]
        newest = F.row_number().over(Window.partitionBy(TABLES[table][0]).orderBy(*ranking))
        rows = rows.withColumn("_place", newest).filter("_place = 1")
        return rows.select(*self.tables[table].columns)

    # batches ----------------------------------------------------------------

    def apply(self, source: str, batch: DataFrame, batch_id: int) -> None:
        """Takes in one micro-batch of a source, with those of other sources that wait by then."""
        mine = Offer(source, batch, batch_id)
        with self._queue:
            self._offered.append(mine)
        with self._lock:
            while not mine.taken:
                self._wait_for_streams()
                with self._queue:
                    offers = list({o.source: o for o in reversed(self._offered)}.values())  # the first of each source
                    self._offered = [o for o in self._offered if o not in offers]
                try:
                    self._take({o.source: o.batch for o in offers}, {o.source: o.number for o in offers})
                except BaseException as e:
                    for o in offers:
                        o.error = e
                finally:
                    for o in offers:
                        o.taken = True
        if mine.error is not None:
            raise mine.error

    def _wait_for_streams(self) -> None:
        until = time.monotonic() + self.linger
        while time.monotonic() < until:
            with self._queue:
                offered = {o.source for o in self._offered}
            if not any(_at_work(q) for source, q in list(self._streams.items()) if source not in offered):
                return
            time.sleep(0.1)

    def load(self, tables: Mapping[str, DataFrame]) -> None:
        """Takes in whole tables at once, as a first state. Done once; streams go on from it."""
        with self._lock:
            self._take(tables, {"load": 0})

    def _take(self, batches: Mapping[str, DataFrame], numbers: Mapping[str, int]) -> None:
        with shuffles_removed(self.spark, *[batch.sparkSession for batch in batches.values()]):
            self._taken(batches, numbers)

    def _taken(self, batches: Mapping[str, DataFrame], numbers: Mapping[str, int]) -> None:
        state = self.state()
        numbers = {s: n for s, n in numbers.items() if n > state.batches.get(s, -1)}  # of the others the manifest was written
        batches = {t: rows for t, rows in batches.items() if t in numbers or "load" in numbers}
        if not numbers:
            return
        op = state.op + 1
        added = {t: self._in_form(t, batches[t]) for t in sorted(batches, key=lambda t: t in OWNED_BY)}  # owners first
        for table, at in state.waiting.items():
            rows = self.spark.read.schema(self._schema(table)).parquet(f"{self.path}/waiting/{table}/op={at}")
            added[table] = rows.unionByName(added[table]) if table in added else rows
        owners = reduce(DataFrame.unionByName, [self._add(table, rows, op) for table, rows in added.items()])
        waiting = {table: op for table in added if table in OWNED_BY and not self.spark.read.schema(self._schema(table)).parquet(
            f"{self.path}/waiting/{table}/op={op}").isEmpty()}
        owners.distinct().write.mode("overwrite").parquet(f"{self.path}/touched/op={op}")
        touched = self.spark.read.schema("owner bigint").parquet(f"{self.path}/touched/op={op}")
        buckets = sorted(r[0] for r in touched.select(self._bucket("owner")).distinct().collect())
        if buckets:
            self._derive(state, op, buckets, touched)
        self._write_state(replace(
            state, op=op, buckets=state.buckets | dict.fromkeys(buckets, op), batches=state.batches | numbers,
            waiting=waiting))
        for table in ("touched", "quarters"):
            delete(self.spark, f"{self.path}/{table}/op={op}")

    def _derive(self, state: State, op: int, buckets: list[int], touched: DataFrame) -> None:
        for table in ("report", "details"):  # left by a batch that broke off
            delete(self.spark, f"{self.path}/{table}/op={op}")
        before = self._newest("report", state, buckets).count()
        share = min(1.0, touched.count() / before) if before else 1.0
        for some in self._rounds(op, buckets, share):
            picked = touched.filter(self._bucket("owner").isin(some)) if share < MOST else None
            self._derive_buckets(state, op, some, picked)

    def _rounds(self, op: int, buckets: list[int], share: float) -> list[list[int]]:
        """The buckets, dealt into rounds of about ``at_once`` rows of which the share given counts."""
        stored = reduce(DataFrame.unionAll, [self._rows(table, op, buckets).select("bucket") for table in TABLES])
        rows = {r["bucket"]: r["count"] * share for r in stored.groupBy("bucket").count().collect()}  # a row a bucket
        rounds, full = [], self.at_once
        for b in buckets:
            if full + rows.get(b, 0) > self.at_once:
                rounds.append([])
                full = 0
            rounds[-1].append(b)
            full += rows.get(b, 0)
        return rounds

    def _derive_buckets(self, state: State, op: int, buckets: list[int], touched: DataFrame | None) -> None:
        """Adds these buckets to both tables: the touched patients derived, the others as they were, or else all derived."""
        own = {name: self._current(name, op, buckets, touched) for name in TABLES}
        tables = _Touched(own, self.tables)
        events = ClinicalEvents(tables)
        at = f"{self.path}/quarters/op={op}"
        readmodel.placed(readmodel.fold(events.all()), tables).write.mode("overwrite").parquet(at)
        model = readmodel.from_placed(self.spark.read.parquet(at), tables, events.words, self.as_of)
        for table, rows in (("report", model.report), ("details", model.details)):
            if touched is not None:
                ids = touched.withColumnRenamed("owner", "patient_id")
                rows = self._newest(table, state, buckets).join(ids, "patient_id", "left_anti").unionByName(rows)
            rows = rows.withColumn("bucket", self._bucket("patient_id"))
            rows = _by(rows, "bucket") if len(buckets) > 1 else rows
            rows.write.mode("append").partitionBy("bucket").parquet(f"{self.path}/{table}/op={op}")

    def vacuum(self) -> list[int]:
        """Removes what the newest manifest doesn't need; returns the numbers whose read-model rows went. Readers of an earlier
        manifest must be done."""
        with self._lock:
            state = self.state()
            used = set(state.buckets.values())
            gone = [op for op in range(1, state.op + 1) if op not in used]
            for op in range(1, state.op + 1):
                tables = ["touched", "quarters", *(["report", "details"] if op in gone else []), *(["manifest"] if op < state.op else [])]
                tables += [f"waiting/{t}" for t in OWNED_BY if state.waiting.get(t) != op]
                for table in tables:
                    delete(self.spark, f"{self.path}/{table}/op={op}")
            return gone


def _at_work(query: StreamingQuery | None) -> bool:
    """Whether a stream may offer a batch soon: it is being started, hasn't ended its first round, or is in one."""
    return query is None or query.isActive and (query.lastProgress is None or query.status["isTriggerActive"])


def start_report_stream(
    store: PatientStore, sources: Mapping[str, DataFrame], trigger: Mapping[str, object] | None = None
) -> list[StreamingQuery]:
    """One query per clinical table; the store takes their batches one at a time."""
    def started(name: str, stream: DataFrame) -> StreamingQuery:
        return (
            stream.writeStream.foreachBatch(lambda batch, batch_id: store.apply(name, batch, batch_id))
            .option("checkpointLocation", f"{store.path}/checkpoints/{name}")
            .trigger(**(trigger or {"processingTime": "1 minute"}))
            .start()
        )

    store._streams.update(dict.fromkeys(sources))
    try:
        for name, stream in sources.items():
            store._streams[name] = started(name, stream)
    except BaseException:
        store._streams = {name: query for name, query in store._streams.items() if query}
        raise
    return [store._streams[name] for name in sources]
