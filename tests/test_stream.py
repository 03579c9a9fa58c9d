from __future__ import annotations

import re
import threading
import time

import pytest
from pyspark.sql import functions as F

from quarterfold.plans import migration, readmodel
from quarterfold.sources.scratch import CLEANUP
from quarterfold.streaming import upkeep
from quarterfold.streaming.audit import Audit
from quarterfold.streaming.store import PatientStore, start_report_stream
from tests import tiny
from tests.tiny import SCHEMAS, Tiny, frame

AS_OF = "2001-12-31"
NOW = {"availableNow": True}


def rows(df):
    return sorted(map(str, df.collect()))


def sample(spark):
    t = Tiny(spark).patient(1).patient(2).state(10, 1, tiny.ON_ART, "2000-02-01").state(11, 2, tiny.DIED, "2000-03-01")
    for i in range(1, 10):
        t.obs(i, 1 + i % 2, tiny.REGIMEN, f"2000-0{i}-03 00:00:00", tiny.DISPENSING, value_text=f"{i}A")
    return t.obs(20, 1, tiny.PREGNANT, "2000-04-05 00:00:00", value_coded=tiny.YES)


def test_any_chunking_gives_the_batch_result(spark, tmp_path):
    t = sample(spark)
    want = readmodel.build(t, AS_OF)
    target = str(tmp_path / "target")
    obs = t["obs"]
    # late first, the middle twice, one batch run again with the same number
    for n, part in enumerate(("obs_id > 6", "obs_id BETWEEN 3 AND 7", "obs_id < 4", "obs_id BETWEEN 3 AND 7")):
        upkeep.apply_batch("obs", obs.filter(part), n, t, target)
        if n == 1:
            assert upkeep.compact(spark, target, t) == 1
    upkeep.apply_batch("obs", obs.filter("obs_id < 4"), 2, t, target)
    upkeep.apply_batch("patient_state", t["patient_state"], 0, t, target)
    got = upkeep.current_model(spark, target, t, AS_OF)
    assert rows(got.report) == rows(want.report) and rows(got.details) == rows(want.details)
    before = rows(upkeep.current_quarters(spark, target, t))
    assert upkeep.compact(spark, target, t) == 2
    assert rows(upkeep.current_quarters(spark, target, t)) == before


def test_folded_batches_are_removed(spark, tmp_path):
    t, target = sample(spark), str(tmp_path / "target")
    want = readmodel.build(t, AS_OF)
    upkeep.apply_batch("patient_state", t["patient_state"], 0, t, target)
    for n in range(6):
        upkeep.apply_batch("obs", t["obs"].filter(f"obs_id % 6 = {n}"), n, t, target)
        if n % 2:
            before = upkeep.current_quarters(spark, target, t)  # planned before the compaction, read after it
            want_before = rows(before)
            upkeep.compact(spark, target, t)
            assert rows(before) == want_before
    left = {r.batch for r in spark.read.parquet(f"{target}/deltas").filter("source = 'obs'").select("batch").distinct().collect()}
    assert left == {3, 4, 5}
    assert upkeep.compact(spark, target, t) == 4 and upkeep.compact(spark, target, t) == 5
    got = upkeep.current_model(spark, target, t, AS_OF)
    assert rows(got.report) == rows(want.report) and rows(got.details) == rows(want.details)


def test_what_events_refer_to_may_come_late(spark, tmp_path):
    t, target = sample(spark), str(tmp_path / "target")
    want = readmodel.build(t, AS_OF)

    class Before:
        """No enrolment yet, and the visits of the first three observations alone."""

        def __getitem__(self, name):
            if name == "patient_program":
                return t[name].filter("false")
            return t[name].join(t["obs"].filter("obs_id <= 3"), "encounter_id", "left_semi") if name == "encounter" else t[name]

    upkeep.apply_batch("obs", t["obs"].filter("obs_id <= 6"), 0, Before(), target)
    upkeep.apply_batch("patient_state", t["patient_state"], 0, Before(), target)
    assert upkeep.compact(spark, target, Before()) == 1
    upkeep.apply_batch("obs", t["obs"].filter("obs_id > 6"), 1, Before(), target)
    got = upkeep.current_model(spark, target, Before(), AS_OF)
    assert rows(got.details) != rows(want.details)
    got = upkeep.current_model(spark, target, t, AS_OF)
    assert rows(got.report) == rows(want.report) and rows(got.details) == rows(want.details)
    assert upkeep.compact(spark, target, t) == 2
    assert spark.read.parquet(f"{target}/waiting/v=2/obs").count() == 0
    got = upkeep.current_model(spark, target, t, AS_OF)
    assert rows(got.report) == rows(want.report) and rows(got.details) == rows(want.details)


def test_streams_of_files(spark, tmp_path):
    t = sample(spark)
    for name in ("obs", "patient_state"):
        for n in range(3):
            frame(spark, t.rows[name][n::3], SCHEMAS[name]).coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}")
    sources = {
        name: spark.readStream.schema(t[name].schema).option("maxFilesPerTrigger", 2).parquet(f"{tmp_path}/{name}")
        for name in ("obs", "patient_state")
    }
    target = str(tmp_path / "target")
    for q in upkeep.start_quarter_stream(sources, t, target, trigger=NOW):
        q.awaitTermination()
    assert spark.read.parquet(f"{target}/deltas").filter("source = 'obs'").select("batch").distinct().count() == 2
    want = readmodel.build(t, AS_OF)
    got = upkeep.current_model(spark, target, t, AS_OF)
    assert rows(got.report) == rows(want.report) and rows(got.details) == rows(want.details)


# ---- the stored tables -----------------------------------------------------------

def same(got, want):
    assert rows(got.report) == rows(want.report) and rows(got.details) == rows(want.details)


def test_updates_out_of_order_give_the_batch_result(spark, tmp_path):
    t = sample(spark).drug(30, 1, "2000-05-01", "2000-06-01", 30, 1.0)
    want, store = readmodel.build(t, AS_OF), PatientStore(spark, str(tmp_path / "store"), t, AS_OF, "ver", buckets=4)
    store.load({name: t[name] for name in ("patient_state", "patient", "encounter", "patient_program")})
    store.load({"patient": t["patient"]})  # done once
    other = "obs_datetime + INTERVAL 60 DAYS AS obs_datetime, 'Z' AS value_text, 1065L AS value_coded".split(", ")
    changed = [*(c for c in t["obs"].columns if c not in ("obs_datetime", "value_text", "value_coded", "ver")), *other]
    store.apply("obs", t["obs"].selectExpr(*changed, "1L AS ver"), 0)
    store.apply("drug_order", t["drug_order"].withColumn("ver", F.lit(2)), 0)  # its order isn't there yet
    store.apply("person", t["person"].selectExpr("*", "1L AS ver").withColumn("dead", F.lit(1).cast("short")), 0)
    assert rows(store.model().report) != rows(want.report) and store.state().waiting
    store.apply("obs", t["obs"].withColumn("ver", F.lit(3)), 1)
    store.apply("orders", t["orders"], 0)
    assert not store.state().waiting
    store.apply("person", t["person"].selectExpr("*", "2L AS ver"), 1)
    same(store.model(), want)
    # late and repeated batches change nothing
    store.apply("obs", t["obs"].filter("obs_id < 5").selectExpr(*changed, "2L AS ver"), 2)
    store.apply("obs", t["obs"].selectExpr(*changed, "9L AS ver"), 1)
    same(store.model(), want)
    before = store.state()
    assert store.vacuum() and store.state() == before
    same(PatientStore(spark, store.path, t, AS_OF, "ver", buckets=4).model(), want)


def test_a_batch_rewrites_only_the_buckets_it_touches(spark, tmp_path):
    t = Tiny(spark)
    for i in range(40):
        t.patient(i).obs(i, i, tiny.REGIMEN, "2000-01-03 00:00:00", tiny.DISPENSING, value_text="A")
    store = PatientStore(spark, str(tmp_path / "store"), t, AS_OF, buckets=8)
    store.load({name: t[name] for name in ("patient", "person", "encounter", "obs")})
    same(store.model(), readmodel.build(t, AS_OF))
    before = store.state()
    t.obs(100, 7, tiny.REGIMEN, "2000-02-03 00:00:00", value_text="B")
    store.apply("obs", t["obs"].filter("obs_id = 100"), 1)
    after = store.state()
    assert sum(after.buckets[b] != before.buckets[b] for b in range(8)) == 1
    assert spark.read.parquet(f"{store.path}/report").filter(F.col("op") == after.op).select("bucket").distinct().count() == 1
    same(store.model(), readmodel.build(t, AS_OF))
    plan = store.model().report._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Exchange" not in plan


def test_a_batch_that_broke_off_is_not_seen(spark, tmp_path, monkeypatch):
    t = sample(spark)
    store = PatientStore(spark, str(tmp_path / "store"), t, AS_OF, buckets=2)
    store.load({name: t[name] for name in ("patient", "person", "encounter", "patient_program", "patient_state")})
    before = rows(store.model().report)
    with monkeypatch.context() as m:
        m.setattr(store, "_write_state", lambda state: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store.apply("obs", t["obs"], 0)
    assert rows(store.model().report) == before
    store.apply("obs", t["obs"], 0)
    same(store.model(), readmodel.build(t, AS_OF))


def test_rows_older_than_what_is_there_derive_nobody(spark, tmp_path, monkeypatch):
    t = sample(spark)
    store = PatientStore(spark, str(tmp_path / "store"), t, AS_OF, "ver", buckets=2)
    tables = {name: t[name] for name in ("patient", "person", "encounter", "patient_program", "patient_state")}
    store.load(tables | {"obs": t["obs"].withColumn("ver", F.lit(2))})
    before = store.state()
    derived = []
    monkeypatch.setattr(store, "_derive", lambda *given: derived.append(given))
    store.apply("obs", t["obs"].selectExpr("* EXCEPT (ver, value_text)", "'Z' AS value_text", "1L AS ver"), 0)
    assert not derived and store.state().buckets == before.buckets and store.state().batches["obs"] == 0
    monkeypatch.undo()
    same(store.model(), readmodel.build(t, AS_OF))


def test_batches_that_wait_are_taken_in_together(spark, tmp_path, monkeypatch):
    t = sample(spark)
    store = PatientStore(spark, str(tmp_path / "store"), t, AS_OF, "ver", buckets=2)
    store.load({name: t[name] for name in ("encounter", "patient_program")})
    taken, first, take = [], threading.Event(), store._take

    def slow(batches, numbers):
        taken.append(sorted(numbers))
        if len(taken) == 1:
            first.set()
            while len(store._offered) < 3:
                time.sleep(0.01)
        take(batches, numbers)

    monkeypatch.setattr(store, "_take", slow)
    threads = [threading.Thread(target=store.apply, args=(name, t[name], 0)) for name in ("patient", "person", "obs", "patient_state")]
    threads[0].start()
    assert first.wait(60)
    for thread in threads[1:]:
        thread.start()
    for thread in threads:
        thread.join(300)
    assert taken == [["patient"], ["obs", "patient_state", "person"]]
    same(store.model(), readmodel.build(t, AS_OF))


def many(spark, patients=12):
    t = Tiny(spark)
    for i in range(1, patients + 1):
        t.patient(i).state(100 + i, i, tiny.ON_ART, "2000-02-01").drug(200 + i, i, "2000-05-01", "2000-06-01", 30, 1.0)
        t.obs(i, i, tiny.REGIMEN, "2000-01-03 00:00:00", tiny.DISPENSING, value_text="A")
    return t


def shuffled(spark):
    """Shuffle files on disk. Spark removes them in the background."""
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))


def test_many_rows_are_derived_some_buckets_at_a_time(spark, tmp_path, monkeypatch):
    t = many(spark)
    store = PatientStore(spark, str(tmp_path / "store"), t, AS_OF, "ver", buckets=2, at_once=30)
    rounds, derive = [], store._derive_buckets
    monkeypatch.setattr(store, "_derive_buckets", lambda s, op, buckets, touched: rounds.append((buckets, touched is None)) or derive(
        s, op, buckets, touched))
    tables = {name: t[name] for name in SCHEMAS if name not in ("drug", "obs")}
    store.load(tables | {"obs": t["obs"].selectExpr("* EXCEPT (ver, value_text)", "'Z' AS value_text", "1L AS ver")})
    assert len(rounds) > 1 and all(every for _, every in rounds) and sorted(b for r, _ in rounds for b in r) == [0, 1]
    rounds.clear()
    store.apply("obs", t["obs"].filter("obs_id <= 3").withColumn("ver", F.lit(2)), 0)  # few patients: they alone
    assert rounds and not any(every for _, every in rounds)
    rounds.clear()
    store.apply("obs", t["obs"].filter("obs_id > 1").withColumn("ver", F.lit(2)), 1)  # most patients: all
    assert len(rounds) > 1 and all(every for _, every in rounds)
    same(store.model(), readmodel.build(t, AS_OF))


def test_a_round_that_broke_off_leaves_nothing(spark, tmp_path, monkeypatch):
    t = many(spark)
    store = PatientStore(spark, str(tmp_path / "store"), t, AS_OF, buckets=2, at_once=1)
    tables = {name: t[name] for name in SCHEMAS if name != "drug"}
    derive, done = store._derive_buckets, []
    with monkeypatch.context() as m:
        m.setattr(store, "_derive_buckets", lambda *given: derive(*given) if not done and not done.append(1) else 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store.load(tables)
    store.load(tables)
    same(store.model(), readmodel.build(t, AS_OF))


def test_steps_leave_nothing_behind(spark, tmp_path):
    t = many(spark, 3)
    store = PatientStore(spark, str(tmp_path / "store"), t, AS_OF, buckets=2)
    before = shuffled(spark)
    store.load({name: t[name] for name in SCHEMAS if name != "drug"})
    until = time.time() + 30
    while shuffled(spark) > before and time.time() < until:
        time.sleep(0.2)
    assert shuffled(spark) <= before
    assert not any((tmp_path / "store" / kept / "op=1").exists() for kept in ("quarters", "touched"))
    assert spark.conf.get(CLEANUP) == "false"
    same(store.model(), readmodel.build(t, AS_OF))


def test_streams_started_together_are_taken_in_together(spark, tmp_path, monkeypatch):
    t = sample(spark)
    store = PatientStore(spark, str(tmp_path / "store"), t, AS_OF, "ver", buckets=1)
    taken = []

    def take(batches, numbers):  # what is taken in is tested above
        taken.append(sorted(numbers))

    monkeypatch.setattr(store, "_take", take)
    names, schemas = ("obs", "person", "patient_state", "encounter"), {}
    for name in names:
        t[name].coalesce(1).write.parquet(f"{tmp_path}/in/{name}")
        schemas[name] = t[name].schema
    streams = {name: spark.readStream.schema(schemas[name]).parquet(f"{tmp_path}/in/{name}") for name in names}
    for q in start_report_stream(store, streams, NOW):
        q.awaitTermination()
    assert taken == [sorted(names)]
    began = time.monotonic()
    store.apply("obs", t["obs"], 1)  # streams that ended aren't waited for
    assert taken[1:] == [["obs"]] and time.monotonic() - began < store.linger / 2


# ---- the audit -------------------------------------------------------------------

def test_audit_knows_every_id_and_reads_only_slots_it_may_hit(spark, tmp_path):
    audit = Audit(spark, str(tmp_path / "audit"), "obs_id", slots=16)
    ids = lambda a, b: spark.range(a, b).withColumnRenamed("id", "obs_id")
    assert audit.known(ids(0, 10), 0).count() == 0
    for batch in range(4):
        assert audit.known(ids(1000 * batch, 1000 * batch + 1000), batch).inputFiles() == []  # all new: nothing is read
        audit.add(ids(1000 * batch, 1000 * batch + 1000), batch)
    audit.add(ids(3000, 4000), 3)  # run again
    got = audit.known(ids(2990, 4010), 4)
    assert sorted(r.obs_id for r in got.collect()) == list(range(2990, 4000))
    assert sorted(r.obs_id for r in audit.known(ids(0, 5000), 2).collect()) == list(range(2000))
    one = audit.known(ids(17, 18), 4)
    assert [r.obs_id for r in one.collect()] == [17]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert any("batch#" in f and re.search(r"slot#\d+ = \d+", f) for f in re.findall(r"PartitionFilters: \[(.*?)\], ", plan))
    assert audit.maybe(ids(10**9, 10**9 + 20000), 4).count() < 200
    audit.add(ids(0, 0), 4)
    assert sorted(r.obs_id for r in audit.known(ids(5, 7), 5).collect()) == [5, 6]


def test_audit_of_many_batches_is_in_few_folders(spark, tmp_path):
    audit = Audit(spark, str(tmp_path / "audit"), "obs_id")
    ids = lambda a, b: spark.range(a, b).withColumnRenamed("id", "obs_id")
    for batch in (*range(8), 5, 6, 7):  # the last three run again
        audit.add(ids(100 * batch, 100 * batch + 100), batch)
    for before in (1, 3, 6, 7, 8):
        assert sorted(r.obs_id for r in audit.known(ids(0, 2000), before).collect()) == list(range(100 * before))
    read = lambda n: sum("/rows/" in f for f in audit.known(ids(0, 100), n).inputFiles())
    assert read(1) <= 16 and read(7) <= 48 and read(8) <= 16
    assert audit.known(ids(0, 10).union(ids(0, 10)), 8).count() == 10


def test_status_stream_counts_once_and_asks_for_status_alone(spark, tmp_path, monkeypatch):
    t = Tiny(spark)
    for i in range(1, 13):
        t.patient(i).obs(i, i, 1576 if i % 3 else tiny.REGIMEN, "2000-01-03 00:00:00", value_coded=1742)
    t.add("patient_program", patient_program_id=100, patient_id=2, program_id=1, date_created="2001-01-01 00:00:00")
    offered = t["obs"].withColumn("creator", F.lit(1))
    for wave in ("obs_id < 7", "obs_id BETWEEN 4 AND 9", "obs_id < 13"):
        offered.where(wave).coalesce(1).write.mode("append").parquet(f"{tmp_path}/obs")
    asked, known = [], Audit.known
    monkeypatch.setattr(Audit, "known", lambda self, ids, before: asked.append(ids.count()) or known(self, ids, before))
    stream = spark.readStream.schema(offered.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/obs")
    upkeep.start_status_stream(stream, t, t, str(tmp_path / "target"), NOW).awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/target/states")
    want, _ = migration.states_from_obs(offered, offered.select("obs_id").limit(0), t, t)
    assert rows(got.drop("batch")) == rows(want) and got.count() == 8
    assert got.where("state IS NULL").isEmpty() and got.where("patient_program_id = 100").count() == 1
    assert sorted(asked) == [4, 4, 8]


def test_latest_program_of_some_people(spark):
    t = Tiny(spark).patient(1).patient(2).patient(3)
    people = spark.createDataFrame([(2,), (2,), (9,), (None,)], "person_id long")
    assert rows(migration.latest_program(t, people)) == rows(migration.latest_program(t).where("patient_id = 2"))
