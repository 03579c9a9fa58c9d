from __future__ import annotations

import pytest

from checks.queries_migration import Run, STEPS
from quarterfold.operators.mapping import remap_columns
from quarterfold.plans import migration as m
from quarterfold.sources.maps import DRUG_MAP, load_map
from quarterfold.sources.sinks import append, export_tables, write_upsert

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def run(spark):
    return Run(spark, SF)


def test_users_follow_the_last_patient(run):
    last = run.src["patient"].agg({"patient_id": "max"}).first()[0]
    got = sorted((r.user_id, r.person_id) for r in run.persons.collect())
    assert [p for _, p in got] == list(range(last + 1, last + 1 + len(got)))


def test_unmapped_actors_become_null(run):
    person, _ = m.patient_to_person(run.src, run.maps)
    unmapped = run.src["patient"].filter("creator = 900").count()
    assert unmapped > 0 and person.filter("creator IS NULL").count() == unmapped


@pytest.mark.parametrize("compat, want", [
    ("intended", {0: 13, 1: 7, 2: 3, 3: 13, 4: 3, 5: 13, 6: 3, 7: 11, 8: 2, 9: 12}),
    ("as_written", {0: 13, 1: 7, 2: 13, 3: 13, 4: 13, 5: 13, 6: 13, 7: 11, 8: 2, 9: 12}),
])
def test_relationship_recode(run, compat, want):
    got = m.relationships(run.src, run.maps, compat).selectExpr("relationship_id % 10 AS t", "relationship").distinct().collect()
    assert {r.t: r.relationship for r in got} == want


def test_identifiers_and_attributes_split_the_input(run):
    parts = m.identifiers(run.src, run.dst, run.maps).count(), m.attributes(run.src, run.dst, run.maps).count()
    assert min(parts) > 0 and sum(parts) == run.src["patient_identifier"].count()


def test_confirmed_symptoms_are_turned_round(run):
    turned = m.obs_mapped(run.src, run.dst, run.maps).filter("concept_id = 7755")
    answers = {r.value_coded for r in turned.select("value_coded").distinct().collect()}
    assert answers and answers <= {91, 92, 93, 96}
    kinds = {r.outcome for r in m.unmapped_concepts(m.obs_mapped(run.src, run.dst, run.maps)).collect()}
    assert kinds == {"mapped", "no target", "not in the map"}


def test_replay_gives_each_observation_one_state(run):
    replayed, once = STEPS["audit_replay"](run), STEPS["mig_states_from_obs"](run)
    assert replayed.count() == once.count() == once.select("uuid").distinct().count() > 0


def test_maps(spark, tmp_path):
    assert load_map(spark, "drug").count() == len(DRUG_MAP) == 21
    with pytest.raises(ValueError):
        load_map(spark, "concept")
    (tmp_path / "c.csv").write_text("old_concept_id,old_concept_name,new_concept_id\n3,Yes,1065\n13,CD4 count done,0\n")
    assert load_map(spark, "concept", f"{tmp_path}/c.csv").filter("new_concept_id = 0").count() == 1


def test_exports_and_writers(spark, run, tmp_path):
    for name in m.EXPORT_ORDER:
        assert m.export_table(name, run.src, run.dst, run.maps).count() > 0
    with pytest.raises(KeyError):
        m.export_table("nonesuch", run.src, run.dst, run.maps)
    export_tables(["patient"], lambda n: m.export_table(n, run.src, run.dst, run.maps), str(tmp_path / "out"), null_value="NULL")
    assert spark.read.text(f"{tmp_path}/out/patient").filter("value LIKE '%NULL%'").count() > 0
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    for number in (0, 1, 1):  # the second is run again
        append(df, f"{tmp_path}/t", number)
    assert spark.read.parquet(f"{tmp_path}/t").count() == 2
    write_upsert(df, spark.createDataFrame([(1, "b"), (2, "c")], "k int, v string"), "k", f"{tmp_path}/v2")
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/v2").collect())) == [(1, "a"), (2, "c")]


@pytest.mark.parametrize("step", ["mig_names", "mig_identifiers", "mig_attributes", "mig_export_identifiers", "mig_obs", "mig_orders"])
def test_row_identifiers_are_unique(run, step):
    rows = STEPS[step](run)
    assert rows.count() == rows.select("uuid").distinct().count() > 0


def test_equal_identifiers_are_told_apart(spark, run):
    twice = run.src["patient_identifier"].filter("patient_id % 2 = 0")
    doubled = {**{t: run.src[t] for t in ("identifier_type",)}, "patient_identifier": twice.unionAll(twice)}
    rows = m.identifiers(doubled, run.dst, run.maps)
    assert rows.count() == rows.select("uuid").distinct().count() > 0


def test_no_source_column_of_an_observation_is_lost(run):
    kept = set(m.obs_mapped(run.src, run.dst, run.maps).columns) | {"patient_id"}
    assert set(run.src["obs"].columns) <= kept
    assert set(run.src["orders"].columns) <= set(m.orders_mapped(run.src, run.maps).columns)
    assert set(run.src["obs"].columns) <= set(m.export_table("obs", run.src, run.dst, run.maps).columns) | {"patient_id"}
    assert set(run.src["encounter"].columns) <= set(m.export_table("encounter", run.src, run.dst, run.maps).columns)


def test_missing_keys_are_spread_when_a_map_is_too_large_to_broadcast(spark):
    rows = spark.range(3000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN id % 50 END AS k")
    pairs = spark.range(40).selectExpr("id AS _old", "id + 1000 AS _new")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = remap_columns(rows, ("k",), pairs)
        plan = got._jdf.queryExecution().sparkPlan().toString() + got._jdf.queryExecution().executedPlan().toString()
        found = {r.id: r.k for r in got.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "BroadcastHashJoin" not in plan and "hashpartitioning(k#" in plan
    assert all("_spread" in line for line in plan.splitlines() if "hashpartitioning(k#" in line)
    assert found == {i: i % 50 + 1000 if i % 3 == 0 and i % 50 < 40 else None for i in range(3000)}


def test_stored_maps_are_broadcast_by_their_size(run):
    plan = m.obs_mapped(run.src, run.dst, run.maps)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 4 and "SortMergeJoin" not in plan
