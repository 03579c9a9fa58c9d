from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarterfold.operators import rows
from quarterfold.operators.numbering import with_position_in
from quarterfold.operators.lookups import concept_roles
from quarterfold.sources.select import extract_person_closure, list_reference_tables, page_patients
from quarterfold.sources.sinks import split_valid, upsert, without_rejected
from quarterfold.sources.tables import Source, copy_tables, read_copied, read_table
from tests.tiny import frame


def test_latest_earliest_and_any(spark):
    df = spark.createDataFrame([(1, 5, 10, "a"), (1, 5, 11, "b"), (1, 4, 99, "c"), (2, None, 1, "d")], "k int, t int, id int, v string")
    pick = lambda out: {r.k: r.v for r in out.collect()}
    assert pick(rows.latest_per(df, "k", ["t", "id"])) == {1: "b", 2: "d"}
    assert pick(rows.earliest_per(df, "k", ["t", "id"])) == {1: "c", 2: "d"}
    assert pick(rows.any_per(df, "k", "id")) == {1: "a", 2: "d"}
    assert rows.latest_per(df, "k", ["t", "id"]).columns == df.columns


def windows_of(df):
    """Partition columns of each window of the plan."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return re.findall(r"windowspecdefinition\((.*?)(?: ASC| DESC)", plan)


def test_sequential_ids_have_no_gaps_over_ranges(spark):
    ids = [*range(0, 1000, 7), *(10**12 * k for k in range(1, 50))]  # sparse and dense
    df = spark.createDataFrame([(i, i) for i in ids], "user_id long, _part long")
    got = rows.sequential_ids(df, "user_id", 50, "n", ranges=6)
    assert [(r.user_id, r.n) for r in got.orderBy("user_id").collect()] == list(zip(sorted(ids), range(50, 50 + len(ids)), strict=True))
    assert got.columns == ["user_id", "_part", "n"]
    assert rows.sequential_ids(df.limit(0), "user_id", 50, "n").count() == 0
    assert windows_of(got) and all("__part" in w for w in windows_of(got))


def test_places_within_groups(spark):
    df = spark.createDataFrame([("hot" if k % 3 else f"g{k % 5}", (k * 37) % 101, k) for k in range(300)], "g string, o int, _n int")
    got = with_position_in(df, "g", ["o", "_n"], "i", "n", ).collect()
    for g in {r.g for r in got}:
        mine = sorted((r for r in got if r.g == g), key=lambda r: (r.o, r["_n"]))
        assert [r.i for r in mine] == list(range(len(mine))) and {r.n for r in mine} == {len(mine)}


def test_concept_roles_collect_all_names_of_a_concept(spark):
    names = spark.createDataFrame([(1, "Yes "), (1, "affirmative"), (2, "NO"), (3, "other")], "concept_id long, name string")
    got = {r.concept_id: r.roles for r in concept_roles(names, {"yes": ("YES",), "also": ("Affirmative",), "no": ("no",)}).collect()}
    assert got == {1: 3, 2: 4}


def test_upsert_keeps_existing_rows(spark):
    target = spark.createDataFrame([(1, "old")], "k int, v string")
    batch = spark.createDataFrame([(1, "new"), (2, "b"), (2, "a")], "k int, v string")
    assert sorted(map(tuple, upsert(target, batch, "k", order="v").collect())) == [(1, "old"), (2, "a")]
    assert sorted(map(tuple, upsert(target, batch.filter("v <> 'b'"), "k", reset=("v",)).collect())) == [(1, "new"), (2, "a")]


def test_rejected_rows_keep_their_reasons(spark):
    df = spark.createDataFrame([(1, None, 5), (2, "x", 5), (3, None, -1)], "patient_id int, a string, b int")
    ok, bad = split_valid(df, {"a missing": F.col("a").isNull(), "b negative": F.col("b") < 0})
    assert [r.patient_id for r in ok.collect()] == [2]
    assert {r.patient_id: r.errors for r in bad.collect()} == {1: ["a missing"], 3: ["a missing", "b negative"]}
    assert [r.patient_id for r in without_rejected(df, bad).collect()] == [2]


def test_pages_break_ties_by_id(spark):
    df = spark.createDataFrame([(3, "2000-01-01"), (1, "2000-01-01"), (2, "1999-01-01")], "patient_id int, date_created string")
    ids = lambda out: sorted(r.patient_id for r in out.collect())
    assert ids(page_patients(df, 0, 2)) == [1, 2]
    assert ids(page_patients(df, 0, 2, newest_first=True)) == [1, 3]
    assert ids(page_patients(df, 2, 5)) == [3]


def test_pages_anywhere(spark):
    days = [None if k % 50 == 0 else f"20{k % 7:02d}-01-01" for k in range(400)]
    df = spark.createDataFrame([(k, days[k], "x") for k in range(400)], "patient_id int, date_created string, _place string")
    for newest in (False, True):
        key = lambda k: (days[k] is not None, days[k] or "")
        want = sorted(range(400), key=lambda k: k)
        want = sorted(want, key=key, reverse=newest)
        for offset, n in ((0, 10), (5, 0), (123, 200), (395, 50), (400, 5), (9999, 1)):
            got = page_patients(df, offset, n, newest_first=newest)
            assert sorted(r.patient_id for r in got.collect()) == sorted(want[offset : offset + n]) and got.columns == df.columns
    plan = page_patients(df, 300, 50)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "GlobalLimit" not in plan


def test_closure_reaches_through_two_tables(spark):
    tables = {
        "person": spark.createDataFrame([(1,), (2,)], "person_id int"),
        "encounter": spark.createDataFrame([(10, 1), (20, 2)], "encounter_id int, patient_id int"),
        "orders": spark.createDataFrame([(100, 10), (200, 20)], "order_id int, encounter_id int"),
        "drug_order": spark.createDataFrame([(100, "a"), (200, "b")], "order_id int, d string"),
        "person_name": spark.createDataFrame([(7, 1), (8, 2)], "person_name_id int, person_id int"),
        "person_name_code": spark.createDataFrame([(7, "x"), (8, "y")], "person_name_id int, code string"),
    }
    got = extract_person_closure(tables, spark.createDataFrame([(2,)], "person_id int"))
    assert {t: df.count() for t, df in got.items()} == dict.fromkeys(tables, 1)
    assert got["drug_order"].first().d == "b" and got["person_name_code"].first().code == "y"


def test_reference_tables_leave_out_people(spark):
    for name in ("person", "drug", "relationship"):
        spark.range(1).createOrReplaceTempView(name)
    try:
        found = list_reference_tables(spark)
        assert "person" not in found and {"drug", "relationship"} <= set(found)
    finally:
        for name in ("person", "drug", "relationship"):
            spark.catalog.dropTempView(name)


def test_zero_dates_become_null(spark, tmp_path):
    frame(spark, [{"id": 1, "d": "0000-00-00"}, {"id": 2, "d": "2000-02-03"}, {"id": 3, "d": ""}], "id long, d string").write.parquet(f"{tmp_path}/t")
    raw = spark.read.parquet(f"{tmp_path}/t")
    from quarterfold.sources.tables import clean_dates
    from pyspark.sql.types import DateType, LongType, StructType
    got = clean_dates(raw, StructType().add("id", LongType()).add("d", DateType())).orderBy("id").collect()
    assert [str(r.d) for r in got] == ["None", "2000-02-03", "None"]
    assert read_table(spark, Source(path=str(tmp_path)), "t").count() == 3


def test_a_copy_that_broke_off_leaves_the_old_set(spark, tmp_path):
    source, target = Source(path=f"{tmp_path}/source"), f"{tmp_path}/copy"
    spark.createDataFrame([(1, "0000-00-00"), (2, "2000-01-02")], "id int, d string").write.parquet(f"{tmp_path}/source/a")
    spark.range(3).write.parquet(f"{tmp_path}/source/b")
    with pytest.raises(ValueError):
        read_copied(spark, target, "a")
    assert copy_tables(spark, source, ["a", "b"], target, {"a": StructType.fromDDL("id int, d date")}) == 1
    spark.range(9).write.mode("overwrite").parquet(f"{tmp_path}/source/b")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        copy_tables(spark, source, ["b", "missing"], target)
    assert sorted(map(str, read_copied(spark, target, "a").collect())) == ["Row(id=1, d=None)", "Row(id=2, d=datetime.date(2000, 1, 2))"]
    assert read_copied(spark, target, "b").count() == 3
    assert copy_tables(spark, source, ["b"], target) == 2 and read_copied(spark, target, "b").count() == 9
