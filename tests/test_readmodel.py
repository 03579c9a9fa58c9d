from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quarterfold.plans import readmodel
from quarterfold.plans.events import ClinicalEvents, Ordering
from tests import tiny
from tests.tiny import Tiny

AS_OF = "2001-12-31"


def rows(model):
    report = {r.patient_id: r for r in model.report.collect()}
    details = {(r.patient_id, str(r.quarter_start)): r for r in model.details.collect()}
    return report, details


def built(t, ordering=Ordering()):
    return rows(readmodel.build(t, AS_OF, ordering))


def test_starts_and_transfers_in(spark):
    t = (
        Tiny(spark)
        .patient(1).state(10, 1, tiny.ON_ART, "2000-02-01").state(11, 1, tiny.ON_ART, "2000-01-15")
        .patient(2).state(20, 2, tiny.ON_ART, "2000-01-15")
        .obs(21, 2, tiny.STARTED, "2000-03-01 09:00:00", tiny.REGISTRATION, value_datetime="1999-01-01 00:00:00")
        .patient(3).obs(31, 3, tiny.STARTED, "2000-03-01 09:00:00", tiny.REGISTRATION, value_text="1998-05-06")
        .patient(4).state(40, 4, tiny.ON_ART, "2000-01-15")
        .obs(41, 4, tiny.STARTED, "2000-03-01 09:00:00", tiny.REGISTRATION, value_text="unknown")
        .obs(42, 4, tiny.STARTED, "2000-03-02 09:00:00", tiny.CONSULTATION, value_datetime="1999-01-01 00:00:00")
        .patient(5)
    )
    r, _ = built(t)
    assert str(r[1].art_start_date) == "2000-01-15" and str(r[1].registration_date) == "2000-01-15 00:00:00"
    assert r[1].age_initiation == pytest.approx((31 * 365 + 8 + 364) / 365)  # at as_of, not at the start
    assert str(r[2].art_start_date) == "1999-01-01" and str(r[2].registration_date) == "2000-03-01 09:00:00"
    assert r[2].age_initiation == pytest.approx((29 * 365 + 7) / 365)
    assert str(r[3].art_start_date) == "1998-05-06"
    assert str(r[4].art_start_date) == "2000-01-15"
    assert r[5].art_start_date is None and r[5].last_visit_date is None


def test_pregnancy_needs_a_start(spark):
    t = (
        Tiny(spark)
        .patient(1).state(10, 1, tiny.ON_ART, "2000-02-01").obs(11, 1, tiny.PREGNANT, "2000-02-03 00:00:00", value_coded=tiny.YES)
        .patient(2).obs(21, 2, tiny.PREGNANT, "2000-02-03 00:00:00", value_coded=tiny.YES)
        .patient(3).state(30, 3, tiny.ON_ART, "2000-02-01").obs(31, 3, tiny.PREGNANT, "2000-02-03 00:00:00", value_coded=tiny.NO)
    )
    r, d = built(t)
    assert [r[i].patient_pregnant_date is not None for i in (1, 2, 3)] == [True, False, False]
    assert d[1, "2000-01-01"].patient_pregnant_date is not None and d[2, "2000-01-01"].patient_pregnant_date is None
    assert str(d[2, "2000-01-01"].last_visit_date) == "2000-02-03 00:00:00"


def test_latest_by_time_then_id_per_quarter(spark):
    t = Tiny(spark).patient(1)
    for oid, at, text in ((1, "2000-02-03", "1A"), (3, "2000-02-03", "2A"), (2, "2000-02-03", "3A"), (4, "2000-05-01", None)):
        t.obs(oid, 1, tiny.REGIMEN, f"{at} 00:00:00", tiny.DISPENSING, value_text=text)
    t.obs(5, 1, tiny.REGIMEN, "2000-06-01 00:00:00", tiny.CONSULTATION, value_text="9P")
    r, d = built(t)
    assert d[1, "2000-01-01"].latest_regimen == "2A"
    assert d[1, "2000-04-01"].latest_regimen is None and str(d[1, "2000-04-01"].latest_regimen_date) == "2000-05-01 00:00:00"
    assert r[1].latest_regimen is None and str(r[1].last_visit_date) == "2000-06-01 00:00:00"


@pytest.mark.parametrize("quantity, dose, expires", [
    (50, None, "2000-04-20 00:00:00"), (50, 3.0, "2000-03-18 00:00:00"), (50, 0.0, None), (50, 2.0, "2000-03-26 00:00:00"),
])
def test_drug_expiry_by_dose(spark, quantity, dose, expires):
    r, _ = built(Tiny(spark).patient(1).drug(1, 1, "2000-02-01 00:00:00", "2000-03-01 00:00:00", quantity, dose))
    got = r[1].expiry_date_for_last_arvs
    assert (None if got is None else str(got)) == expires


def test_only_treatment_drugs_with_a_quantity_count(spark):
    t = (
        Tiny(spark).patient(1).drug(1, 1, "2000-02-01 00:00:00", "2000-03-01 00:00:00", 10, 1.0, concept=5000)
        .patient(2).drug(2, 2, "2000-02-01 00:00:00", "2000-03-01 00:00:00", 0, 1.0)
        .patient(3).drug(3, 3, "2000-02-01 00:00:00", "2000-03-01 00:00:00", 10, 1.0, concept=7002)
    )
    r, d = built(t)
    assert [r[i].expiry_date_for_last_arvs is not None for i in (1, 2, 3)] == [False, False, True]
    assert set(d) == {(3, "2000-01-01")}


def test_death_falls_in_the_quarter_of_the_record(spark):
    t = Tiny(spark).patient(1)
    t.rows["person"][0] |= {"dead": 1, "death_date": "2001-05-05 00:00:00", "date_created": "1999-08-01 00:00:00"}
    r, d = built(t)
    assert str(d[1, "1999-07-01"].death_date) == "2001-05-05 00:00:00" == str(r[1].death_date)


def test_soft_deleted_observations_still_count(spark):
    r, _ = built(Tiny(spark).patient(1).obs(1, 1, tiny.TB, "2000-02-03 00:00:00", value_coded=tiny.YES, voided=1))
    assert r[1].current_episode_of_tb is not None


def test_tb_named_as_the_answer(spark):
    r, _ = built(Tiny(spark).patient(1).obs(1, 1, 1576, "2000-02-03 00:00:00", value_coded=tiny.TB))
    assert r[1].current_episode_of_tb is not None


def test_lapsed_treatment_is_more_than_sixty_days(spark):
    t = Tiny(spark)
    for pid, last in ((1, "2000-01-01"), (2, "1999-12-31")):
        t.patient(pid).obs(pid, pid, tiny.LAST_TAKEN, "2000-03-01 00:00:00", tiny.REGISTRATION, value_datetime=f"{last} 00:00:00")
    r, _ = built(t)
    assert [r[i].patient_did_not_take_arvs_in_last_two_months is not None for i in (1, 2)] == [False, True]


def test_events_of_unregistered_people_have_details_only(spark):
    t = Tiny(spark)
    t.obs(1, 77, tiny.TB, "2000-02-03 00:00:00", value_coded=tiny.YES)
    r, d = built(t)
    assert r == {} and d[77, "2000-01-01"].art_start_date is None


def test_fold_is_repeatable_and_mergeable(spark):
    t = Tiny(spark).patient(1)
    for i in range(1, 9):
        t.obs(i, 1, tiny.REGIMEN, f"2000-0{i}-03 00:00:00", tiny.DISPENSING, value_text=str(i))
        t.state(i, 1, tiny.ON_ART if i % 2 else tiny.STOPPED, f"2000-0{i}-04")
    events = ClinicalEvents(t).all()
    whole = readmodel.fold(events)
    parts = readmodel.fold(events.filter("hash(last_visit) % 2 = 0")).unionAll(readmodel.fold(events.filter("NOT (hash(last_visit) % 2 = 0)")))
    twice = readmodel.fold(whole.unionAll(whole).unionAll(parts))
    assert sorted(map(str, whole.collect())) == sorted(map(str, twice.collect())) == sorted(map(str, readmodel.fold(parts).collect()))


def test_update_replaces_its_row_by_version(spark):
    t = Tiny(spark).patient(1)
    for ver, text in ((1, "9P"), (2, "1A")):
        t.obs(1, 1, tiny.REGIMEN, "2000-02-03 00:00:00", value_text=text, ver=ver)
    t.rows["obs"][0]["encounter_id"] = t.rows["obs"][1]["encounter_id"] = 5
    t.add("encounter", encounter_id=5, patient_id=1, encounter_type=tiny.DISPENSING, voided=0)
    for table in ("person",):
        t.rows[table][0]["ver"] = 1

    class Versioned:
        def __getitem__(self, name):
            df = t[name]
            return df if "ver" in df.columns or name not in ("person",) else df.withColumn("ver", F.lit(1))

    r, _ = built(Versioned(), Ordering(version="ver"))
    assert r[1].latest_regimen == "1A"


def test_last_arrival_wins_on_request(spark):
    t = Tiny(spark).patient(1)
    t.state(1, 1, tiny.DIED, "2001-01-01", seq=1).state(2, 1, tiny.ON_ART, "2000-01-01", seq=2)

    class Sequenced:
        def __getitem__(self, name):
            df = t[name]
            return df.withColumn("seq", F.lit(1)) if name == "person" else df

    assert built(t)[0][1].latest_state == "Patient died"
    r, _ = built(Sequenced(), Ordering(arrival="seq"))
    assert r[1].latest_state == "On antiretrovirals" and str(r[1].latest_state_date) == "2000-01-01 00:00:00"


def test_states_and_programme_are_found_by_any_name(spark):
    """A synonym with a lower id changes the printed name, not what the state means."""
    t = Tiny(spark).patient(1)
    t.state(1, 1, tiny.ON_ART, "2000-01-01").state(2, 1, tiny.STOPPED, "2000-05-01")

    class Renamed:
        def __getitem__(self, name):
            if name != "concept_name":
                return t[name]
            more = [(7010, "Receiving treatment", 1), (1579, "Stopped for good", 2), (7882, "Programme one", 3)]
            return t[name].unionByName(spark.createDataFrame(more, "concept_id long, name string, concept_name_id long"))

    (plain, _), (renamed, _) = built(t), built(Renamed())
    assert plain[1].latest_state == "Treatment stopped" and renamed[1].latest_state == "Stopped for good"
    for column in ("art_start_date", "registration_date", "arv_drugs_stopped"):
        assert plain[1][column] is not None and renamed[1][column] == plain[1][column]


def test_a_start_date_is_read_whole_or_not_at_all(spark):
    t = Tiny(spark)
    for pid, text in ((1, "1998-05-06"), (2, "1998-05-06 10:00:00"), (3, "1998-05-06x"), (4, "1998-05-060"), (5, "1998-05-06 junk")):
        t.patient(pid).obs(pid, pid, tiny.STARTED, "2000-03-01 09:00:00", tiny.REGISTRATION, value_text=text)
    r, _ = built(t)
    assert [str(r[p].art_start_date) for p in range(1, 6)] == ["1998-05-06", "1998-05-06", "None", "None", "None"]


def test_observations_are_read_once_and_visits_of_any_size_meet_the_join_combined(spark, tmp_path):
    t = Tiny(spark).patient(1)
    for i in range(1, 6):
        t.obs(i, 1, tiny.REGIMEN, "2000-02-03 00:00:00", tiny.DISPENSING, value_text=str(i))
        t.rows["obs"][-1]["encounter_id"] = 1
    t.obs(6, 1, tiny.REGIMEN, "2000-02-04 00:00:00", value_text="no visit")
    t.rows["obs"][-1]["encounter_id"] = None
    t["obs"].write.parquet(str(tmp_path / "obs"))

    class Stored:
        def __getitem__(self, name):
            return spark.read.parquet(str(tmp_path / "obs")) if name == "obs" else t[name]

    plan = readmodel.fold(ClinicalEvents(Stored()).all())._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan parquet") == 1
    rows = ClinicalEvents(Stored()).observations().collect()
    assert len(rows) == 2 and [r.regimen.v for r in rows if r.regimen] == ["5"]
    r, _ = built(Stored())
    assert r[1].latest_regimen == "5" and str(r[1].last_visit_date) == "2000-02-04 00:00:00"


def test_patients_are_dealt_and_sorted_once(spark, tmp_path):
    """Rows of events are neither sorted before the shuffle nor shuffled again for the starts of their patients."""
    t = Tiny(spark).patient(1).state(10, 1, tiny.ON_ART, "2000-02-01").state(11, 1, tiny.STOPPED, "2000-05-01")
    events = ClinicalEvents(t)
    events.all().write.parquet(str(tmp_path / "events"))
    quarters = readmodel.fold(spark.read.parquet(str(tmp_path / "events")))
    plan = readmodel.from_quarters(quarters, t, events.words, AS_OF).details._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Window ["):plan.index("FileScan parquet")]  # from the starts down to the events
    assert below.count("Exchange ") == 1 and below.count("Sort [") == 1
    readmodel.write(spark, t, AS_OF, str(tmp_path / "model"))
    stored = readmodel.read(spark, str(tmp_path / "model"))
    want = readmodel.build(t, AS_OF)
    for table in ("report", "details"):
        assert sorted(map(str, getattr(stored, table).collect())) == sorted(map(str, getattr(want, table).collect()))
