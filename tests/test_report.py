from __future__ import annotations

import pytest

from quarterfold.plans import report
from quarterfold.plans.indicators import INDICATORS
from quarterfold.plans.layout import LINES, cells
from tests.tiny import frame

PAIRED = (
    "total_reg ft re ti males non_preg preg_all_age a b c unk_age pres_hiv conf_hiv who_1_2 who_2 children breastfeed preg "
    "who_3 who_4 other_reason no_tb tb_w2yrs current_tb ks"
).split()
SINGLE = (
    "total_on_art died_1st_month died_2nd_month died_3rd_month died_after_3rd_month died_total defaulted stopped transfered "
    "unknown_outcome n1a n1p n2a n2p n3a n3p n4a n4p n5a n6a n7a n8a n9p non_std tb_no_suspect tb_suspected "
    "tb_confirm_not_treat tb_confirmed unknown_tb side_effects missed_0_6 missed_7plus"
).split()
START, END = "2000-10-01", "2000-12-31"
TIMES = (
    "registration_date patient_pregnant_date current_episode_of_tb tb_within_the_last_2_years karposis_sarcoma death_date "
    "expiry_date_for_last_arvs arv_drugs_stopped latest_state_date latest_regimen_date latest_side_effects last_visit_date "
    "last_missed_drugs_date tb_status_date patient_did_not_take_arvs_in_last_two_months"
).split()
TEXTS = "reason_for_art_eligibility latest_state latest_regimen tb_status".split()
COMMON = (
    "patient_id long, art_start_date date, age_initiation double, missed_drugs_count long, "
    + ", ".join(f"{c} timestamp_ntz" for c in TIMES) + ", " + ", ".join(f"{c} string" for c in TEXTS)
)


def tables(spark, patients: dict[int, dict], details: list[dict]):
    p = [{"patient_id": i, "art_start_date": "2000-01-15", "registration_date": "2000-01-15", **row} for i, row in patients.items()]
    return (
        frame(spark, p, COMMON + ", gender string, birth_date date"),
        frame(spark, details, COMMON + ", quarter_start date"),
    )


def figures(spark, patients, details, start=START, end=END):
    p, d = tables(spark, patients, details)
    return report.counts(p, d, start, end).first().asDict()


def on_art(pid, **more):
    return {"patient_id": pid, "latest_state": "On antiretrovirals", "latest_state_date": "2000-02-01", "last_visit_date": "2000-02-01", **more}


def test_registry_is_complete():
    assert set(INDICATORS) == {f"{k}_{n}" for n in PAIRED for k in ("new", "cum")} | set(SINGLE)
    assert len(INDICATORS) == 82
    assert sorted(c[0] for c in cells()) == sorted(INDICATORS) and len(LINES) == 57


def test_calendar_of_quarters(spark):
    got = [(str(r.start_date), str(r.end_date)) for r in report.calendar(spark, 1999, 2000).orderBy("quarter_no").collect()]
    assert len(got) == 8 and got[0] == ("1999-01-01", "1999-03-31") and got[-1] == ("2000-10-01", "2000-12-31")


def test_header(spark):
    properties = spark.createDataFrame([("current_health_center_name", " area  25 HEALTH centre")], "property string, property_value string")
    got = report.report_header(spark, properties, START, END).first()
    assert (got.site, got.period) == ("Area 25 Health Centre", "2000 - 4th Quarter")


def test_unknown_figure_is_an_error(spark):
    with pytest.raises(KeyError):
        report.indicator("nonesuch", None, None, START, END)


def test_figures_of_the_report_table(spark):
    ages = [None, 0.0, 1.99, 2.0, 14.0, 14.5, 15.0]
    patients = {i: {"age_initiation": a} for i, a in enumerate(ages)}
    reasons = ["HIV PCR", "", None, "presumed severe hiv  ", "Who Stage III adult", "WHO STAGE IV peds", "anything", "hiv INFECTED"]
    patients |= {20 + i: {"age_initiation": 30.0, "reason_for_art_eligibility": r} for i, r in enumerate(reasons)}
    deaths = ["2000-01-12", "2000-01-15", "2000-02-14", "2000-02-15", "2000-03-15", "2000-03-16", "2000-04-14", "2000-04-15", "2000-12-31"]
    patients |= {40 + i: {"age_initiation": 30.0, "latest_state": "Patient died", "latest_state_date": on} for i, on in enumerate(deaths)}
    patients |= {60: {"registration_date": "2000-12-31 10:00:00", "gender": "m", "age_initiation": 30.0},
                 61: {"registration_date": "2001-01-01", "gender": "M"}, 62: {"art_start_date": None, "gender": "M"}}
    got = figures(spark, patients, [])
    assert (got["cum_a"], got["cum_b"], got["cum_unk_age"]) == (2, 2, 2)
    assert got["cum_a"] + got["cum_b"] + got["cum_c"] + 1 == got["cum_total_reg"] == len(patients) - 2
    assert got["new_total_reg"] == got["new_males"] == 1
    # the short PCR text counts as confirmed and as other reason
    assert (got["cum_conf_hiv"], got["cum_pres_hiv"], got["cum_who_3"], got["cum_who_4"], got["cum_children"]) == (1, 1, 1, 1, 1)
    assert got["cum_other_reason"] == 2
    assert [got[f"died_{n}"] for n in ("1st_month", "2nd_month", "3rd_month", "after_3rd_month")] == [3, 2, 2, 2]
    assert got["died_total"] == 8  # not the one on the last day
    assert got["cum_no_tb"] == got["unknown_outcome"] == 0  # nobody has a detail row


def test_figures_over_details(spark):
    details = [
        # died later: still alive through the earlier quarter
        on_art(1), {"patient_id": 1, "latest_state": "Patient died", "latest_state_date": "2000-05-01"},
        # late on the last day: by day it counts, by midnight it does not
        on_art(2, latest_state_date="2000-12-31 10:00:00"),
        {"patient_id": 3, "latest_state": "Patient transferred out", "latest_state_date": "2000-12-31 10:00:00"},
        on_art(4, arv_drugs_stopped="2000-12-31 10:00:00"), on_art(5, arv_drugs_stopped="2000-12-31"),
        # overdue by the patient's last expiry
        on_art(6, last_visit_date="2000-06-01"), on_art(7, last_visit_date="2000-05-29"),
        # no outcome known, or not decidable
        {"patient_id": 8, "latest_state": "Pre-ART (Continue)", "latest_state_date": "2000-02-01", "last_visit_date": "2000-02-01"},
        {"patient_id": 9, "latest_state": "Pre-ART (Continue)", "latest_state_date": "2000-02-01", "last_visit_date": "2000-02-01",
         "expiry_date_for_last_arvs": "2000-03-01"},
        {"patient_id": 10, "latest_state_date": "2000-02-01", "expiry_date_for_last_arvs": "2000-03-01", "last_visit_date": "2000-02-01"},
        {"patient_id": 11, "latest_state_date": "2001-02-01", "expiry_date_for_last_arvs": "2000-03-01", "last_visit_date": "2000-02-01"},
        # regimens
        on_art(12, latest_regimen="1a "), on_art(13, latest_regimen="P1"), on_art(14, latest_regimen="Nn"),
        # doses and side effects
        on_art(15, missed_drugs_count=6, last_missed_drugs_date="2000-03-01"), on_art(16, missed_drugs_count=7, last_missed_drugs_date="2000-03-01"),
        on_art(17, missed_drugs_count=9, last_missed_drugs_date="2001-03-01"), on_art(18, latest_side_effects="2000-12-31 08:00:00"),
        on_art(19, latest_side_effects="2000-12-30 08:00:00"),
        # TB
        on_art(20, tb_status="TB not SUSPECTED", tb_status_date="2000-12-31 08:00:00"), on_art(21, tb_status_date="2000-02-01"),
        on_art(22, tb_status="sup", tb_status_date="2001-02-01"),
        {"patient_id": 23, "current_episode_of_tb": "2000-03-01"}, {"patient_id": 23}, {"patient_id": 24, "tb_within_the_last_2_years": "2001-03-01"},
    ]
    patients = {i: {} for i in range(1, 25)}
    for i in (6, 7):
        patients[i] = {"expiry_date_for_last_arvs": "2000-04-01"}
    p, d = tables(spark, patients, details)
    got = report.counts(p, d, START, END).first().asDict()
    alive = {1, 4, 7, 12, 13, 14, 15, 16, 17, 18, 19, 20, 21, 22}
    assert got["total_on_art"] == len(alive)
    assert (got["transfered"], got["stopped"], got["defaulted"]) == (1, 2, 1)
    assert got["unknown_outcome"] == 2  # patients 9 and 11
    assert (got["n1a"], got["n1p"], got["non_std"]) == (1, 0, len(alive) - 2)
    assert (got["missed_0_6"], got["missed_7plus"], got["side_effects"]) == (len(alive) - 2, 1, 1)
    assert (got["tb_no_suspect"], got["tb_suspected"], got["unknown_tb"]) == (1, 0, 1)
    assert (got["cum_current_tb"], got["cum_tb_w2yrs"]) == (1, 0)
    assert got["cum_no_tb"] == 23  # patient 24 has none; 23 has one quarter with and one without
    everywhere = {(str(r.end_date), r.indicator): r.value for r in report.report_all_quarters(spark, p, d, 2000, 2001).collect()}
    for quarter in (("2000-01-01", "2000-03-31"), (START, END), ("2001-01-01", "2001-03-31")):
        one = report.counts(p, d, *quarter).first().asDict()
        assert {n: everywhere[quarter[1], n] for n in one} == one
    single = {n: report.indicator(n, p, d, START, END).first().value for n in ("unknown_outcome", "total_on_art", "cum_no_tb", "new_ft")}
    assert single == {n: got[n] for n in single}


def test_periods_of_any_length_equal_one_at_a_time(spark):
    patients, details = {}, []
    for i in range(40):
        on = f"2000-{1 + i % 12:02d}-{1 + i * 7 % 28:02d}"
        patients[i] = {"registration_date": f"{on} 08:00:00", "gender": "FM"[i % 2], "age_initiation": float(i),
                       "expiry_date_for_last_arvs": "2000-09-01", "latest_state": ("Patient died", None)[i % 2], "latest_state_date": on}
        for n in range(i % 4):
            seen = f"2000-{1 + (i + 3 * n) % 12:02d}-15"
            details.append(on_art(i, tb_status_date=seen, current_episode_of_tb=(None, seen)[n % 2], karposis_sarcoma=seen,
                                  tb_within_the_last_2_years=seen, last_visit_date=f"2001-0{1 + n}-01", latest_side_effects=f"{seen} 01:00:00"))
    p, d = tables(spark, patients, details)
    asked = [("1999-01-01", "1999-12-31"), ("2000-01-01", "2000-12-31"), ("2000-02-10", "2000-02-10"), ("2000-02-10", "2000-08-20"),
             ("2000-05-05", "2001-06-30"), ("2000-07-01", "2000-06-01"), ("2005-01-01", "2005-01-31")]
    rows = [*asked, asked[1], (None, "2000-12-31"), ("2000-01-01", None)]
    periods = spark.createDataFrame(rows, "start_date string, end_date string")
    got = {(str(r.start_date), str(r.end_date), r.indicator): r.value for r in report.report_periods(spark, p, d, periods).collect()}
    assert len(got) == 82 * len(asked)
    for period in asked:
        one = report.counts(p, d, *period).first().asDict()
        assert {n: got[*period, n] for n in one} == one
    assert report.report_periods(spark, p, d, periods.limit(0)).count() == 0


# Recorded before this code existed, on the same projections: (figure, new A, cum A, new B, cum B).
RECORDED = [
    ("total_reg", 176, 602, 12, 1438), ("ft", 167, 579, 0, 1174), ("re", 4, 9, 3, 84), ("ti", 5, 14, 9, 180),
    ("males", 80, 289, 5, 662), ("non_preg", 43, 137, 4, 362), ("preg_all_age", 37, 129, 2, 304), ("a", 1, 2, 0, 7),
    ("b", 20, 92, 3, 236), ("c", 148, 477, 9, 1109), ("unk_age", 7, 31, 0, 86), ("pres_hiv", 14, 42, 0, 81),
    ("who_3", 14, 44, 0, 94), ("children", 13, 31, 0, 87),
]
RECORDED_OUTCOMES = [
    ("total_on_art", 524, 1328), ("n1a", 0, 10), ("non_std", 507, 1315), ("tb_suspected", 11, 50), ("unknown_tb", 12, 81),
    ("side_effects", 2, 38), ("missed_0_6", 524, 1327), ("missed_7plus", 2, 40), ("died_1st_month", 32, 93),
    ("died_2nd_month", 28, 51), ("died_3rd_month", 18, 48), ("died_after_3rd_month", 65, 147), ("cum_no_tb", 602, 1438),
    ("cum_current_tb", 32, 583), ("cum_ks", 34, 598), ("stopped", 51, 732), ("transfered", 41, 642), ("defaulted", 0, 251),
    ("unknown_outcome", 176, 133),
]


def test_recorded_counts_and_identities(spark):
    from checks.queries import PERIOD_A, PERIOD_B, stored_model

    m = stored_model(spark, "/root/testdata/sf0.01")
    a, b = (report.counts(m.report, m.details, *period).first().asDict() for period in (PERIOD_A, PERIOD_B))
    assert [(n, a[f"new_{n}"], a[f"cum_{n}"], b[f"new_{n}"], b[f"cum_{n}"]) for n, *_ in RECORDED] == RECORDED
    assert [(n, a[n], b[n]) for n, *_ in RECORDED_OUTCOMES] == RECORDED_OUTCOMES
    for got in (a, b):
        for k in ("new", "cum"):
            assert got[f"{k}_ft"] + got[f"{k}_re"] + got[f"{k}_ti"] == got[f"{k}_total_reg"]
        for n in PAIRED:
            assert got[f"cum_{n}"] >= got[f"new_{n}"]
        for n in SINGLE[SINGLE.index("n1a"):]:
            assert got[n] <= got["total_on_art"]


def test_report_plan_joins_once_and_prunes(spark):
    from checks.queries import PERIOD_A, stored_model

    m = stored_model(spark, "/root/testdata/sf0.01")
    plan = report.counts(m.report, m.details, *PERIOD_A)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashJoin") + plan.count("SortMergeJoin") == 1
    assert "Expand" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    assert "birth_date" not in plan and "PushedFilters: [IsNotNull(registration_date)" in plan


def test_read_model_plan_has_no_nested_loops(spark):
    from checks.queries import built_model

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        m = built_model(spark, "/root/testdata/sf0.001")
        for df in (m.report, m.details):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "Cartesian" not in plan and "NestedLoop" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
