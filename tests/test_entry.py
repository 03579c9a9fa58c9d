from __future__ import annotations

import pytest

import __spark_entry__ as registered
from checks.compare import difference, duck
from checks.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
SAMPLE = [
    "patient_report", "patient_quarter", "cohort_report_all_quarters", "report_headers", "view_earliest_start_date", "rule_stage",
    "rule_reason_as_written", "mig_orders", "mig_eligibility_obs", "mig_relationships", "quarantine", "person_closure",
    "stream_patient_quarter", "stream_states_once", "patient_report_by_arrival", "ind_unknown_outcome",
]


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(registered.queries()) and set(registered.oracle_sql()) <= set(registered.queries())


def test_entry_gives_the_full_report(spark):
    df = registered.entry(spark)
    assert df.columns == ["position", "line", "label", "figure", "indicator", "value"] and df.count() == 82


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_sql(spark, name):
    assert difference(registered.queries()[name](spark, SF), duck(SF), registered.oracle_sql()[name]) is None
