from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quarterfold import functions as Q


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def d(text):
    return F.lit(text).cast("date")


def ts(text):
    return F.lit(text).cast("timestamp_ntz")


@pytest.mark.parametrize("days, years", [(0, 0), (365, 0), (366, 1), (730, 1), (731, 2), (5844, 16)])
def test_elapsed_years_by_day_count(spark, days, years):
    assert value(spark, Q.elapsed_years(d("1990-03-01"), F.date_add(d("1990-03-01"), days))) == years


@pytest.mark.parametrize("birth, created, estimated, as_of, age", [
    ("1990-07-01", "2001-02-01", 1, "2001-03-31", 11),
    ("1990-07-01", "2001-02-01", 1, "2001-07-01", 10),
    ("1990-07-01", "2000-02-01", 1, "2001-03-31", 10),
    ("1990-07-01", "2001-02-01", 0, "2001-03-31", 10),
    ("1990-07-02", "2001-02-01", 1, "2001-03-31", 10),
])
def test_age_adds_a_year_for_an_estimated_midyear_birth(spark, birth, created, estimated, as_of, age):
    assert value(spark, Q.age_years(d(birth), d("2001-03-01"), ts(created), F.lit(estimated), as_of)) == age


def test_age_of_unknown_birth_is_unknown(spark):
    assert value(spark, Q.age_years(F.lit(None).cast("date"), d("2001-03-01"), ts("2001-01-01"), F.lit(1), "2001-03-31")) is None


@pytest.mark.parametrize("start, end, label", [
    ("2000-10-01", "2000-12-31", "2000 - 4th Quarter"),
    ("2000-01-05", "2000-03-01", "2000 - 1st Quarter"),
    ("2000-10-01", "2001-01-15", "01/Oct/2000 to 15/Jan/2001"),
    ("1999-04-01", "2000-06-30", "01/Apr/1999 to 30/Jun/2000"),
])
def test_period_label(spark, start, end, label):
    assert value(spark, Q.period_label(d(start), d(end))) == label


def test_last_day_by_day_and_by_midnight(spark):
    late = ts("2000-12-31 10:00:00")
    assert value(spark, Q.up_to(late, "2000-12-31")) is True
    assert value(spark, Q.not_after_midnight(late, "2000-12-31")) is False
    assert value(spark, Q.not_after_midnight(ts("2000-12-31"), "2000-12-31")) is True
    assert str(value(spark, Q.ceil_day(late))) == "2001-01-01"
    assert str(value(spark, Q.ceil_day(ts("2000-12-31")))) == "2000-12-31"


def test_fraction_of_a_day_is_rounded(spark):
    assert str(value(spark, Q.add_days(ts("2000-01-01 08:00:00"), F.lit(16.67)))) == "2000-01-18 08:00:00"
    assert value(spark, Q.add_days(ts("2000-01-01"), F.try_divide(F.lit(50.0), F.lit(0.0)))) is None


def test_text_ignores_case_and_trailing_blanks(spark):
    assert value(spark, Q.ci_equals(F.lit("patient DIED  "), "Patient died")) is True
    assert value(spark, Q.ci_prefix(F.lit("Who Stage iii adult"), "WHO STAGE III")) is True
    assert value(spark, Q.title_case(F.lit("  mulanje   district HOSPITAL "))) == "Mulanje District Hospital"


def test_negated_disjunctions(spark):
    unknown = F.lit(None).cast("boolean")
    assert value(spark, Q.not_any3(F.lit(False), unknown)) is None
    assert value(spark, Q.not_any3(F.lit(False), F.lit(False))) is True
    assert value(spark, Q.none_of(F.lit(None).cast("string"), ["x", ""])) is False
    assert value(spark, Q.none_of(F.lit("y"), ["x", ""], ["who"])) is True


def test_row_uuid_is_repeatable_and_shaped(spark):
    first, again = (value(spark, Q.row_uuid("person", F.lit(7))) for _ in range(2))
    assert first == again and [len(p) for p in first.split("-")] == [8, 4, 4, 4, 12]
    assert first != value(spark, Q.row_uuid("patient", F.lit(7)))


def test_quarters(spark):
    assert str(value(spark, Q.quarter_start(ts("2000-05-17 03:00:00")))) == "2000-04-01"
    q = [value(spark, Q.quarter_index(d(x))) for x in ("1999-12-31", "2000-01-01", "2000-12-31")]
    assert q[1] == q[0] + 1 and q[2] == q[1] + 3
