"""The registered queries and the SQL each is checked with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks import queries_migration, queries_streaming, sql_migration, sql_readmodel, sql_report, sql_rules
from quarterfold.fixtures import Renamed, fixtures_of
from quarterfold.operators import rules
from quarterfold.operators.views import VIEWS
from quarterfold.plans import readmodel, report
from quarterfold.plans.indicators import INDICATORS
from quarterfold.plans.layout import cells
from quarterfold.sources.scratch import fresh_path

PERIOD_A = ("1995-07-01", "1995-09-30")
PERIOD_B = ("2000-10-01", "2000-12-31")
AS_OF = sql_readmodel.AS_OF
YEARS = (1995, 2001)

Query = Callable[[SparkSession, str], DataFrame]
_written: dict[tuple[str, str], str] = {}


def built_model(spark: SparkSession, sf_dir: str) -> readmodel.ReadModel:
    return readmodel.build(fixtures_of(spark, sf_dir), AS_OF)


def stored_model(spark: SparkSession, sf_dir: str) -> readmodel.ReadModel:
    """The read model as tables: derived once per session, then read by every report query."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _written:
        path = fresh_path(spark, "read-model")
        readmodel.write(spark, fixtures_of(spark, sf_dir), AS_OF, path)
        _written[key] = path
    return readmodel.read(spark, _written[key])


def _single(name: str) -> Query:
    start, end = PERIOD_A if name.startswith("new_") else PERIOD_B

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        m = stored_model(spark, sf_dir)
        return report.indicator(name, m.report, m.details, start, end)

    return run


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = stored_model(spark, sf_dir)
    return report.cohort_report(spark, m.report, m.details, *PERIOD_A)


def _all_quarters(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = stored_model(spark, sf_dir)
    return report.report_all_quarters(spark, m.report, m.details, *YEARS)


def periods_of_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each year with a visit, and from the first day of each quarter with one a stretch of 100 days, which overlap."""
    days = fixtures_of(spark, sf_dir)["encounter"].selectExpr("to_date(encounter_datetime) AS day")
    years = days.selectExpr("trunc(day, 'year') AS start_date").distinct()
    quarters = days.selectExpr("trunc(day, 'quarter') AS start_date").distinct()
    return years.selectExpr("start_date", "date_sub(add_months(start_date, 12), 1) AS end_date").unionByName(
        quarters.selectExpr("start_date", "date_add(start_date, 99) AS end_date"))


def _periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = stored_model(spark, sf_dir)
    return report.report_periods(spark, m.report, m.details, periods_of_visits(spark, sf_dir))


def _calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarters of the years with a registration, each with the number of patients registered."""
    registered = stored_model(spark, sf_dir).report.selectExpr("to_date(registration_date) AS day").filter("day IS NOT NULL")
    first, last = registered.selectExpr("min(year(day))", "max(year(day))").first()
    per_quarter = registered.groupBy(F.expr("trunc(day, 'quarter') AS start_date")).agg(F.count("*").alias("registered"))
    return report.calendar(spark, first, last).join(per_quarter, "start_date", "left").select(
        "start_date", "end_date", F.coalesce("registered", F.lit(0)).alias("registered"))


def source_tables(spark: SparkSession, sf_dir: str) -> Renamed:
    """The source side of a migration, by plain table names."""
    return Renamed(fixtures_of(spark, sf_dir), "src_")


def _header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header of the period that spans all visits."""
    fixtures = fixtures_of(spark, sf_dir)
    visits = fixtures["encounter"].selectExpr("to_date(min(encounter_datetime)) AS s", "to_date(max(encounter_datetime)) AS e")
    return report.headers(fixtures["global_property"], visits, "s", "e").select("site", "period")


def _headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header of each quarter with a visit."""
    fixtures = fixtures_of(spark, sf_dir)
    quarters = fixtures["encounter"].selectExpr("trunc(encounter_datetime, 'quarter') AS s").distinct()
    quarters = quarters.selectExpr("s", "last_day(add_months(s, 2)) AS e")
    return report.headers(fixtures["global_property"], quarters, "s", "e").select("s", "e", "site", "period")


def _view(name: str) -> Query:
    return lambda spark, sf_dir: VIEWS[name](fixtures_of(spark, sf_dir))


def _age(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = source_tables(spark, sf_dir)
    visits = src["encounter"].select("patient_id", "encounter_id", "encounter_datetime")
    aged = rules.patient_ages(visits, src["patient"], "encounter_datetime", "2001-03-31")
    return aged.select("patient_id", "encounter_id", aged.age.cast("long").alias("age"))


def _regimen(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = source_tables(spark, sf_dir)
    drugs = src["drug_order"].join(src["drug"].selectExpr("drug_id AS drug_inventory_id", "concept_id AS regimen"), "drug_inventory_id", "left")
    dispensed = (
        src["orders"].select("order_id", "encounter_id", "date_created")
        .join(src["encounter"].select("encounter_id", "patient_id"), "encounter_id")
        .join(drugs.select("order_id", "regimen"), "order_id")
    )
    return rules.regimen_category(dispensed, src["patient"], "regimen", "date_created", AS_OF).select(
        "order_id", "patient_id", "category"
    )


def _stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = source_tables(spark, sf_dir)
    asked = src["patient"].selectExpr("patient_id", f"DATE'{AS_OF}' AS asked")
    staged = rules.who_stage(src, asked, AS_OF)
    return staged.select("patient_id", "band", staged.stage.cast("long").alias("stage"))


def _reason(compat: str) -> Query:
    return lambda spark, sf_dir: rules.art_eligibility_reason(source_tables(spark, sf_dir), AS_OF, compat)


QUERIES: dict[str, Query] = {
    "patient_report": lambda s, d: built_model(s, d).report,
    "patient_quarter": lambda s, d: built_model(s, d).details,
    "cohort_report": _report,
    "cohort_report_all_quarters": _all_quarters,
    "cohort_report_periods": _periods,
    "report_calendar": _calendar,
    "report_header": _header,
    "report_headers": _headers,
    **{f"ind_{n}": _single(n) for n in INDICATORS},
    **{f"view_{n}": _view(n) for n in VIEWS},
    "rule_age": _age,
    "rule_regimen": _regimen,
    "rule_stage": _stage,
    "rule_reason": _reason("intended"),
    "rule_reason_as_written": _reason("as_written"),
    **queries_migration.queries(),
    **queries_streaming.QUERIES,
}

SQL: dict[str, str] = {
    "patient_report": sql_readmodel.read_model("SELECT * FROM p"),
    "patient_quarter": sql_readmodel.read_model("SELECT * FROM d"),
    "cohort_report": sql_report.report(*PERIOD_A, cells()),
    "cohort_report_all_quarters": sql_report.all_quarters(*YEARS),
    "cohort_report_periods": sql_report.PERIODS,
    "report_calendar": sql_report.CALENDAR,
    "report_header": sql_report.HEADER,
    "report_headers": sql_report.HEADERS,
    **{
        f"ind_{n}": sql_report.figure(n, *(PERIOD_A if n.startswith("new_") else PERIOD_B)) for n in INDICATORS
    },
    **{f"view_{n}": sql_readmodel.with_tables(t) + q for n, (t, q) in sql_rules.VIEW_SQL.items()},
    **sql_rules.RULE_SQL,
    **sql_migration.MIGRATION_SQL,
    "stream_patient_report": sql_readmodel.read_model("SELECT * FROM p"),
    "append_by_batch": sql_readmodel.with_tables(["obs"]) + "SELECT obs_id, person_id, concept_id, value_coded FROM fx_obs",
    "copied_set": sql_readmodel.with_tables(["patient", "person"]) + """
        SELECT patient_id, CASE WHEN patient_id % 10 <> 0 THEN CAST(pa.date_created AS DATE) END AS date_created, gender
        FROM fx_patient pa JOIN fx_person pe ON person_id = patient_id""",
    "export_null_text": sql_readmodel.with_tables(["obs"]) + """
        SELECT obs_id, coalesce(CAST(value_coded AS VARCHAR), 'NULL') AS value_coded,
          coalesce(CAST(CAST(trunc(value_numeric) AS BIGINT) AS VARCHAR), 'NULL') AS value_numeric, coalesce(value_text, 'NULL') AS value_text
        FROM fx_obs""",
    "stream_updates_report": sql_readmodel.read_model("SELECT * FROM p"),
    "stream_updates_quarter": sql_readmodel.read_model("SELECT * FROM d"),
    "stream_late_lookups": sql_readmodel.read_model("SELECT * FROM p"),
    "stream_patient_quarter": sql_readmodel.read_model("SELECT * FROM d"),
    "patient_report_by_arrival": sql_readmodel.by_arrival("SELECT * FROM p"),
}
