"""The report for one period, for one figure, and for every calendar quarter."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from quarterfold.functions import period_label, quarter_index
from quarterfold.operators.lookups import fixed_table
from quarterfold.plans import indicators as ind
from quarterfold.plans.indicators import INDICATORS, sql_day, texts
from quarterfold.plans.layout import cells
from quarterfold.sources.settings import current_site

# Detail columns a predicate reads.
DETAIL_INPUTS = (
    "latest_state", "latest_state_date", "arv_drugs_stopped", "last_visit_date", "expiry_date_for_last_arvs",
    "latest_regimen", "tb_status", "tb_status_date", "latest_side_effects", "missed_drugs_count",
    "last_missed_drugs_date", "current_episode_of_tb", "tb_within_the_last_2_years", "karposis_sarcoma",
)
# Report columns a predicate over details reads.
SHARED_INPUTS = ("art_start_date", "registration_date", "expiry_date_for_last_arvs")

OF_REPORT = [i for i in INDICATORS.values() if not i.on_details]
OF_DETAILS = [i for i in INDICATORS.values() if i.on_details]


def _bits(conditions: Iterable[str]) -> str:
    """Yes/no answers packed into one long; unknown is no."""
    return " + ".join(f"CASE WHEN {cond} THEN {1 << i}L ELSE 0L END" for i, cond in enumerate(conditions))


def _with_terms(df: DataFrame, terms: dict[str, str], bounds: dict[str, str]) -> DataFrame:
    """Adds the terms as columns, those built on other terms after these."""
    names = {**bounds, **{t: t for t in terms}}
    left = dict(terms)
    while left:
        ready = {t: sql for t, sql in left.items() if not any(f"{{{other}}}" in sql for other in left)}
        df = df.withColumns({t: F.expr(sql.format_map(names)) for t, sql in ready.items()})
        left = {t: sql for t, sql in left.items() if t not in ready}
    return df


def counts(report: DataFrame, details: DataFrame, start, end) -> DataFrame:
    """One row with a column per indicator.

    All predicates are answered in one pass: packed per row, combined per
    patient with a bitwise or, then summed. One join and one grouping on the
    same key, no distinct counts.
    """
    bounds = {"start": sql_day(start), "end": sql_day(end)}

    def answers(members: list[ind.Indicator], terms) -> str:
        return _bits(m.sql({**bounds, **{t: t for t in terms}}) for m in members)

    patients = report.filter(
        f"art_start_date IS NOT NULL AND to_date(registration_date) <= {bounds['end']}"
    ).alias("p")
    patients = _with_terms(patients, ind.REPORT_TERMS, bounds).selectExpr(
        "patient_id", *SHARED_INPUTS, f"{answers(OF_REPORT, ind.REPORT_TERMS)} AS report_bits"
    )
    rows = details.selectExpr("patient_id", *DETAIL_INPUTS, "TRUE AS present")
    joined = patients.alias("p").join(rows.alias("d"), "patient_id", "left")
    answered = _with_terms(joined, ind.DETAIL_TERMS, bounds).selectExpr(
        "patient_id", "report_bits",
        f"CASE WHEN d.present THEN {answers(OF_DETAILS, ind.DETAIL_TERMS)} END AS detail_bits",
    )
    per_patient = answered.groupBy("patient_id").agg(
        F.max("report_bits").alias("report_bits"), F.bit_or("detail_bits").alias("detail_bits")
    )
    places = {m.name: ("report_bits", i) for i, m in enumerate(OF_REPORT)}
    places |= {m.name: ("detail_bits", i) for i, m in enumerate(OF_DETAILS)}
    return per_patient.agg(*[
        F.expr(f"coalesce(sum(shiftright({column}, {i}) & 1L), 0L) AS {name}")
        for name, (column, i) in ((n, places[n]) for n in INDICATORS)
    ])


def cohort_report(spark: SparkSession, report: DataFrame, details: DataFrame, start, end) -> DataFrame:
    """Every figure with its place on the printed report, in report order."""
    figures = ", ".join(f"named_struct('indicator', '{name}', 'value', {name})" for name in INDICATORS)
    values = counts(report, details, start, end).selectExpr(f"inline(array({figures}))")
    places = fixed_table(
        spark, cells(), "indicator string, position bigint, line bigint, label string, figure string"
    )
    return (
        values.join(places, "indicator")
        .select("position", "line", "label", "figure", "indicator", "value")
        .orderBy("position", F.desc("figure"))
    )


def indicator(name: str, report: DataFrame, details: DataFrame, start, end) -> DataFrame:
    """One figure on its own, as a one-row ``value``."""
    if name not in INDICATORS:
        raise KeyError(f"unknown indicator {name!r}; one of: {', '.join(INDICATORS)}")
    wanted = INDICATORS[name]
    condition = wanted.spelled_out(sql_day(start), sql_day(end))
    patients = report.alias("p")
    if not wanted.on_details:
        return patients.filter(condition).agg(F.count(F.lit(1)).alias("value"))
    joined = details.alias("d").join(patients, "patient_id", "left")
    return joined.filter(condition).agg(F.countDistinct("patient_id").alias("value"))


def headers(properties: DataFrame, periods: DataFrame, start: str, end: str) -> DataFrame:
    """Adds ``site`` and ``period`` label to every period."""
    site = current_site(properties).select("site").scalar()
    return periods.withColumn("site", site).withColumn("period", period_label(F.col(start), F.col(end)))


def report_header(spark: SparkSession, properties: DataFrame, start, end) -> DataFrame:
    """Site name and period label above the report."""
    one = spark.range(1).selectExpr(f"{sql_day(start)} AS s", f"{sql_day(end)} AS e")
    return headers(properties, one, "s", "e").select("site", "period")


def calendar(spark: SparkSession, from_year: int, to_year: int) -> DataFrame:
    """Quarters of the given years: ``(quarter_no, start_date, end_date)``."""
    starts = F.sequence(
        F.make_date(F.lit(from_year), F.lit(1), F.lit(1)), F.make_date(F.lit(to_year), F.lit(10), F.lit(1)),
        F.expr("interval 3 months"),
    )
    quarters = spark.range(1).select(F.explode(starts).alias("start_date"))
    return quarters.select(
        quarter_index(F.col("start_date")).alias("quarter_no"), "start_date",
        F.last_day(F.add_months("start_date", 2)).alias("end_date"),
    )


# ---- many periods at once ---------------------------------------------------
#
# Seen from one row, each predicate holds for a stretch of report ends: it
# starts when the last needed date is reached and ends when a date that speaks
# against it is. So a row gives intervals of numbers instead of one answer per
# period, and the figures are running sums of interval ends. Numbers are those
# of calendar quarters, or of days where the periods are arbitrary.

_NEVER_ENDS = 1 << 30
_CODES = {name: code for code, name in enumerate(INDICATORS)}


@dataclass(frozen=True)
class _Grain:
    """What the numbers count. ``number`` is the SQL of the number of ``{day}``; ``new_until`` the end of the interval in
    which a patient is new, or None where that depends on the start of the period too."""

    number: str
    new_until: str | None = None

    def of(self, day: str) -> str:
        return self.number.format(day=day)

    def from_day(self, c: str) -> str:
        """First number whose last day is on or after the day of ``c``."""
        return self.of(f"to_date({c})")

    def from_midnight(self, c: str) -> str:
        """First number whose last day's midnight is at or after ``c``."""
        later = f"CASE WHEN CAST(to_date({c}) AS TIMESTAMP_NTZ) < {c} THEN 1 ELSE 0 END"
        return self.of(f"date_add(to_date({c}), {later})")

    def after_day(self, c: str) -> str:
        """First number whose last day is later than the day of ``c``."""
        return self.of(f"date_add(to_date({c}), 1)")


_QUARTERS = _Grain("(year({day}) * 4 + quarter({day}) - 1)", "registered_in + 1")
_DAYS = _Grain("unix_date({day})")


def _interval(name: str, holds: str, lo: str, hi: str) -> str:
    return f"""CASE WHEN ({holds}) AND {lo} < {hi} THEN
        named_struct('code', {_CODES[name]}, 'lo', CAST({lo} AS INT), 'hi', CAST({hi} AS INT)) END"""


def _report_intervals(grain: _Grain) -> list[str]:
    out = []
    terms = {t: t for t in ind.REPORT_TERMS}
    for i in OF_REPORT:
        if i.name == "died_total":
            reached = f"greatest(registered_in, {grain.after_day('p.latest_state_date')})"
            out.append(_interval(i.name, "died AND p.latest_state_date IS NOT NULL", reached, str(_NEVER_ENDS)))
        elif not i.new_only or grain.new_until:
            # these conditions do not look at the end of the period
            until = grain.new_until if i.new_only else str(_NEVER_ENDS)
            out.append(_interval(i.name, i.condition.format_map(terms), "registered_in", until))
    return out


def _detail_intervals(grain: _Grain) -> list[str]:
    """Needs the columns of ``_row_terms`` beside ``p`` and ``d``."""
    out = []
    _from_day, _from_midnight, _after_day = grain.from_day, grain.from_midnight, grain.after_day

    def pair(name: str, holds: str, reached: str) -> None:
        out.append(_interval(f"cum_{name}", holds, reached, str(_NEVER_ENDS)))
        if grain.new_until:
            out.append(_interval(f"new_{name}", holds, reached, grain.new_until))

    def living(name: str, holds: str, reached: str = "alive_from") -> None:
        out.append(_interval(name, f"on_art AND {holds}", reached, "alive_until"))

    def reached_on(column: str) -> str:
        return f"greatest(registered_in, {_from_day(column)})"

    no_tb, two_years = "d.current_episode_of_tb IS NULL", "d.tb_within_the_last_2_years"
    pair("no_tb", f"{no_tb} AND {two_years} IS NULL", "registered_in")
    pair("tb_w2yrs", f"{no_tb} AND {two_years} IS NOT NULL", reached_on(two_years))
    for name, column in (("current_tb", "d.current_episode_of_tb"), ("ks", "d.karposis_sarcoma")):
        pair(name, f"{column} IS NOT NULL", reached_on(column))

    forever = str(_NEVER_ENDS)
    out.append(_interval("stopped", "d.arv_drugs_stopped IS NOT NULL", reached_on("d.arv_drugs_stopped"), forever))
    out.append(_interval(
        "transfered", f"state IN {texts(ind.TRANSFERRED)} AND d.latest_state_date IS NOT NULL",
        reached_on("d.latest_state_date"), forever,
    ))
    out.append(_interval(
        "defaulted", "on_art AND overdue",
        f"greatest(alive_from, {_from_day('p.expiry_date_for_last_arvs')})", forever,
    ))

    living("total_on_art", "TRUE")
    for text in ind.REGIMENS:
        living(f"n{text.lower()}", f"regimen IN {texts(text)}")
    living("non_std", f"regimen IN {texts('Nn')}")
    tested = f"greatest(alive_from, {_from_day('d.tb_status_date')})"
    for name, wanted in ind.TB_STATUS.items():
        living(name, f"status IN {texts(*wanted)} AND d.tb_status_date IS NOT NULL", tested)
    living(
        "side_effects", "d.latest_side_effects IS NOT NULL",
        f"greatest(alive_from, {_from_midnight('d.latest_side_effects')})",
    )
    counted = f"greatest(alive_from, {_from_midnight('d.last_missed_drugs_date')})"
    living("missed_0_6", "missed <= 6", counted)
    living("missed_7plus", "missed >= 7", counted)

    # unknown outcome: every arm must be a plain "no", an unknown arm rules the row out
    expiry = "d.expiry_date_for_last_arvs"
    late = f"(d.last_visit_date IS NULL OR datediff(d.last_visit_date, {expiry}) >= {ind.DEFAULT_AFTER_DAYS})"
    out.append(_interval(
        "unknown_outcome",
        f"(NOT telling OR d.latest_state_date IS NOT NULL) AND {expiry} IS NOT NULL",
        "registered_in",
        f"least({forever}, CASE WHEN telling THEN {_from_midnight('d.latest_state_date')} END, "
        f"{_from_midnight('d.arv_drugs_stopped')}, CASE WHEN {late} THEN {_after_day(expiry)} END)",
    ))
    return out


# Terms shared by the intervals of a row; least() and greatest() pass over NULL.
_OVERDUE = f"(datediff(d.last_visit_date, p.expiry_date_for_last_arvs) >= {ind.DEFAULT_AFTER_DAYS})"
def _row_terms(grain: _Grain) -> dict[str, str]:
    return {t: ind.DETAIL_TERMS[t] for t in ("state", "status", "regimen", "missed")} | {
        "registered_in": grain.from_day("p.registration_date"),
        "alive_from": f"greatest({grain.from_day('p.registration_date')}, {grain.from_midnight('d.latest_state_date')})",
        "overdue": _OVERDUE,
        "alive_until": f"least({_NEVER_ENDS}, {grain.from_midnight('d.arv_drugs_stopped')}, "
        f"CASE WHEN {_OVERDUE} THEN {grain.from_day('p.expiry_date_for_last_arvs')} END)",
        "on_art": f"({{state}} IN {texts(ind.ON_ART)} AND d.latest_state_date IS NOT NULL)",
        "telling": f"({{state}} IN {texts(ind.DIED, ind.TRANSFERRED, ind.ON_ART, ind.STOPPED)} OR {{state}} IS NULL)",
    }


def _explode(df: DataFrame, intervals: list[str]) -> DataFrame:
    held = f"filter(array({', '.join(intervals)}), i -> i IS NOT NULL)"
    return df.selectExpr("patient_id", "registered_in", f"inline({held})")


def _intervals(report: DataFrame, details: DataFrame, grain: _Grain) -> DataFrame:
    """Stretches in which a patient counts for a figure, none overlapping: ``(code, registered_in, lo, hi)``."""
    patients = report.filter("art_start_date IS NOT NULL AND registration_date IS NOT NULL").alias("p")
    unbounded, row_terms = {"start": "NULL", "end": "NULL"}, _row_terms(grain)
    report_terms = {t: sql for t, sql in ind.REPORT_TERMS.items() if t not in ("registered", "in_period")}
    report_terms["registered_in"] = row_terms["registered_in"]
    columns = ("code", "registered_in", "lo", "hi")
    of_report = _explode(_with_terms(patients, report_terms, unbounded), _report_intervals(grain)).select(*columns)

    joined = details.select("patient_id", *DETAIL_INPUTS).alias("d").join(
        patients.select("patient_id", *SHARED_INPUTS).alias("p"), "patient_id"
    )
    termed = _with_terms(joined, row_terms, unbounded)
    merged = _explode(termed, _detail_intervals(grain)).groupBy("patient_id", "code", "registered_in", "lo").agg(
        F.max("hi").alias("hi"))
    # rows of a patient may overlap: keep of each interval what earlier ones left uncovered
    before = Window.partitionBy("patient_id", "code").orderBy("lo").rowsBetween(Window.unboundedPreceding, -1)
    of_details = (
        merged.withColumn("_covered", F.max("hi").over(before))
        .withColumn("lo", F.greatest("lo", "_covered"))
        .select(*columns)
        .filter("lo < hi")
    )
    return of_report.unionByName(of_details)


def _steps(intervals: DataFrame, number: str = "quarter_no") -> DataFrame:
    """+1 where an interval starts, -1 where it ends, summed per figure and number."""
    ends = f"array(named_struct('{number}', lo, 'step', 1), named_struct('{number}', hi, 'step', -1))"
    return (
        intervals.selectExpr("code", f"inline({ends})")
        .groupBy("code", number).agg(F.sum("step").alias("step"))
    )


def report_all_quarters(spark: SparkSession, report: DataFrame, details: DataFrame, from_year: int, to_year: int) -> DataFrame:
    """Every figure for every calendar quarter of the given years.

    ``(start_date, end_date, indicator, value)``. Work and shuffle grow with
    the detail rows, not with rows times quarters.
    """
    steps = _steps(_intervals(report, details, _QUARTERS))
    first, last = from_year * 4, to_year * 4 + 3
    # steps before the calendar count from its first quarter on, steps after it not at all
    placed = (
        steps.filter(F.col("quarter_no") <= last)
        .groupBy("code", F.greatest("quarter_no", F.lit(first)).alias("quarter_no"))
        .agg(F.sum("step").alias("step"))
    )
    names = fixed_table(spark, list(enumerate(INDICATORS)), "code int, indicator string")
    grid = names.withColumn("quarter_no", F.explode(F.sequence(F.lit(first), F.lit(last))))
    running = Window.partitionBy("code").orderBy("quarter_no").rowsBetween(Window.unboundedPreceding, 0)
    start = F.make_date(F.floor(F.col("quarter_no") / 4).cast("int"), F.col("quarter_no") % 4 * 3 + 1, F.lit(1))
    return (
        grid.join(placed, ["code", "quarter_no"], "left")
        .withColumn("value", F.sum(F.coalesce("step", F.lit(0))).over(running).cast("long"))
        .select(
            start.alias("start_date"), F.last_day(F.add_months(start, 2)).alias("end_date"), "indicator", "value"
        )
    )


# Figures of new patients and the figure over all patients under the same condition.
_NEW_OF = {_CODES[n.replace("new_", "cum_", 1)]: _CODES[n] for n in INDICATORS if n.startswith("new_")}


def report_periods(spark: SparkSession, report: DataFrame, details: DataFrame, periods: DataFrame) -> DataFrame:
    """Every figure for every period ``(start_date, end_date)``, which may be of any length and overlap.

    ``(start_date, end_date, indicator, value)``, one row per figure and different period; periods without a
    bound are passed over, and in one that ends before it starts nobody is new. Rows of the read model are reduced to
    counts per figure and day (figures of new patients: per day of registration and day from which they count) whatever
    the periods, so no row meets a period. What is left are sums over the first and last days of the periods, of which
    there are no more than days of the calendar.
    """
    bounds = periods.selectExpr("unix_date(to_date(start_date)) AS s", "unix_date(to_date(end_date)) AS e").dropna().distinct()
    limits = bounds.selectExpr("array_sort(collect_set(e)) AS ends", "array_sort(collect_set(CASE WHEN s <= e THEN s END)) AS starts")
    ends = limits.selectExpr("ends", "posexplode(ends) AS (end_no, e)")
    starts = limits.selectExpr("starts", "posexplode(starts) AS (start_no, s)", "array_max(ends) AS last")
    # the first end on or after a day, the last start on or before it
    end_of = ends.selectExpr("end_no", "explode(sequence(coalesce(try_element_at(ends, nullif(end_no, 0)) + 1, e), e)) AS at")
    start_of = starts.selectExpr(
        "start_no", "explode(sequence(s, greatest(s, coalesce(try_element_at(starts, start_no + 2) - 1, last)))) AS registered_in")
    first_end = limits.selectExpr("ends[0]").scalar()

    intervals = _intervals(report, details, _DAYS)
    placed = (
        _steps(intervals, "at").withColumn("at", F.greatest("at", first_end))
        .join(end_of, "at").groupBy("code", "end_no").agg(F.sum("step").alias("step"))
    )
    codes = F.explode(F.array(*[F.lit(c) for c in _CODES.values() if c not in _NEW_OF.values()])).alias("code")
    running = Window.partitionBy("code").orderBy("end_no").rowsBetween(Window.unboundedPreceding, 0)
    totals = (
        ends.select("end_no", "e", codes).join(placed, ["code", "end_no"], "left")
        .select("code", "e", F.sum(F.coalesce("step", F.lit(0))).over(running).alias("total"))
    )

    # new patients: registered on or after the start, counted from a day on or before the end
    new_code = " ".join(f"WHEN {of_all} THEN {new}" for of_all, new in _NEW_OF.items())
    cells = (
        intervals.filter(F.col("code").isin(list(_NEW_OF)))
        .groupBy("code", "registered_in", F.greatest("lo", first_end).alias("at")).agg(F.count(F.lit(1)).alias("n"))
        .join(start_of, "registered_in").join(end_of, "at")
        .groupBy(F.expr(f"CASE code {new_code} END").alias("code"), "start_no", "end_no").agg(F.sum("n").alias("n"))
    )
    on_end = cells.select("code", "end_no").distinct().withColumn(
        "start_no", F.explode(F.sequence(F.lit(0), limits.selectExpr("size(starts) - 1").scalar())))
    from_start = Window.partitionBy("code", "end_no").orderBy(F.desc("start_no")).rowsBetween(Window.unboundedPreceding, 0)
    reached = on_end.join(cells, ["code", "end_no", "start_no"], "left").select(
        "code", "start_no", "end_no", F.sum(F.coalesce("n", F.lit(0))).over(from_start).alias("n"))
    asked = (
        bounds.join(starts.select("start_no", "s"), "s").join(ends.select("end_no", "e"), "e")
        .withColumn("code", F.explode(F.array(*map(F.lit, _NEW_OF.values()))))
    )
    by_end = Window.partitionBy("code", "start_no").orderBy("end_no").rangeBetween(Window.unboundedPreceding, 0)
    new = (
        asked.select("code", "start_no", "end_no", F.lit(0).alias("n"), "s", "e")
        .unionByName(reached, allowMissingColumns=True)
        .withColumn("new", F.sum("n").over(by_end)).filter("e IS NOT NULL").select("code", "s", "e", "new")
    )
    names = F.explode(F.array(*[F.struct(F.lit(c).alias("code"), F.lit(n).alias("indicator")) for n, c in _CODES.items()]))
    return (
        bounds.select("s", "e", names.alias("f")).select("s", "e", "f.code", "f.indicator")
        .join(totals, ["code", "e"], "left").join(new, ["code", "s", "e"], "left")
        .selectExpr("date_from_unix_date(s) AS start_date", "date_from_unix_date(e) AS end_date", "indicator",
                    "coalesce(new, total, 0L) AS value")
    )
