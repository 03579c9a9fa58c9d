"""Clinical rules as set operations over the source-side tables.

``src`` is a mapping with ``patient``, ``obs``, ``encounter``,
``encounter_type``, ``concept`` and ``concept_set``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from quarterfold.functions import age_years, ci
from quarterfold.operators.lookups import concept_roles, fixed_table
from quarterfold.operators.rows import any_per

CHILD_UP_TO = 14
STAGING = "HIV Staging"
FIRST_STAGING_DEFAULT = "2010-01-01"
# Regimen concept, age band, category.
REGIMEN_CATEGORIES = (
    (450, "P", "P1"), (450, "A", "1A"),
    (451, "P", "2P"), (451, "A", "2A"),
    (452, "P", "3P"), (452, "A", "3A"),
    (458, "P", "4P"), (458, "A", "4A"),
    (826, "P", "5P"), (826, "A", "5A"),
    (827, "P", "6P"), (827, "A", "6A"),
    (828, "P", "7P"), (828, "A", "7A"),
    (829, "P", "8P"), (829, "A", "8A"),
    (453, "P", "9P"), (453, "A", "9A"),
)
OTHER_REGIMEN = "Nn"
STAGES = (4, 3, 2)
BANDS = ("peds", "adult")
# Lymphocyte limits by age, as meant and as the rule was written down.
LYMPHOCYTE_LIMITS = (
    *((age, 4000) for age in (0, 1, 2)), *((age, 3000) for age in (3, 4)), (5, 2500),
    *((age, 2000) for age in range(6, 16)),
)
LYMPHOCYTE_LIMITS_AS_WRITTEN = ((0, 2000), (1, 4000), (5, 2500))
# Concept names the eligibility rule reads.
ELIGIBILITY_ROLES: Mapping[str, tuple[str, ...]] = {
    "yes": ("Yes",),
    "cd4": ("CD4 count",),
    "cd4_750": ("CD4 Count < 750",),
    "lymphocytes": ("Lymphocyte count",),
    "pregnant": ("Pregnant",),
    "breastfeeding": ("Breastfeeding",),
    "first_test": ("First positive HIV Test",),
    "pcr": ("PCR Test",),
    "rapid": ("Rapid Test",),
    "pneumocystis": ("Pneumocystis pneumonia",),
    "candidiasis": ("Candidiasis of oesophagus",),
    "cryptococcal": ("Cryptococcal meningitis",),
    "wasting": (
        "Severe unexplained wasting / malnutrition not responding to treatment(weight-for-height/ -age less than "
        "70% or MUAC less than 11cm or oedema)",
    ),
    "toxoplasmosis": ("Toxoplasmosis of the brain (from age 1 month)",),
    "thrush": ("Oral thrush",),
    "sepsis": ("Sepsis, severe",),
    "pneumonia": ("Pneumonia, severe",),
}
CONDITIONS = (
    "pneumocystis", "candidiasis", "cryptococcal", "wasting", "toxoplasmosis", "thrush", "sepsis", "pneumonia",
)


def patient_ages(df: DataFrame, patients: DataFrame, on: str, as_of: str, out: str = "age") -> DataFrame:
    """Adds the age of the patient of each row on the day in column ``on``."""
    born = patients.select("patient_id", "birthdate", "birthdate_estimated", F.col("date_created").alias("_created"))
    age = age_years(F.col("birthdate"), F.col(on), F.col("_created"), F.col("birthdate_estimated"), as_of)
    return df.join(born, "patient_id", "left").withColumn(out, age).drop("birthdate", "birthdate_estimated", "_created")


def regimen_category(
    df: DataFrame, patients: DataFrame, regimen: str, dispensed: str, as_of: str, out: str = "category"
) -> DataFrame:
    """Adds the regimen category by regimen concept and age band on the dispensing day."""
    table = fixed_table(df.sparkSession, REGIMEN_CATEGORIES, f"_regimen bigint, _band string, {out} string")
    aged = patient_ages(df, patients, dispensed, as_of, "_age").withColumn(
        "_band", F.expr(f"CASE WHEN _age <= {CHILD_UP_TO} THEN 'P' WHEN _age > {CHILD_UP_TO} THEN 'A' END")
    ).withColumn("_regimen", F.col(regimen))
    return (
        aged.join(table, ["_regimen", "_band"], "left")
        .withColumn(out, F.coalesce(out, F.lit(OTHER_REGIMEN)))
        .drop("_age", "_band", "_regimen")
    )


def _staging_encounters(src, columns: list[str], voided_too: bool) -> DataFrame:
    types = src["encounter_type"].filter(ci(F.col("name")) == STAGING.lower())
    types = F.broadcast(types.selectExpr("encounter_type_id AS encounter_type"))
    visits = src["encounter"] if voided_too else src["encounter"].filter("voided = 0")
    return visits.join(types, "encounter_type", "left_semi").select("patient_id", *columns)


def stage_members(src) -> DataFrame:
    """Conditions that define a stage: ``(concept_id, peds, adult)``, the highest stage by band."""
    sets = " ".join(
        f"WHEN 'who stage {n} {band}' THEN named_struct('stage', {n}, 'band', '{band}')" for n in STAGES for band in BANDS
    )
    named = src["concept"].withColumn("_set", F.expr(f"CASE lower(rtrim(name)) {sets} END")).filter("_set IS NOT NULL")
    return (
        src["concept_set"].join(named.selectExpr("concept_id AS concept_set", "_set"), "concept_set")
        .groupBy("concept_id").agg(*[F.expr(f"max(CASE WHEN _set.band = '{b}' THEN _set.stage END) AS {b}") for b in BANDS])
    )


def _band(age: str) -> str:
    return f"CASE WHEN {age} <= {CHILD_UP_TO} THEN 'peds' ELSE 'adult' END"


def _stage(band: str) -> str:
    """Stage by band, over the columns of ``stage_bands``."""
    return f"coalesce(CASE {band} {' '.join(f'WHEN {b!r} THEN {b}' for b in BANDS)} END, 1)"


def _staging_visit(src) -> DataFrame:
    """The staging visit of each patient (the one with the lowest id)."""
    return any_per(_staging_encounters(src, ["encounter_id"], voided_too=False), "patient_id", "encounter_id")


def stage_bands(src) -> DataFrame:
    """Highest stage with a confirmed condition at the staging visit, by the criteria of each band:
    ``(patient_id, peds, adult)``. Kept once per patient, it answers for any day, on which only the band depends."""
    yes = F.broadcast(src["concept"].filter(ci(F.col("name")) == "yes").selectExpr("concept_id AS value_coded"))
    return (
        src["obs"].select("patient_id", "encounter_id", "concept_id", "value_coded")
        .join(yes, "value_coded", "left_semi")
        .join(stage_members(src), "concept_id")
        .join(_staging_visit(src), ["patient_id", "encounter_id"], "left_semi")
        .groupBy("patient_id").agg(*[F.max(b).alias(b) for b in BANDS])
    )


def who_stage(src, asked: DataFrame, as_of: str) -> DataFrame:
    """Stage of each patient of ``asked (patient_id, asked)`` by the child or adult criteria of that day.

    The highest stage with a confirmed condition at the patient's staging
    visit (the one with the lowest id), else 1.
    """
    aged = patient_ages(asked.select("patient_id", "asked"), src["patient"], "asked", as_of, "_age")
    return aged.join(stage_bands(src), "patient_id", "left").selectExpr(
        "patient_id", f"{_band('_age')} AS band", f"{_stage(_band('_age'))} AS stage"
    )


def _role(column: str, *wanted: str) -> str:
    order = list(ELIGIBILITY_ROLES)
    return f"(coalesce({column}, 0) & {sum(1 << order.index(w) for w in wanted)}) <> 0"


def _observed_flags() -> list[str]:
    """Aggregates over the observations of a patient (or, as written, of everybody)."""
    def confirmed(role: str) -> str:
        return f"bool_or({_role('asked_roles', role)} AND {_role('value_roles', 'yes')} AND voided = 0)"

    def low_cd4(limit: int) -> str:
        return (
            f"bool_or({_role('asked_roles', 'cd4')} AND value_numeric <= {limit} "
            f"AND {_role('value_roles', 'yes')} AND voided = 0)"
        )

    def tested(kind: str) -> str:
        return f"bool_or({_role('asked_roles', 'first_test')} AND {_role('value_roles', kind)} AND voided = 0)"

    return [
        f"{low_cd4(250)} AS cd4_250",
        f"{low_cd4(350)} AS cd4_350",
        # a low count alone is enough here, soft-deleted or not
        f"bool_or(({_role('asked_roles', 'cd4')} AND value_numeric <= 750) OR "
        f"({_role('asked_roles', 'cd4_750')} AND {_role('value_roles', 'yes')} AND voided = 0)) AS cd4_750",
        f"min(CASE WHEN {_role('asked_roles', 'lymphocytes')} AND voided = 0 THEN value_numeric END) AS lymphocytes",
        f"{confirmed('pregnant')} AS pregnant",
        f"{confirmed('breastfeeding')} AS breastfeeding",
        f"{tested('pcr')} AS pcr",
        f"{tested('rapid')} AS rapid",
        *[f"{confirmed(c)} AS {c}" for c in CONDITIONS],
    ]


# Flags the rule, as written down, counts over everybody rather than the patient.
EVERYBODYS_FLAGS = ("cd4_750", "lymphocytes", "pregnant", "breastfeeding", "pcr", "rapid", *CONDITIONS)

_PRESUMED_CONDITIONS = (
    "(pneumocystis OR candidiasis OR cryptococcal OR wasting OR toxoplasmosis "
    "OR (thrush AND sepsis) OR (thrush AND pneumonia) OR (sepsis AND pneumonia))"
)
# Condition and reason, first match wins; ``child`` rules apply up to age 14 only.
_RULES: tuple[tuple[str, str], ...] = (
    (f"child AND months <= 17 AND rapid AND {_PRESUMED_CONDITIONS}", "'Presumed HIV Disease'"),
    ("child AND months <= 12 AND pcr AND staged", "'PCR Test'"),
    ("stage >= 3", "concat('WHO stage ', stage, ' ', band)"),
    ("child AND months >= 12 AND months < 24", "'Child HIV positive'"),
    ("child AND months >= 24 AND months < 56 AND cd4_750", "'CD4 count < 750'"),
    ("cd4_350 AND first_staging >= DATE'2011-07-01'", "'CD4 count < 350'"),
    ("cd4_250", "'CD4 count < 250'"),
    # no limit is set for adults, so the rule never applies to them
    ("child AND lymphocytes <= lymphocyte_limit AND stage = 2", "'Lymphocyte count below threshold with WHO stage 2'"),
    ("female AND pregnant", "'Pregnant'"),
    ("female AND breastfeeding", "'Breastfeeding'"),
)


def _told(src) -> DataFrame:
    """Observations the rules read, with the roles of question and answer, and the stages that the question stands for."""
    roles = concept_roles(src["concept"], ELIGIBILITY_ROLES)
    asked = roles.withColumnRenamed("roles", "asked_roles").join(stage_members(src), "concept_id", "full")
    answered = F.broadcast(roles).selectExpr("concept_id AS value_coded", "roles AS value_roles")
    return (
        src["obs"].select("patient_id", "encounter_id", "concept_id", "value_coded", "value_numeric", "voided")
        .join(asked, "concept_id").join(answered, "value_coded", "left")
    )


# How the answers of a patient's visits combine.
_COMBINE = {"lymphocytes": F.min}


def _of_patients(src, told: DataFrame) -> DataFrame:
    """Flags and stages by band of each patient, from one pass over the observations.

    Rows are combined per visit first, so that only visits meet the staging visits.
    """
    confirmed = [f"max(CASE WHEN {_role('value_roles', 'yes')} THEN {b} END) AS {b}" for b in BANDS]
    visits = told.groupBy("patient_id", "encounter_id").agg(*[F.expr(f) for f in (*_observed_flags(), *confirmed)])
    staging = _staging_visit(src).withColumnRenamed("encounter_id", "_staging")
    flags = [c for c in visits.columns if c not in ("patient_id", "encounter_id", *BANDS)]
    return visits.join(staging, "patient_id", "left").groupBy("patient_id").agg(
        *[_COMBINE.get(f, F.bool_or)(f).alias(f) for f in flags],
        *[F.expr(f"max(CASE WHEN encounter_id = _staging THEN {b} END) AS {b}") for b in BANDS],
    )


def eligibility_cases(src, as_of: str, compat: str = "intended") -> DataFrame:
    """Reason for eligibility and stage today: ``(patient_id, reason, reason_concept_id, stage_today)``.

    ``intended`` looks at the patient's own observations throughout;
    ``as_written`` keeps the conditions that were counted over all patients.
    Patients and observations are read once each.
    """
    if compat not in ("intended", "as_written"):
        raise ValueError(f"compat must be 'intended' or 'as_written', not {compat!r}")
    as_written = compat == "as_written"
    told = _told(src)
    stagings = _staging_encounters(src, ["encounter_datetime"], voided_too=True)
    staged = stagings.groupBy("patient_id").agg(
        F.to_date(F.min("encounter_datetime")).alias("first_staging"),
        F.to_date(F.max("encounter_datetime")).alias("latest_staging"),
    )
    cases = (
        src["patient"].select("patient_id", "gender", "birthdate", "birthdate_estimated", "date_created")
        .join(staged, "patient_id", "left")
        .join(_of_patients(src, told), "patient_id", "left")
        .withColumn("staged", F.col("first_staging").isNotNull())
        .withColumn("first_staging", F.coalesce("first_staging", F.lit(FIRST_STAGING_DEFAULT).cast("date")))
    )
    if as_written:
        everybody = told.agg(*[F.expr(f) for f in _observed_flags()])
        cases = cases.withColumns({f: everybody.select(f).scalar() for f in EVERYBODYS_FLAGS}).withColumn(
            "latest_staging", stagings.agg(F.to_date(F.max("encounter_datetime"))).scalar()
        )
    limits = fixed_table(
        src["patient"].sparkSession, LYMPHOCYTE_LIMITS_AS_WRITTEN if as_written else LYMPHOCYTE_LIMITS,
        "age int, lymphocyte_limit int",
    )

    def aged(on) -> Column:
        return age_years(F.col("birthdate"), on, F.col("date_created"), F.col("birthdate_estimated"), as_of)

    cases = cases.withColumns({
        "age": aged(F.col("first_staging")), "_years": aged(F.col("latest_staging")),
        "_today": aged(F.lit(as_of).cast("date")),
    })
    judged = cases.join(limits, "age", "left").withColumns({
        "band": F.expr(_band("age")),
        "stage": F.expr(_stage(_band("age"))),
        "stage_today": F.expr(_stage(_band("_today"))),
        "child": F.expr(f"coalesce(age <= {CHILD_UP_TO}, FALSE)"),
        "months": F.expr("_years * 12"),
        "female": F.expr(f"lower(rtrim(gender)) = 'female' AND first_staging >= DATE'{FIRST_STAGING_DEFAULT}'"),
    })
    arms = " ".join(f"WHEN {condition} THEN {reason}" for condition, reason in _RULES)
    reasons = judged.withColumn("reason", F.expr(f"CASE {arms} END")).select("patient_id", "reason", "stage_today")
    ids = src["concept"].groupBy(ci(F.col("name")).alias("_key")).agg(F.min("concept_id").alias("reason_concept_id"))
    return (
        reasons.withColumn("_key", ci(F.col("reason")))
        .join(ids, "_key", "left")
        .select("patient_id", "reason", "reason_concept_id", "stage_today")
    )


def art_eligibility_reason(src, as_of: str, compat: str = "intended") -> DataFrame:
    """Reason for eligibility per patient: ``(patient_id, reason, reason_concept_id)``, see ``eligibility_cases``."""
    return eligibility_cases(src, as_of, compat).drop("stage_today")
