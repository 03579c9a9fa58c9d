"""The read model: one row per patient, one row per patient and quarter.

``fold`` reduces events (or earlier folds) to one row of slots per patient and
quarter. It is a ``max`` per slot, hence order-free, repeatable and mergeable:
batch, streaming and compaction all call the same function.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from quarterfold.operators.lookups import Dictionary, coded_name
from quarterfold.operators.rows import dealt
from quarterfold.plans.events import PROGRAM, SLOTS, STATE_ROLES, ClinicalEvents, Ordering, combined

START_COLUMNS = ("art_start_date", "age_initiation", "registration_date")


def fold(events: DataFrame) -> DataFrame:
    """Slots per patient and calendar quarter, all quarters of a patient in one task, in order.

    Rows are dealt by patient before they are combined, as few of them share a quarter: combined before the shuffle too,
    nearly all of them would be sorted twice. What goes on by patient from here needs no further shuffle or sort.
    """
    events = dealt(events.select("patient_id", "quarter_start", *SLOTS), "patient_id")
    return combined(events, ("patient_id", "quarter_start"))


def roll_up(quarters: DataFrame) -> DataFrame:
    """Slots per patient; at most one row per quarter and patient goes in."""
    return combined(quarters.select("patient_id", *SLOTS), ("patient_id",))


def _columns(o: Ordering) -> list[str]:
    """Read-model columns that come straight from slots."""
    return [
        f"{o.time('pregnant')} AS patient_pregnant_date",
        "reason.v.coded AS _reason_coded",
        "reason.v.name_id AS _reason_name_id",
        f"{o.time('tb')} AS current_episode_of_tb",
        f"{o.time('tb_two_years')} AS tb_within_the_last_2_years",
        f"{o.time('kaposi')} AS karposis_sarcoma",
        "death.v AS death_date",
        "expiry.v AS expiry_date_for_last_arvs",
        f"{o.time('stopped')} AS arv_drugs_stopped",
        "state.v AS _state",
        f"{o.time('state')} AS latest_state_date",
        "regimen.v AS latest_regimen",
        f"{o.time('regimen')} AS latest_regimen_date",
        f"{o.time('side_effects')} AS latest_side_effects",
        f"{o.time('last_visit')} AS last_visit_date",
        "CAST(round(missed.v) AS BIGINT) AS missed_drugs_count",
        f"{o.time('missed')} AS last_missed_drugs_date",
        "tb_status.v AS _tb_status",
        f"{o.time('tb_status')} AS tb_status_date",
        f"{o.time('not_on_art')} AS patient_did_not_take_arvs_in_last_two_months",
    ]


DETAIL_COLUMNS = (
    "patient_pregnant_date", "reason_for_art_eligibility", "current_episode_of_tb",
    "tb_within_the_last_2_years", "karposis_sarcoma", "death_date", "expiry_date_for_last_arvs",
    "arv_drugs_stopped", "latest_state", "latest_state_date", "latest_regimen", "latest_regimen_date",
    "latest_side_effects", "last_visit_date", "missed_drugs_count", "last_missed_drugs_date",
    "tb_status", "tb_status_date", "patient_did_not_take_arvs_in_last_two_months",
)


def _with_names(df: DataFrame, words: Dictionary) -> DataFrame:
    """Spells out coded values after the fold, when few rows are left."""
    states = words.states(STATE_ROLES, PROGRAM).select(F.col("state").alias("_state"), F.col("state_name").alias("latest_state"))
    df = coded_name(df, words, "_reason_coded", "_reason_name_id", "reason_for_art_eligibility")
    df = coded_name(df, words, "_tb_status", None, "tb_status")
    # a pregnancy is recorded only for a patient with a treatment start
    on_art = F.when(F.col("art_start_date").isNotNull(), F.col("patient_pregnant_date"))
    return df.join(states, "_state", "left").withColumn("patient_pregnant_date", on_art)


@dataclass
class ReadModel:
    """``report`` has one row per patient, ``details`` one per patient and quarter."""

    report: DataFrame
    details: DataFrame


def _registered(tables) -> DataFrame:
    """Patients on record with their demographics."""
    demographics = tables["person"].selectExpr("person_id AS patient_id", "birthdate AS birth_date", "gender")
    return tables["patient"].select("patient_id").join(demographics, "patient_id", "left")


def _with_starts(df: DataFrame, ordering: Ordering, as_of: str) -> DataFrame:
    """Treatment start from the slots ``transfer_in`` and ``first_start``.

    A transfer-in date given at registration takes the place of the first
    treatment state. Age is in years of 365 days: at the given start for a
    transfer-in, at ``as_of`` otherwise.
    """
    first, moved = ordering.time("first_start"), "transfer_in IS NOT NULL"
    aged_on = f"CASE WHEN {moved} THEN transfer_in.v WHEN {first} IS NOT NULL THEN DATE'{as_of}' END"
    return df.withColumns({
        "art_start_date": F.expr(f"coalesce(transfer_in.v, to_date({first}))"),
        "registration_date": F.expr(f"CASE WHEN {moved} THEN {ordering.time('transfer_in')} ELSE {first} END"),
        "age_initiation": F.expr(f"CAST(datediff({aged_on}, birth_date) AS DOUBLE) / 365D"),
    })


def from_quarters(
    quarters: DataFrame, tables, words: Dictionary, as_of: str, ordering: Ordering = Ordering()
) -> ReadModel:
    """Finishes folded quarters into the two read-model tables."""
    registered = _registered(tables)
    return ReadModel(
        _report(quarters, registered, words, as_of, ordering),
        _details(placed(quarters, tables), words, as_of, ordering),
    )


def from_placed(
    quarters: DataFrame, tables, words: Dictionary, as_of: str, ordering: Ordering = Ordering()
) -> ReadModel:
    """As ``from_quarters``, from stored quarters that have the starts of their patients; details go row by row."""
    return ReadModel(
        _report(quarters, _registered(tables), words, as_of, ordering), _details(quarters, words, as_of, ordering))


def _report(quarters: DataFrame, registered: DataFrame, words: Dictionary, as_of: str, ordering: Ordering) -> DataFrame:
    patients = _with_starts(registered.join(roll_up(quarters), "patient_id", "left"), ordering, as_of)
    return _with_names(
        patients.selectExpr("patient_id", *START_COLUMNS, "birth_date", "gender", *_columns(ordering)), words
    ).select("patient_id", *START_COLUMNS, "birth_date", "gender", *DETAIL_COLUMNS)


def placed(quarters: DataFrame, tables) -> DataFrame:
    """Quarters with the start of their patient, if on record, and the birth date.

    The start of a patient goes to all of the patient's quarters, one row each.
    """
    of_patient = Window.partitionBy("patient_id")
    spread = quarters.withColumns({
        "first_start": F.min("first_start").over(of_patient),
        "transfer_in": F.max("transfer_in").over(of_patient),
    })
    on_record = _registered(tables).select("patient_id", "birth_date").withColumn("on_record", F.lit(True))
    return spread.join(on_record, "patient_id", "left").withColumns({
        c: F.expr(f"CASE WHEN on_record THEN {c} END") for c in ("first_start", "transfer_in")
    }).drop("on_record")


def _details(quarters: DataFrame, words: Dictionary, as_of: str, ordering: Ordering) -> DataFrame:
    return _with_names(
        _with_starts(quarters, ordering, as_of).selectExpr(
            "patient_id", "quarter_start", *START_COLUMNS, *_columns(ordering)
        ),
        words,
    ).select("patient_id", "quarter_start", *START_COLUMNS, *DETAIL_COLUMNS)


def build(tables, as_of: str, ordering: Ordering = Ordering()) -> ReadModel:
    """Both tables from the clinical tables in one plan each."""
    events = ClinicalEvents(tables, ordering)
    return from_quarters(fold(events.all()), tables, events.words, as_of, ordering)


def write(spark, tables, as_of: str, path: str, ordering: Ordering = Ordering()) -> None:
    """Derives the read model into ``path``.

    The folded quarters are written first, each with the start of its patient; both tables are finished from them, so the
    clinical tables are read once, and details go from file to file.
    """
    events, at = ClinicalEvents(tables, ordering), f"{path}/quarters"
    placed(fold(events.all()), tables).write.mode("overwrite").parquet(at)
    model = from_placed(spark.read.parquet(at), tables, events.words, as_of, ordering)
    model.report.write.mode("overwrite").parquet(f"{path}/report")
    model.details.write.mode("overwrite").parquet(f"{path}/details")


def read(spark, path: str) -> ReadModel:
    return ReadModel(spark.read.parquet(f"{path}/report"), spark.read.parquet(f"{path}/details"))
