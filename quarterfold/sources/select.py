"""Row selection for a migration run."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from quarterfold.operators.numbering import page
from quarterfold.operators.rows import semi

# Tables that hold records of people, so are not copied as reference data.
# The list is kept as it stands: its last entry joins two names and so excludes neither.
NOT_REFERENCE = (
    "person", "person_address", "person_attribute", "person_name", "person_name_code", "patient",
    "patient_identifier", "patient_program", "patient_state", "patient_state_on_arvs", "encounter", "obs", "orders",
    "drug_order", "regimen_observation, relationship",
)
# Tables with the person's id in a column of their own.
DIRECT = {
    "person": "person_id", "person_address": "person_id", "person_attribute": "person_id", "person_name": "person_id",
    "patient": "patient_id", "patient_identifier": "patient_id", "patient_program": "patient_id",
    "encounter": "patient_id", "obs": "person_id",
}
# Tables reached through another table of the closure: (table, shared key).
THROUGH = {
    "person_name_code": ("person_name", "person_name_id"),
    "patient_state": ("patient_program", "patient_program_id"),
    "orders": ("encounter", "encounter_id"),
    "drug_order": ("orders", "order_id"),
}


def page_patients(patients: DataFrame, offset: int, n: int, newest_first: bool = False) -> DataFrame:
    """A page of patients by creation date; equal dates go by id. Patients without a date come first, or last if the newest
    lead. Found by counts of date ranges: no task holds the rows before the page, however far on it is."""
    created = F.col("date_created").desc() if newest_first else F.col("date_created").asc()
    return page(patients, [created, F.col("patient_id")], offset, n)


def list_reference_tables(spark: SparkSession, exclude: Iterable[str] = NOT_REFERENCE, database: str | None = None) -> list[str]:
    """Names of the catalogue's tables that are not on the exclusion list; of a named database without the session's views."""
    left_out = set(exclude)
    found = spark.catalog.listTables(database)
    return sorted(t.name for t in found if t.name not in left_out and not (database and t.isTemporary))


def extract_person_closure(tables: Mapping[str, DataFrame], person_ids: DataFrame) -> dict[str, DataFrame]:
    """The rows of the given persons (``person_id``) in every table of the closure.

    One pass of semi-joins per table; tables not in ``tables`` are skipped.
    """
    out: dict[str, DataFrame] = {}
    for name, key in DIRECT.items():
        if name in tables:
            out[name] = semi(tables[name], person_ids.select(F.col("person_id").alias(key)), key)
    for name, (parent, key) in THROUGH.items():
        if name in tables and parent in out:
            out[name] = semi(tables[name], out[parent].select(key), key)
    return out
