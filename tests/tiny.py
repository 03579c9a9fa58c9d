"""Small hand-made clinical tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarterfold.fixtures import Fixtures

SCHEMAS = {
    "person": "person_id long, gender string, birthdate date, birthdate_estimated short, dead short, "
    "death_date timestamp_ntz, creator long, date_created timestamp_ntz, voided short",
    "patient": "patient_id long, creator long, date_created timestamp_ntz, voided short",
    "encounter": "encounter_id long, patient_id long, encounter_datetime timestamp_ntz, encounter_type long, voided short",
    "patient_program": "patient_program_id long, patient_id long, program_id long, date_enrolled timestamp_ntz, "
    "date_created timestamp_ntz, voided short",
    "patient_state": "patient_state_id long, patient_program_id long, state long, start_date date, voided short, seq long, ver long",
    "obs": "obs_id long, person_id long, concept_id long, encounter_id long, obs_datetime timestamp_ntz, value_coded long, "
    "value_coded_name_id long, value_datetime timestamp_ntz, value_numeric double, value_text string, voided short, "
    "seq long, ver long",
    "drug": "drug_id long, concept_id long, name string",
    "orders": "order_id long, patient_id long, encounter_id long, start_date timestamp_ntz, auto_expire_date timestamp_ntz, "
    "date_created timestamp_ntz",
    "drug_order": "order_id long, drug_inventory_id long, quantity int, equivalent_daily_dose double, seq long, ver long",
}
DIMENSIONS = (
    "concept_name", "concept_set", "encounter_type", "program", "program_workflow", "program_workflow_state",
)
# Concepts and types of the fixture dictionary.
YES, NO, PREGNANT, REGIMEN, STARTED, TB, TB_STATUS, LAST_TAKEN = 1065, 1066, 6131, 2559, 2516, 8206, 7459, 7751
REGISTRATION, CONSULTATION, DISPENSING = 9, 53, 54
ON_ART, DIED, STOPPED, PRE_ART = 7, 3, 6, 1


class Tiny:
    """Rows as dicts; missing columns are NULL. Persons, patients and programmes are made on first mention."""

    def __init__(self, spark: SparkSession, folder: str = "/root/testdata/sf0.001"):
        self.spark, self.rows = spark, {t: [] for t in SCHEMAS}
        self.dims = Fixtures(spark, folder)

    def add(self, table: str, **row) -> "Tiny":
        self.rows[table].append(row)
        return self

    def patient(self, pid: int, birthdate: str | None = "1970-01-01", gender: str | None = "F", **more) -> "Tiny":
        self.add("person", person_id=pid, gender=gender, birthdate=birthdate, dead=0, date_created="1995-01-01 00:00:00", **more)
        self.add("patient", patient_id=pid, date_created="1995-01-01 00:00:00")
        return self.add("patient_program", patient_program_id=pid, patient_id=pid, program_id=1)

    def state(self, sid: int, pid: int, state: int, on: str, **more) -> "Tiny":
        return self.add("patient_state", patient_state_id=sid, patient_program_id=pid, state=state, start_date=on, voided=0, **more)

    def obs(self, oid: int, pid: int, concept: int, at: str, visit_type: int | None = None, **more) -> "Tiny":
        if visit_type:
            self.add("encounter", encounter_id=oid, patient_id=pid, encounter_datetime=at, encounter_type=visit_type, voided=0)
        return self.add("obs", **{"obs_id": oid, "person_id": pid, "concept_id": concept, "encounter_id": oid if visit_type else None,
                                  "obs_datetime": at, "voided": 0, **more})

    def drug(self, oid: int, pid: int, start: str, expires: str | None, quantity: int, dose: float | None, concept: int = 1610) -> "Tiny":
        self.add("drug", drug_id=oid, concept_id=concept, name="d")
        self.add("orders", order_id=oid, patient_id=pid, start_date=start, auto_expire_date=expires)
        return self.add("drug_order", order_id=oid, drug_inventory_id=oid, quantity=quantity, equivalent_daily_dose=dose)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in SCHEMAS:
            return self.dims[name]
        return frame(self.spark, self.rows[name], SCHEMAS[name])


def frame(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A DataFrame from dicts whose dates are given as text."""
    columns = [c.strip().split(" ") for c in schema.split(",")]
    texts = ", ".join(f"{name} {'string' if kind.startswith(('date', 'timestamp')) else kind}" for name, kind in columns)
    raw = spark.createDataFrame([tuple(r.get(name) for name, _ in columns) for r in rows], texts)
    return raw.selectExpr(*[f"CAST({name} AS {kind}) AS {name}" for name, kind in columns])
