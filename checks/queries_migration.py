"""Registered queries of the migration steps, selections and sinks."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks.sql_readmodel import AS_OF
from quarterfold.fixtures import Renamed, fixtures_of
from quarterfold.operators.mapping import KeyMaps, remap_actor
from quarterfold.plans import migration as m
from quarterfold.sources.maps import load_map
from quarterfold.sources.select import extract_person_closure, list_reference_tables, page_patients
from quarterfold.sources.scratch import fresh_path
from quarterfold.sources.sinks import append, appended, export_tables, split_valid, upsert, without_rejected
from quarterfold.sources.tables import Source, copy_tables, read_copied


class Run:
    """Source, target dimensions and key maps over one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, tables=None):
        self.spark, self.fixtures = spark, tables or fixtures_of(spark, sf_dir)
        self.src, self.dst = Renamed(self.fixtures, "src_"), Renamed(self.fixtures, "dst_")
        self._maps: KeyMaps | None = None

    @cached_property
    def persons(self) -> DataFrame:
        return m.users_to_persons(self.src["users"], self.src["patient"])

    @property
    def maps(self) -> KeyMaps:
        if self._maps is None:
            maps = KeyMaps(m.user_map(self.persons), self.fixtures["concept_map"], load_map(self.spark, "drug"))
            self._maps = maps.stored(self.spark)
        return self._maps

    def rejected(self) -> tuple[DataFrame, DataFrame]:
        """Patients split by the rules of a run."""
        people = self.src["patient"].withColumn("by", F.col("creator"))
        return split_valid(remap_actor(people, ("by",), self.maps), {
            "birthdate missing": F.col("birthdate").isNull(),
            "gender missing": F.col("gender").isNull(),
            "died before birth": F.col("death_date") < F.col("birthdate"),
            "creator unknown": F.col("by").isNull(),
        })


def _closure(r: Run) -> DataFrame:
    keys = {
        "person": "person_id", "patient": "patient_id", "patient_program": "patient_program_id",
        "patient_state": "patient_state_id", "encounter": "encounter_id", "obs": "obs_id", "orders": "order_id",
        "drug_order": "order_id", "person_address": "person_address_id", "person_attribute": "person_attribute_id",
        "person_name": "person_name_id", "person_name_code": "person_name_code_id", "patient_identifier": "patient_identifier_id",
    }
    found = extract_person_closure({t: r.fixtures[t] for t in keys}, r.fixtures["person"].filter("dead = 1"))
    return reduce(DataFrame.unionAll, (found[t].selectExpr(f"'{t}' AS table_name", f"{k} AS id") for t, k in keys.items()))


def _states_from_obs(r: Run, audit: DataFrame) -> tuple[DataFrame, DataFrame]:
    return m.states_from_obs(m.obs_mapped(r.src, r.dst, r.maps), audit, r.src, r.dst)


def _audit_replay(r: Run) -> DataFrame:
    """The same observations offered again after their audit rows were added: nothing new comes out."""
    audit = r.fixtures["obs_edit_audit"]
    states, done = _states_from_obs(r, audit)
    again, _ = _states_from_obs(r, audit.unionByName(done))
    return states.unionByName(again)


def _quarantine(r: Run) -> DataFrame:
    _, rejects = r.rejected()
    return rejects.select("patient_id", F.array_join("errors", "; ").alias("errors"))


def _upsert(r: Run) -> DataFrame:
    existing = r.fixtures["patient"].join(r.src["patient"].filter("dead = 0").select("patient_id"), "patient_id", "left_semi")
    columns = ("patient_id", "creator", "date_created")
    return upsert(existing.select(*columns), r.src["patient"].select(*columns), "patient_id")


def _upsert_reset(r: Run) -> DataFrame:
    """Existing relationships whose owner is set from the batch."""
    existing = r.src["relationship"].selectExpr("relationship_id", "CAST(-1 AS BIGINT) AS person_a", "relationship")
    batch = r.src["relationship"].join(r.src["person"].selectExpr("person_id", "patient_id AS person_a"), "person_id")
    return upsert(existing, batch.select("relationship_id", "person_a", "relationship"), "relationship_id", reset=("person_a",))


def _append(r: Run) -> DataFrame:
    """Observations in three batches, the second of which is run again."""
    obs, path = r.fixtures["obs"].select("obs_id", "person_id", "concept_id", "value_coded"), fresh_path(r.spark, "appended")
    for number in (0, 1, 1, 2):
        append(obs.filter(F.col("obs_id") % 3 == number), path, number)
    return appended(r.spark, path, obs.schema)


def _maps_from_files(r: Run) -> DataFrame:
    """The concept map from a CSV file and the user map from parquet, as a site brings them."""
    path = fresh_path(r.spark, "maps")
    r.fixtures["concept_map"].write.csv(f"{path}/concept.csv", header=True)
    m.user_map(r.persons).write.parquet(f"{path}/user")
    concepts, users = load_map(r.spark, "concept", f"{path}/concept.csv"), load_map(r.spark, "user", f"{path}/user")
    return users.selectExpr(
        "'user' AS map", "old_user_id AS old_key", "new_user_id AS new_key", "CAST(NULL AS STRING) AS old_name"
    ).unionByName(concepts.selectExpr(
        "'concept' AS map", "old_concept_id AS old_key", "new_concept_id AS new_key", "old_concept_name AS old_name"))


def _reference_tables(r: Run) -> DataFrame:
    """A catalogue over the given tables: those not on the exclusion list, with their rows."""
    at = fresh_path(r.spark, "catalogue")
    database = "catalogue_" + at.rsplit("-", 1)[1]
    r.spark.sql(f"CREATE DATABASE {database} LOCATION '{at}'")
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem"):
        r.spark.sql(f"CREATE TABLE {database}.{name} USING parquet LOCATION '{r.fixtures.sf_dir}/{name}.parquet'")
    counts = [
        r.spark.read.table(f"{database}.{t}").groupBy(F.lit(t).alias("table_name")).agg(F.count("*").alias("n"))
        for t in list_reference_tables(r.spark, database=database)
    ]
    return reduce(DataFrame.unionAll, counts)


def _copied(r: Run) -> DataFrame:
    """Patients of a source that has zero dates for missing ones, copied as a set with the persons."""
    at, target = fresh_path(r.spark, "source"), fresh_path(r.spark, "copied")
    patients = r.fixtures["patient"].select("patient_id", F.col("date_created").cast("date").alias("date_created"))
    zero = F.when(F.col("patient_id") % 10 == 0, "0000-00-00 00:00:00").otherwise(F.col("date_created").cast("string"))
    patients.withColumn("date_created", zero).write.parquet(f"{at}/patient")
    r.fixtures["person"].select("person_id", "gender").write.parquet(f"{at}/person")
    copy_tables(r.spark, Source(path=at), ["patient", "person"], target, {"patient": patients.schema})
    persons = read_copied(r.spark, target, "person").withColumnRenamed("person_id", "patient_id")
    return read_copied(r.spark, target, "patient").join(persons, "patient_id")


def _exported_nulls(r: Run) -> DataFrame:
    """Observations written as text with a mark for missing values, and read back as it stands."""
    path = fresh_path(r.spark, "export")
    obs = r.fixtures["obs"].select("obs_id", "value_coded", "value_numeric", "value_text")
    obs = obs.withColumn("value_numeric", F.col("value_numeric").cast("bigint"))
    export_tables(["obs"], {"obs": obs}.__getitem__, path, "NULL")
    return r.spark.read.csv(f"{path}/obs", header=True, schema="obs_id bigint, value_coded string, value_numeric string, value_text string")


STEPS: dict[str, Callable[[Run], DataFrame]] = {
    "mig_users_to_persons": lambda r: r.persons,
    "mig_user_persons": lambda r: m.repoint_users(r.src["users"], r.persons, r.maps)["person"],
    "mig_user_names": lambda r: m.repoint_users(r.src["users"], r.persons, r.maps)["person_name"],
    "mig_user_rows": lambda r: m.repoint_users(r.src["users"], r.persons, r.maps)["users"],
    "mig_person": lambda r: m.patient_to_person(r.src, r.maps)[0],
    "mig_patient": lambda r: m.patient_to_person(r.src, r.maps)[1],
    "mig_relationships": lambda r: m.relationships(r.src, r.maps),
    "mig_relationships_as_written": lambda r: m.relationships(r.src, r.maps, "as_written"),
    "mig_addresses": lambda r: m.addresses(r.src, r.maps),
    "mig_names": lambda r: m.names(r.src, r.maps),
    "mig_identifiers": lambda r: m.identifiers(r.src, r.dst, r.maps),
    "mig_attributes": lambda r: m.attributes(r.src, r.dst, r.maps),
    "mig_programs": lambda r: m.programs(r.src, r.maps),
    "mig_states_from_orders": lambda r: m.states_from_orders(r.src, r.dst, r.maps),
    "mig_states_from_regimen_orders": lambda r: m.states_from_regimen_orders(r.src, r.dst, r.maps),
    "mig_encounters": lambda r: m.encounters(r.src, r.dst, r.maps),
    "mig_encounters_as_written": lambda r: m.encounters(r.src, r.dst, r.maps, "as_written"),
    "mig_obs": lambda r: m.obs_mapped(r.src, r.dst, r.maps),
    "mig_obs_uninverted": lambda r: m.obs_mapped(r.src, r.dst, r.maps, invert=False),
    "mig_unmapped_concepts": lambda r: m.unmapped_concepts(m.obs_mapped(r.src, r.dst, r.maps)),
    "mig_eligibility_obs": lambda r: m.eligibility_obs(r.src, r.dst, r.maps, AS_OF),
    "mig_regimen_obs": lambda r: m.regimen_obs(r.src, r.dst, r.maps, AS_OF),
    "mig_states_from_obs": lambda r: _states_from_obs(r, r.fixtures["obs_edit_audit"])[0],
    "mig_orders": lambda r: m.orders_mapped(r.src, r.maps),
    "mig_drug_orders": lambda r: m.drug_orders(r.src, r.maps),
    "mig_export_obs": lambda r: m.export_table("obs", r.src, r.dst, r.maps),
    "mig_export_identifiers": lambda r: m.export_table("patient_identifier", r.src, r.dst, r.maps),
    **{
        f"mig_export_{name}": lambda r, table=table: m.export_table(table, r.src, r.dst, r.maps)
        for name, table in (
            ("person", "person"), ("patient", "patient"), ("encounters", "encounter"), ("programs", "patient_program"),
            ("orders", "orders"), ("drug_orders", "drug_order"),
        )
    },
    "mig_export_states_from_orders": lambda r: m.export_table("patient_state_orders", r.src, r.dst, r.maps),
    "mig_export_states": lambda r: m.export_table("patient_state", r.src, r.dst, r.maps),
    "mig_slice": lambda r: page_patients(r.src["patient"], 70, 60, newest_first=True).select("patient_id"),
    "quarantine": _quarantine,
    "quarantine_rest_skipped": lambda r: without_rejected(
        r.src["encounter"].select("encounter_id", "patient_id"), r.rejected()[1]),
    "upsert_keep_existing": _upsert,
    "upsert_reset_owner": _upsert_reset,
    "person_closure": _closure,
    "audit_replay": _audit_replay,
    "key_maps_from_files": _maps_from_files,
    "reference_tables": _reference_tables,
    "append_by_batch": _append,
    "copied_set": _copied,
    "export_null_text": _exported_nulls,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda spark, sf_dir, step=step: step(Run(spark, sf_dir))) for name, step in STEPS.items()}
