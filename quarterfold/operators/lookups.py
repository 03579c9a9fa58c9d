"""Dictionary lookups and key maps.

Tables that names written in the code bound (roles, visit types, states by role) are broadcast. All others are
left to Spark, which broadcasts what its statistics show to be small and splits hot keys of a shuffle join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from quarterfold.functions import ci

def fixed_table(spark: SparkSession, rows: Sequence[Sequence], schema: str) -> DataFrame:
    """A table of fixed values written in the code, small by construction."""
    return F.broadcast(spark.createDataFrame([tuple(r) for r in rows], schema))


def concept_id_by_name(names: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Concept ids carrying one of the wanted names: ``(concept_key, concept_id)``."""
    keys = [w.rstrip().lower() for w in wanted]
    return (
        names.select(ci(F.col("name")).alias("concept_key"), "concept_id")
        .filter(F.col("concept_key").isin(keys))
        .distinct()
    )


def concept_roles(names: DataFrame, roles: Mapping[str, Sequence[str]]) -> DataFrame:
    """One row per concept with a bit for each role its names give it: ``(concept_id, roles)``."""
    def wanted(names_of_role):
        return ", ".join("'" + n.rstrip().lower().replace("'", "\\'") + "'" for n in names_of_role)

    bits = [f"CASE WHEN lower(rtrim(name)) IN ({wanted(n)}) THEN {1 << i} ELSE 0 END" for i, n in enumerate(roles.values())]
    return (
        names.selectExpr("concept_id", f"{' | '.join(bits)} AS bit")
        .filter("bit <> 0")
        .groupBy("concept_id")
        .agg(F.bit_or("bit").alias("roles"))
    )


def preferred_names(names: DataFrame) -> DataFrame:
    """One name per concept, the one with the lowest name id: ``(concept_id, name)``."""
    return names.groupBy("concept_id").agg(F.min_by("name", "concept_name_id").alias("name"))


class Dictionary:
    """The concept dictionary prepared once for the lookups of a job."""

    def __init__(self, tables):
        self._tables = tables

    @cached_property
    def by_concept(self) -> DataFrame:
        return preferred_names(self._tables["concept_name"])

    @cached_property
    def by_name_id(self) -> DataFrame:
        names = self._tables["concept_name"]
        return names.groupBy("concept_name_id").agg(F.min("name").alias("name"))

    def roles(self, wanted: Mapping[str, Sequence[str]]) -> DataFrame:
        return F.broadcast(concept_roles(self._tables["concept_name"], wanted))

    def states(self, roles: Mapping[str, Sequence[str]], program: str) -> DataFrame:
        t = self._tables
        return state_dim(
            t["program_workflow_state"], t["program_workflow"], t["program"], t["concept_name"], roles, program,
        )


def coded_name(df: DataFrame, words: Dictionary, coded: str, coded_name_id: str | None, out: str) -> DataFrame:
    """Name of a coded value: by its name id where given, else by its concept."""
    by_concept = words.by_concept.select(F.col("concept_id").alias(coded), F.col("name").alias("_by_concept"))
    joined = df.join(by_concept, coded, "left")
    if coded_name_id is None:
        return joined.withColumnRenamed("_by_concept", out)
    by_name = words.by_name_id.select(F.col("concept_name_id").alias(coded_name_id), F.col("name").alias("_by_name"))
    picked = F.when(F.col(coded_name_id).isNull(), F.col("_by_concept")).otherwise(F.col("_by_name"))
    return joined.join(by_name, coded_name_id, "left").withColumn(out, picked).drop("_by_concept", "_by_name")


def state_dim(
    program_workflow_state: DataFrame, program_workflow: DataFrame, program: DataFrame, names: DataFrame,
    roles: Mapping[str, Sequence[str]], program_name: str,
) -> DataFrame:
    """Workflow states with their role bits, found by any name of their concept.

    ``(state, state_concept_id, state_name, program_id, in_program, state_roles)``: one row per state. ``state_name`` is
    the preferred name, for printing; ``in_program`` tells whether any name of the state's programme is ``program_name``.
    """
    wanted = concept_id_by_name(names, [program_name]).select("concept_id").distinct().withColumn("in_program", F.lit(True))
    programs = program.join(F.broadcast(wanted), "concept_id", "left").select(
        "program_id", F.coalesce("in_program", F.lit(False)).alias("in_program"))
    found = F.broadcast(concept_roles(names, roles)).withColumnRenamed("roles", "state_roles")
    return (
        program_workflow_state.select("program_workflow_state_id", "program_workflow_id", "concept_id")
        .join(program_workflow.select("program_workflow_id", "program_id"), "program_workflow_id", "left")
        .join(programs, "program_id", "left")
        .join(preferred_names(names), "concept_id", "left")
        .join(found, "concept_id", "left")
        .select(
            F.col("program_workflow_state_id").alias("state"),
            F.col("concept_id").alias("state_concept_id"),
            F.col("name").alias("state_name"),
            "program_id",
            F.coalesce("in_program", F.lit(False)).alias("in_program"),
            F.coalesce("state_roles", F.lit(0)).alias("state_roles"),
        )
    )


def arv_drugs(drug: DataFrame, concept_set: DataFrame, names: DataFrame, set_name: str, fixed: Sequence[int]) -> DataFrame:
    """Drugs whose concept is a member of the named set or one of the fixed concepts: ``(drug_id)``."""
    set_ids = concept_id_by_name(names, [set_name]).select(F.col("concept_id").alias("concept_set"))
    members = concept_set.join(set_ids, "concept_set", "left_semi").select("concept_id")
    named = names.select("concept_id").join(members, "concept_id", "left_semi").distinct()
    flagged = drug.select("drug_id", "concept_id").join(
        named.withColumn("_member", F.lit(True)), "concept_id", "left"
    )
    return flagged.filter(F.col("_member") | F.col("concept_id").isin(list(fixed))).select("drug_id")


def remap(df: DataFrame, column: str, mapping: DataFrame, old: str, new: str, out: str | None = None) -> DataFrame:
    """Replaces a key by its mapped value; a key without a mapping becomes NULL.

    ``mapping`` must hold one row per ``old`` value.
    """
    side = mapping.select(F.col(old).alias("_old"), F.col(new).alias("_new"))
    joined = df.join(side, df[column] == F.col("_old"), "left").drop("_old")
    out = out or column
    return joined.withColumn(out, F.col("_new")).drop("_new")


def remap_by_name(
    df: DataFrame, column: str, src: DataFrame, src_id: str, dst: DataFrame, dst_id: str, out: str
) -> DataFrame:
    """Maps a source type to the target type of the same name; no such name gives NULL."""
    by_name = dst.groupBy(ci(F.col("name")).alias("_key")).agg(F.min(dst_id).alias("_new"))
    pairs = src.select(F.col(src_id).alias("_old"), ci(F.col("name")).alias("_key")).join(by_name, "_key", "left")
    return remap(df, column, pairs.select("_old", "_new"), "_old", "_new", out)


def daily_dose(df: DataFrame, totals: DataFrame) -> DataFrame:
    """Adds ``daily_consumption`` by patient, drug and prescription day."""
    keys = ["patient_id", "drug_id", "prescription_date"]
    return df.join(totals.groupBy(*keys).agg(F.max("daily_consumption").alias("daily_consumption")), keys, "left")
