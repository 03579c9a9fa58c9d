"""Record migration: one set-based plan per target table.

``src`` maps source table names, ``dst`` target dimension names to DataFrames;
``maps`` are the key maps. No step loops over patients; the order of tables is
the order in which the functions are called.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from quarterfold.functions import ci, row_uuid
from quarterfold.operators import rules
from quarterfold.operators.lookups import (
    Dictionary, concept_id_by_name, daily_dose, remap_by_name,
)
from quarterfold.operators.mapping import KeyMaps, MappingSpec, apply_mapping, left_lookup, recode, remap_actor, remap_columns
from quarterfold.operators.rows import any_per, latest_per, not_processed, semi, sequential_ids
from quarterfold.plans.events import PROGRAM, STATE_ROLES, is_state

# Relationship types, source to target; all others become 13.
RELATIONSHIP_TYPES = ((1, 7), (2, 3), (4, 3), (6, 3), (7, 11), (8, 2), (9, 12))
# The same as the statement was written: its list of three is read as one truth value.
RELATIONSHIP_TYPES_AS_WRITTEN = ((1, 7), (7, 11), (8, 2), (9, 12))
OTHER_RELATIONSHIP = 13
# Visit type names, source to target.
VISIT_TYPES = (
    ("hiv first visit", "HIV CLINIC REGISTRATION"),
    ("art visit", "HIV CLINIC CONSULTATION"),
    ("give drugs", "DISPENSING"),
    ("date of art initiation", "ART ENROLLMENT"),
    ("height/weight", "VITALS"),
    ("general reception", "REGISTRATION"),
    ("barcode scan", "REGISTRATION"),
    ("tb reception", "TB CLINIC VISIT"),
    ("reffered", "IS PATIENT REFERRED?"),
)
# As written, every type not matched before the pair of receptions ends up as a registration.
VISIT_TYPES_AS_WRITTEN = VISIT_TYPES[:5]
OTHER_VISIT_AS_WRITTEN = "REGISTRATION"
# Identifier types that become person attributes.
CONTACT_TYPES = (
    "Occupation", "Cell phone number", "Physical address", "Traditional authority", "Home phone number",
    "Office phone number",
)
# Symptoms and answers of the side-effect inversion.
SYMPTOMS = (
    "Peripheral neuropathy", "Leg pain / numbness", "Hepatitis", "Jaundice", "Skin rash", "Lipodystrophy",
    "Lactic acidosis", "Anaemia", "Other symptom", "Other side effect",
)
YES_ANSWERS = ("Yes", "Yes drug induced", "Yes not drug induced", "Yes unknown cause")
# Names and concepts looked up on the way.
DISPENSING_VISIT = "Give Drugs"
DRUG_INDUCED = "DRUG INDUCED"
REGIMEN_CATEGORY = "Regimen category"
ELIGIBILITY = "Reason for ART eligibility"
TREATMENT_STATUS = "Antiretroviral treatment status"
SOURCE_STATUS_CONCEPT = 28
REGIMEN_DRUG_CONCEPTS = (450, 451, 452, 458, 826, 827, 828, 829, 453)
EXPORT_CONTACT_TYPE_IDS = (2, 3, 5, 6, 8, 9, 11, 12)

# Columns of the target tables.
_VOIDING = ("voided", "voided_by", "date_voided", "void_reason")
_CHANGING = ("changed_by", "date_changed")
OBS_BEFORE = (
    "encounter_id", "order_id", "obs_datetime", "location_id", "obs_group_id", "accession_number", "value_group_id", "value_boolean",
)
OBS_AFTER = (
    "value_drug", "value_datetime", "value_numeric", "value_modifier", "value_text", "date_started", "date_stopped", "comments",
    "creator", "date_created", *_VOIDING,
)
ORDER_END = ("discontinued", "discontinued_date", "discontinued_by", "discontinued_reason")
# Source columns that tell identifiers apart, with a number within equal ones.
IDENTIFIER_KEY = ("patient_id", "identifier_type", "identifier", "nth")
PERSON = MappingSpec(
    "person", "patient",
    ("person_id = patient_id", "gender", "birthdate", "birthdate_estimated", "dead", "death_date", "cause_of_death",
     "creator", "date_created", *_CHANGING, *_VOIDING),
    key=("patient_id",), actors=("creator", "changed_by", "voided_by"),
)
PATIENT = MappingSpec(
    "patient", "patient",
    ("patient_id", "tribe", "creator", "date_created", *_CHANGING, *_VOIDING),
    key=("patient_id",), actors=("creator", "changed_by", "voided_by"),
)
ADDRESS = MappingSpec(
    "person_address", "patient_address",
    ("person_address_id = patient_address_id", "person_id = patient_id", "preferred", "address1", "address2",
     "city_village", "state_province", "postal_code", "country", "latitude", "longitude", "creator", "date_created",
     *_VOIDING, "county_district = CAST(NULL AS STRING)", "neighborhood_cell = CAST(NULL AS STRING)",
     "region = CAST(NULL AS STRING)", "subregion = CAST(NULL AS STRING)", "township_division = CAST(NULL AS STRING)"),
    key=("patient_address_id",), actors=("creator", "voided_by"),
)
NAME = MappingSpec(
    "person_name", "patient_name",
    ("preferred", "person_id = patient_id", "prefix", "given_name", "middle_name", "family_name_prefix",
     "family_name", "family_name2", "family_name_suffix", "degree", "creator", "date_created", *_VOIDING, *_CHANGING),
    key=("patient_name_id",), actors=("creator", "voided_by", "changed_by"),
)
PROGRAM_ENROLMENT = MappingSpec(
    "patient_program", "patient_program",
    ("patient_program_id", "patient_id", "program_id", "date_enrolled", "date_completed", "creator", "date_created",
     *_CHANGING, *_VOIDING, "location_id = CAST(NULL AS BIGINT)"),
    key=("patient_program_id",), actors=("creator", "changed_by", "voided_by"),
)


# ---- users --------------------------------------------------------------------

def users_to_persons(users: DataFrame, patients: DataFrame) -> DataFrame:
    """A person for every user, numbered on from the last patient: ``(user_id, person_id, ...)``."""
    first = (patients.agg(F.max("patient_id")).first()[0] or 0) + 1
    return sequential_ids(users, "user_id", first, "person_id").selectExpr(
        "user_id", "person_id", "creator", "date_created", *_CHANGING, *_VOIDING,
    )


def user_map(persons: DataFrame) -> DataFrame:
    """Old user to new user; new users carry the id of their person."""
    return persons.selectExpr("user_id AS old_user_id", "person_id AS new_user_id")


def repoint_users(users: DataFrame, persons: DataFrame, maps: KeyMaps) -> dict[str, DataFrame]:
    """Person, name and user rows of the users, with their actors mapped."""
    actors = ("creator", "changed_by", "voided_by")
    pointed = remap_actor(persons, actors, maps)
    own = users.select(
        "user_id", "username", "password", "salt", "secret_question", "secret_answer", "first_name", "middle_name", "last_name"
    ).join(pointed, "user_id")
    return {
        "person": pointed.drop("user_id").withColumn("uuid", row_uuid("person", F.col("person_id"))),
        "person_name": own.selectExpr(
            "person_id", "first_name AS given_name", "middle_name", "last_name AS family_name", "creator",
            "date_created", *_VOIDING, *_CHANGING,
        ).withColumn("uuid", row_uuid("person_name", F.col("person_id"))),
        "users": own.selectExpr(
            "person_id AS user_id", "username", "password", "salt", "secret_question", "secret_answer", "creator",
            "date_created", *_CHANGING, "person_id",
        ).withColumn("uuid", row_uuid("users", F.col("user_id"))),
    }


# ---- people -------------------------------------------------------------------

def patient_to_person(src, maps: KeyMaps) -> tuple[DataFrame, DataFrame]:
    return apply_mapping(PERSON, src, maps), apply_mapping(PATIENT, src, maps)


def relationships(src, maps: KeyMaps, compat: str = "intended") -> DataFrame:
    """Relationships with both people as patient ids and the type recoded."""
    types = RELATIONSHIP_TYPES_AS_WRITTEN if compat == "as_written" else RELATIONSHIP_TYPES
    owner = src["person"].selectExpr("person_id", "patient_id AS person_a")
    relative = src["person"].selectExpr("person_id AS relative_id", "patient_id AS person_b")
    rows = src["relationship"].join(owner, "person_id").join(relative, "relative_id", "left")
    rows = recode(rows.withColumnRenamed("relationship", "_type"), "_type", types, "relationship", OTHER_RELATIONSHIP)
    rows = rows.selectExpr("relationship_id", "person_a", "relationship", "person_b", "creator", "date_created", *_VOIDING)
    return remap_actor(rows, ("creator", "voided_by"), maps).withColumn(
        "uuid", row_uuid("relationship", F.col("relationship_id"))
    )


def addresses(src, maps: KeyMaps) -> DataFrame:
    return apply_mapping(ADDRESS, src, maps)


def names(src, maps: KeyMaps) -> DataFrame:
    return apply_mapping(NAME, src, maps)


def _told_apart(identifiers: DataFrame) -> DataFrame:
    """Adds ``nth``: a number within rows of one patient, type and text, which have no key of their own. All other columns
    order them, so rows that swap numbers between runs are alike in full."""
    same = Window.partitionBy("patient_id", "identifier_type", "identifier").orderBy("date_created", "creator", "location_id", "preferred", *_VOIDING)
    return identifiers.withColumn("nth", F.row_number().over(same))


def _by_contact(src, contact: bool) -> DataFrame:
    contacts = src["identifier_type"].filter(ci(F.col("name")).isin([c.lower() for c in CONTACT_TYPES]))
    contacts = F.broadcast(contacts.selectExpr("patient_identifier_type_id AS identifier_type"))
    return _told_apart(src["patient_identifier"]).withColumn("_uuid", row_uuid(
        "person_attribute" if contact else "patient_identifier", *map(F.col, IDENTIFIER_KEY))).join(contacts, "identifier_type", "left_semi" if contact else "left_anti")


def identifiers(src, dst, maps: KeyMaps) -> DataFrame:
    """Identifiers that are not contact details, typed by the target type of the same name."""
    rows = remap_by_name(
        _by_contact(src, False), "identifier_type", src["identifier_type"], "patient_identifier_type_id",
        dst["identifier_type"], "patient_identifier_type_id", "target_type",
    ).selectExpr(
        "patient_id", "identifier", "target_type AS identifier_type", "preferred", "location_id", "creator",
        "date_created", *_VOIDING, "_uuid AS uuid",
    )
    return remap_actor(rows, ("creator", "voided_by"), maps)


def attributes(src, dst, maps: KeyMaps) -> DataFrame:
    """Contact details as person attributes."""
    rows = remap_by_name(
        _by_contact(src, True), "identifier_type", src["identifier_type"], "patient_identifier_type_id",
        dst["attribute_type"], "person_attribute_type_id", "person_attribute_type_id",
    ).selectExpr(
        "patient_id AS person_id", "identifier AS value", "person_attribute_type_id", "creator", "date_created", *_VOIDING,
        "_uuid AS uuid",
    )
    return remap_actor(rows, ("creator", "voided_by"), maps)


# ---- programmes and states ------------------------------------------------------

def programs(src, maps: KeyMaps) -> DataFrame:
    return apply_mapping(PROGRAM_ENROLMENT, src, maps)


def latest_program(src, people: DataFrame | None = None) -> DataFrame:
    """The enrolment created last, per patient (of ``people`` alone, if given): ``(patient_id, patient_program_id)``."""
    enrolled = src["patient_program"].select("patient_id", "date_created", "patient_program_id")
    if people is not None:
        enrolled = semi(enrolled, people.toDF("patient_id"), "patient_id")
    return latest_per(enrolled, "patient_id", ["date_created", "patient_program_id"]).drop("date_created")


def _program_states(dst) -> DataFrame:
    return Dictionary(dst).states(STATE_ROLES, PROGRAM).filter("in_program")


def _started_state(dst):
    return _program_states(dst).filter(is_state("started")).agg(F.min("state")).scalar()


def _state_of_concept(dst) -> DataFrame:
    """One state per concept, the lowest, should several workflows of the programme have it: ``(value_coded, state)``."""
    return _program_states(dst).groupBy(F.col("state_concept_id").alias("value_coded")).agg(F.min("state").alias("state"))


def dispensed_orders(src) -> DataFrame:
    """Orders of the one dispensing visit of each enrolled patient (the one with the lowest id)."""
    visits = src["encounter"].join(
        F.broadcast(
            src["encounter_type"].filter(ci(F.col("name")) == DISPENSING_VISIT.lower())
            .selectExpr("encounter_type_id AS encounter_type")
        ),
        "encounter_type", "left_semi",
    ).select("patient_id", "encounter_id", "creator")
    visit = any_per(semi(visits, src["patient_program"].select("patient_id"), "patient_id"), "patient_id", "encounter_id")
    return src["orders"].select("order_id", "encounter_id", "date_created").join(visit, "encounter_id")


def states_from_orders(src, dst, maps: KeyMaps) -> DataFrame:
    """An "on treatment" state for each dispensed order, on the day of the order."""
    rows = dispensed_orders(src).join(latest_program(src), "patient_id", "left")
    rows = remap_actor(rows, ("creator",), maps).withColumn("state", _started_state(dst))
    return rows.selectExpr(
        "patient_program_id", "state", "to_date(date_created) AS start_date", "creator", "date_created", "order_id"
    ).withColumn("uuid", row_uuid("patient_state", F.col("order_id"))).drop("order_id")


def states_from_regimen_orders(src, dst, maps: KeyMaps) -> DataFrame:
    """The export's variant: a state for every order of a drug with a regimen concept."""
    drugs = src["drug"].filter(F.col("concept_id").isin(list(REGIMEN_DRUG_CONCEPTS))).selectExpr(
        "drug_id AS drug_inventory_id"
    )
    given = src["drug_order"].join(drugs, "drug_inventory_id", "left_semi").select("order_id")
    rows = (
        src["orders"].select("order_id", "encounter_id", "date_created", "creator")
        .join(given, "order_id", "left_semi")
        .join(src["encounter"].select("encounter_id", "patient_id"), "encounter_id")
        .join(latest_program(src), "patient_id", "left")
    )
    rows = remap_actor(rows, ("creator",), maps, "keep").withColumn("state", _started_state(dst))
    return rows.selectExpr(
        "patient_program_id", "state", "to_date(date_created) AS start_date", "creator", "date_created", "order_id"
    )


def status_obs(obs: DataFrame, dst) -> DataFrame:
    """Treatment-status observations, one row each: ``(obs_id, person_id, value_coded, obs_datetime, creator)``."""
    wanted = F.broadcast(concept_id_by_name(dst["concept_name"], [TREATMENT_STATUS]).select("concept_id"))
    status = semi(obs, wanted, "concept_id").select("obs_id", "person_id", "value_coded", "obs_datetime", "creator")
    return any_per(status, "obs_id", "obs_datetime")


def states_of_status(status: DataFrame, enrolled: DataFrame, dst) -> tuple[DataFrame, DataFrame]:
    """States of treatment-status observations in the patients' programmes ``enrolled``, and their audit rows."""
    rows = (
        status.join(_state_of_concept(dst), "value_coded", "left")
        .join(enrolled.withColumnRenamed("patient_id", "person_id"), "person_id", "left")
        .selectExpr(
            "obs_id", "patient_program_id", "state", "to_date(obs_datetime) AS start_date", "creator",
            "obs_datetime AS date_created",
        )
    )
    states = rows.withColumn("uuid", row_uuid("patient_state_obs", F.col("obs_id"))).drop("obs_id")
    return states, status.select("obs_id")  # the joins find one row at most


def states_from_obs(obs: DataFrame, audit: DataFrame, src, dst) -> tuple[DataFrame, DataFrame]:
    """States from treatment-status observations not yet in the audit table, and their audit rows.

    ``obs`` are target observations. Each observation counts once, however
    often it is offered.
    """
    fresh = not_processed(status_obs(obs, dst), audit, "obs_id")
    return states_of_status(fresh, latest_program(src), dst)


# ---- visits and observations ------------------------------------------------------

def _visit_types(src, dst, compat: str) -> DataFrame:
    """Source visit type to target visit type."""
    pairs = VISIT_TYPES_AS_WRITTEN if compat == "as_written" else VISIT_TYPES
    types = recode(
        src["encounter_type"].selectExpr("encounter_type_id AS encounter_type", "lower(rtrim(name)) AS _name"),
        "_name", pairs, "_target", OTHER_VISIT_AS_WRITTEN if compat == "as_written" else None,
    )
    targets = dst["encounter_type"].groupBy(ci(F.col("name")).alias("_key")).agg(
        F.min("encounter_type_id").alias("target_type")
    )
    types = types.withColumn("_key", ci(F.col("_target"))).join(targets, "_key", "left")
    return types.select("encounter_type", "target_type")


def encounters(src, dst, maps: KeyMaps, compat: str = "intended") -> DataFrame:
    """Visits with their type recoded by name; a type without a target becomes NULL."""
    rows = src["encounter"].join(_visit_types(src, dst, compat), "encounter_type", "left").selectExpr(
        "encounter_id", "target_type AS encounter_type", "patient_id", "provider_id", "location_id", "form_id",
        "encounter_datetime", "creator", "date_created",
    )
    return remap_actor(rows, ("provider_id", "creator"), maps).withColumn(
        "uuid", row_uuid("encounter", F.col("encounter_id"))
    )


def obs_mapped(src, dst, maps: KeyMaps, invert: bool = True) -> DataFrame:
    """Observations with question and coded answer mapped.

    With ``invert`` a confirmed symptom is turned round: the question becomes
    "drug induced" and the answer the symptom itself, as the source knows it.
    """
    listed = ", ".join("'" + s.lower() + "'" for s in SYMPTOMS)
    yes = ", ".join("'" + s.lower() + "'" for s in YES_ANSWERS)
    old = maps.concept_names.groupBy("old_concept_id").agg(
        F.min("new_concept_id").alias("new_id"),
        F.bool_or(F.expr(f"lower(rtrim(old_concept_name)) IN ({listed})")).alias("symptom"),
        F.bool_or(F.expr(f"lower(rtrim(old_concept_name)) IN ({yes})")).alias("confirmed"),
    )
    asked = old.selectExpr("old_concept_id AS concept_id", "new_id AS asked_id", "symptom")
    told = old.selectExpr("old_concept_id AS value_coded", "new_id AS told_id", "confirmed")
    induced = concept_id_by_name(dst["concept_name"], [DRUG_INDUCED]).agg(F.min("concept_id")).scalar()
    turned = "coalesce(symptom AND confirmed, FALSE)" if invert else "FALSE"
    rows = (
        left_lookup(left_lookup(src["obs"], asked, "concept_id"), told, "value_coded")
        .withColumn("induced_id", induced)
        .selectExpr(
            "obs_id", "patient_id AS person_id", f"CASE WHEN {turned} THEN induced_id ELSE asked_id END AS concept_id",
            *OBS_BEFORE, f"CASE WHEN {turned} THEN concept_id ELSE told_id END AS value_coded", *OBS_AFTER,
        )
    )
    return remap_actor(rows, ("creator", "voided_by"), maps).withColumn("uuid", row_uuid("obs", F.col("obs_id")))


def unmapped_concepts(obs: DataFrame) -> DataFrame:
    """How many observations have a question without a target (mapped to 0) or without a map entry."""
    return obs.groupBy(
        F.expr("CASE WHEN concept_id IS NULL THEN 'not in the map' WHEN concept_id = 0 THEN 'no target' ELSE 'mapped' END")
        .alias("outcome")
    ).agg(F.count(F.lit(1)).alias("observations"))


def eligibility_obs(src, dst, maps: KeyMaps, as_of: str, compat: str = "intended") -> DataFrame:
    """The derived reason for treatment at the staging visit, for patients beyond stage 1."""
    reasons = rules.eligibility_cases(src, as_of, compat).filter("reason_concept_id IS NOT NULL AND stage_today > 1")
    staging = F.broadcast(
        src["encounter_type"].filter(ci(F.col("name")) == rules.STAGING.lower()).selectExpr("encounter_type_id AS encounter_type")
    )
    visit = src["encounter"].join(staging, "encounter_type", "left_semi").select(
        "patient_id", "encounter_id", "encounter_datetime", "location_id", "creator", "date_created"
    )
    asked = concept_id_by_name(dst["concept_name"], [ELIGIBILITY]).agg(F.min("concept_id")).scalar()
    rows = (
        any_per(visit, "patient_id", "encounter_id")
        .join(reasons, "patient_id")
        .withColumn("concept_id", asked)
        .selectExpr(
            "patient_id AS person_id", "concept_id", "encounter_id", "encounter_datetime AS obs_datetime", "location_id",
            "reason_concept_id AS value_coded", "creator", "date_created",
        )
    )
    rows = remap_columns(rows, ("value_coded",), maps.concepts)
    return remap_actor(rows, ("creator",), maps).withColumn("uuid", row_uuid("obs_reason", F.col("person_id")))


def regimen_obs(src, dst, maps: KeyMaps, as_of: str) -> DataFrame:
    """The derived regimen category of each dispensed order."""
    drugs = src["drug"].selectExpr("drug_id AS drug_inventory_id", "concept_id AS regimen")
    given = src["drug_order"].select("order_id", "drug_inventory_id").join(drugs, "drug_inventory_id", "left")
    rows = dispensed_orders(src).join(given.select("order_id", "regimen"), "order_id", "left")
    rows = rules.regimen_category(rows, src["patient"], "regimen", "date_created", as_of, "value_text")
    asked = concept_id_by_name(dst["concept_name"], [REGIMEN_CATEGORY]).agg(F.min("concept_id")).scalar()
    rows = remap_actor(rows, ("creator",), maps).withColumn("concept_id", asked)
    return rows.selectExpr(
        "patient_id AS person_id", "concept_id", "encounter_id", "date_created AS obs_datetime", "value_text", "creator",
        "date_created", "order_id",
    ).withColumn("uuid", row_uuid("obs_regimen", F.col("order_id"))).drop("order_id")


# ---- orders -------------------------------------------------------------------------

def _dosed(src) -> DataFrame:
    """Drug orders with patient and daily dose of the visit day."""
    visits = src["encounter"].selectExpr("encounter_id", "patient_id", "to_date(encounter_datetime) AS prescription_date")
    placed = src["orders"].select("order_id", "encounter_id").join(visits, "encounter_id")
    drugs = src["drug_order"].withColumn("drug_id", F.col("drug_inventory_id"))
    return daily_dose(drugs.join(placed, "order_id"), src["prescription_totals"])


def orders_mapped(src, maps: KeyMaps) -> DataFrame:
    """Orders with a start (default: creation) and an expiry (default: start plus quantity over daily dose)."""
    supply = _dosed(src).select("order_id", "quantity", "daily_consumption")
    owner = src["encounter"].select("encounter_id", "patient_id")
    start = "coalesce(start_date, date_created)"
    days = "CAST(round(try_divide(CAST(quantity AS DOUBLE), coalesce(daily_consumption, 1D))) AS INT)"
    rows = src["orders"].join(owner, "encounter_id").join(supply, "order_id", "left").selectExpr(
        "order_id", "order_type_id", "concept_id", "orderer", "encounter_id", "instructions", f"{start} AS start_date",
        f"coalesce(auto_expire_date, {start} + make_dt_interval({days})) AS auto_expire_date", *ORDER_END, "creator",
        "date_created", *_VOIDING, "patient_id",
    )
    return remap_actor(rows, ("orderer", "discontinued_by", "creator", "voided_by"), maps).withColumn("uuid", row_uuid("orders", F.col("order_id")))


def drug_orders(src, maps: KeyMaps) -> DataFrame:
    """Drug orders with the target drug and the daily dose."""
    rows = _dosed(src).selectExpr(
        "order_id", "drug_inventory_id", "dose", "daily_consumption AS equivalent_daily_dose", "units", "frequency",
        "prn", "complex", "quantity",
    )
    return remap_columns(rows, ("drug_inventory_id",), maps.drugs)


# ---- export -------------------------------------------------------------------------

EXPORT_ORDER = (
    "person", "patient", "patient_identifier", "encounter", "patient_program", "obs", "patient_state",
    "patient_state_orders", "orders", "drug_order",
)
_EXPORT = {
    "person": PERSON,
    "patient": PATIENT,
    "patient_program": PROGRAM_ENROLMENT,
    "patient_identifier": MappingSpec(
        "patient_identifier", "patient_identifier",
        ("patient_id", "identifier", "identifier_type", "preferred", "location_id", "creator", "date_created", *_VOIDING),
        key=IDENTIFIER_KEY, actors=("creator", "voided_by"),
        where=f"identifier_type NOT IN {EXPORT_CONTACT_TYPE_IDS}",
    ),
    "obs": MappingSpec(
        "obs", "obs",
        ("obs_id", "person_id = patient_id", "concept_id", *OBS_BEFORE, "value_coded", *OBS_AFTER),
        key=("obs_id",), actors=("creator", "voided_by"), concepts=("concept_id", "value_coded"),
    ),
    "encounter": MappingSpec(
        "encounter", "encounter",
        ("encounter_id", "encounter_type = coalesce(target_type, encounter_type)", "patient_id", "provider_id", "location_id", "form_id",
         "encounter_datetime", "creator", "date_created", *_VOIDING, *_CHANGING),
        key=("encounter_id",), actors=("creator", "voided_by", "changed_by"),
    ),
    "orders": MappingSpec(
        "orders", "orders",
        ("order_id", "order_type_id", "concept_id", "orderer", "encounter_id", "instructions", "start_date",
         "auto_expire_date", *ORDER_END, "creator", "date_created", *_VOIDING),
        key=("order_id",), actors=("creator", "voided_by"), concepts=("concept_id",),
    ),
    "drug_order": MappingSpec(
        "drug_order", "drug_order",
        ("order_id", "drug_inventory_id", "dose", "units", "frequency", "prn", "complex", "quantity"), key=("order_id",),
    ),
}


def export_table(name: str, src, dst, maps: KeyMaps) -> DataFrame:
    """One table of the table-driven export; keys without a mapping keep their old value."""
    if name == "patient_identifier":
        return apply_mapping(_EXPORT[name], {name: _told_apart(src[name])}, maps, missing="keep")
    if name == "encounter":
        typed = src[name].join(_visit_types(src, dst, "intended"), "encounter_type", "left")
        return apply_mapping(_EXPORT[name], {name: typed}, maps, missing="keep")
    if name in _EXPORT:
        return apply_mapping(_EXPORT[name], src, maps, missing="keep")
    if name == "patient_state":
        known = _state_of_concept(dst)
        rows = src["obs"].filter(F.col("concept_id") == SOURCE_STATUS_CONCEPT)
        rows = remap_columns(rows, ("value_coded",), maps.concepts)
        rows = rows.join(known, "value_coded", "left").join(latest_program(src), "patient_id", "left")
        return remap_actor(rows, ("creator",), maps, "keep").selectExpr(
            "patient_program_id", "state", "to_date(obs_datetime) AS start_date", "creator", "date_created"
        )
    if name == "patient_state_orders":
        return states_from_regimen_orders(src, dst, maps).drop("order_id")
    raise KeyError(f"unknown export table {name!r}; one of {', '.join(EXPORT_ORDER)}")
