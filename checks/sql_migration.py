"""SQL for checking the migration steps."""

from __future__ import annotations

from checks.sql_readmodel import AS_OF, with_tables
from checks.sql_rules import category, of_patient, reason, stage
from quarterfold.sources.maps import DRUG_MAP

_VOID = "t.voided, {voided_by} AS voided_by, t.date_voided, t.void_reason"


def _uuid(table: str, *key: str) -> str:
    h = f"sha256(concat_ws(':', '{table}', {', '.join(f'CAST({k} AS VARCHAR)' for k in key)}))"
    cuts = ", ".join(f"substr({h}, {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
    return f"concat_ws('-', {cuts}) AS uuid"


def _user(column: str) -> str:
    return f"(SELECT m.new_user_id FROM user_map m WHERE m.old_user_id = {column})"


def _concept(column: str) -> str:
    return f"(SELECT min(m.new_concept_id) FROM fx_concept_map m WHERE m.old_concept_id = {column})"


def _target(name: str) -> str:
    return f"(SELECT min(concept_id) FROM fx_concept_name WHERE lower(rtrim(name)) = '{name.lower()}')"


_VOIDED = f"t.voided, {_user('t.voided_by')} AS voided_by, t.date_voided, t.void_reason"
_CHANGED = f"{_user('t.changed_by')} AS changed_by, t.date_changed"
_BY = f"{_user('t.creator')} AS creator, t.date_created"
_OLD_VOIDED = f"t.voided, coalesce({_user('t.voided_by')}, t.voided_by) AS voided_by, t.date_voided, t.void_reason"
_OLD_CHANGED = f"coalesce({_user('t.changed_by')}, t.changed_by) AS changed_by, t.date_changed"
_OLD_BY = f"coalesce({_user('t.creator')}, t.creator) AS creator, t.date_created"
_NTH = "row_number() OVER (PARTITION BY t.patient_id, t.identifier_type, t.identifier ORDER BY t.date_created, t.creator, t.location_id, "
_NTH += "t.preferred, t.voided, t.voided_by, t.date_voided, t.void_reason)"
_IDENTIFIER_KEY = ("t.patient_id", "t.identifier_type", "t.identifier", _NTH)

_DRUG_VALUES = ", ".join(f"({old}, {new})" for old, _, _, new in DRUG_MAP)
PERSONS = ("persons", """
    SELECT u.*, (SELECT max(patient_id) FROM fx_src_patient) + row_number() OVER (ORDER BY user_id) AS person_id FROM fx_src_users u""")
USER_MAP = ("user_map", "SELECT user_id AS old_user_id, person_id AS new_user_id FROM persons")
PROGRAM = ("last_program", """
    SELECT patient_id, patient_program_id FROM (SELECT *, row_number() OVER
      (PARTITION BY patient_id ORDER BY date_created DESC, patient_program_id DESC) AS n FROM fx_src_patient_program) WHERE n = 1""")
STATES = ("states", """
    SELECT w.program_workflow_state_id AS state, w.concept_id,
      w.concept_id IN (SELECT n.concept_id FROM fx_concept_name n WHERE lower(rtrim(n.name)) = 'on antiretrovirals') AS starts
    FROM fx_program_workflow_state w JOIN fx_program_workflow f USING (program_workflow_id)
    JOIN fx_program g ON g.program_id = f.program_id
    WHERE g.concept_id IN (SELECT concept_id FROM fx_concept_name WHERE lower(name) = 'hiv program')""")
DISPENSED = ("dispensed", """
    SELECT o.order_id, o.encounter_id, o.date_created, e.patient_id, e.creator
    FROM fx_src_orders o JOIN fx_src_encounter e USING (encounter_id)
    WHERE o.encounter_id IN (SELECT min(v.encounter_id) FROM fx_src_encounter v JOIN fx_src_encounter_type t
        ON t.encounter_type_id = v.encounter_type AND lower(t.name) = 'give drugs'
        WHERE v.patient_id IN (SELECT patient_id FROM fx_src_patient_program) GROUP BY v.patient_id)""")
_SYMPTOMS = ("'peripheral neuropathy', 'leg pain / numbness', 'hepatitis', 'jaundice', 'skin rash', 'lipodystrophy', "
             "'lactic acidosis', 'anaemia', 'other symptom', 'other side effect'")
_YES = "'yes', 'yes drug induced', 'yes not drug induced', 'yes unknown cause'"
_TURNED = (
    f"(t.concept_id IN (SELECT old_concept_id FROM fx_concept_map WHERE lower(old_concept_name) IN ({_SYMPTOMS})) "
    f"AND coalesce(t.value_coded IN (SELECT old_concept_id FROM fx_concept_map WHERE lower(old_concept_name) IN ({_YES})), FALSE))"
)
_OBS_BEFORE = """t.encounter_id, t.order_id, t.obs_datetime, t.location_id, t.obs_group_id, t.accession_number, t.value_group_id,
      t.value_boolean"""
_OBS_AFTER = """t.value_drug, t.value_datetime, t.value_numeric, t.value_modifier, t.value_text, t.date_started, t.date_stopped, t.comments"""
OBS = ("mapped_obs", f"""
    SELECT t.obs_id, t.patient_id AS person_id,
      CASE WHEN {_TURNED} THEN {_target('drug induced')} ELSE {_concept('t.concept_id')} END AS concept_id,
      {_OBS_BEFORE},
      CASE WHEN {_TURNED} THEN t.concept_id ELSE {_concept('t.value_coded')} END AS value_coded,
      {_OBS_AFTER}, {_BY}, {_VOIDED}, {_uuid('obs', 't.obs_id')}
    FROM fx_src_obs t""")
DOSED = ("dosed", """
    SELECT d.*, x.daily_consumption FROM fx_src_drug_order d JOIN fx_src_orders o USING (order_id)
    JOIN fx_src_encounter e USING (encounter_id)
    LEFT JOIN fx_src_prescription_totals x ON x.patient_id = e.patient_id AND x.drug_id = d.drug_inventory_id
      AND x.prescription_date = CAST(e.encounter_datetime AS DATE)""")

_RECODE = "CASE t.relationship WHEN 1 THEN 7 WHEN 2 THEN 3 WHEN 4 THEN 3 WHEN 6 THEN 3 WHEN 7 THEN 11 WHEN 8 THEN 2 WHEN 9 THEN 12 ELSE 13 END"
_RECODE_AS_WRITTEN = "CASE t.relationship WHEN 1 THEN 7 WHEN 7 THEN 11 WHEN 8 THEN 2 WHEN 9 THEN 12 ELSE 13 END"
_VISIT = """CASE lower(y.name) WHEN 'hiv first visit' THEN 'HIV CLINIC REGISTRATION' WHEN 'art visit' THEN 'HIV CLINIC CONSULTATION'
    WHEN 'give drugs' THEN 'DISPENSING' WHEN 'date of art initiation' THEN 'ART ENROLLMENT' WHEN 'height/weight' THEN 'VITALS'
    WHEN 'general reception' THEN 'REGISTRATION' WHEN 'barcode scan' THEN 'REGISTRATION' WHEN 'tb reception' THEN 'TB CLINIC VISIT'
    WHEN 'reffered' THEN 'IS PATIENT REFERRED?' END"""
_VISIT_AS_WRITTEN = """CASE lower(y.name) WHEN 'hiv first visit' THEN 'HIV CLINIC REGISTRATION' WHEN 'art visit' THEN 'HIV CLINIC CONSULTATION'
    WHEN 'give drugs' THEN 'DISPENSING' WHEN 'date of art initiation' THEN 'ART ENROLLMENT' WHEN 'height/weight' THEN 'VITALS' ELSE 'REGISTRATION' END"""


def _relationships(recode: str) -> str:
    return f"""SELECT t.relationship_id, a.patient_id AS person_a, {recode} AS relationship, b.patient_id AS person_b, {_BY}, {_VOIDED},
        {_uuid('relationship', 't.relationship_id')} FROM fx_src_relationship t JOIN fx_src_person a ON a.person_id = t.person_id
        LEFT JOIN fx_src_person b ON b.person_id = t.relative_id"""


def _encounters(recode: str) -> str:
    return f"""SELECT t.encounter_id, (SELECT min(v.encounter_type_id) FROM fx_dst_encounter_type v WHERE v.name = {recode}) AS encounter_type,
        t.patient_id, {_user('t.provider_id')} AS provider_id, t.location_id, t.form_id, t.encounter_datetime, {_BY},
        {_uuid('encounter', 't.encounter_id')} FROM fx_src_encounter t JOIN fx_src_encounter_type y ON y.encounter_type_id = t.encounter_type"""


_CONTACTS = "('occupation', 'cell phone number', 'physical address', 'traditional authority', 'home phone number', 'office phone number')"


def _typed(dim: str, key: str) -> str:
    return f"(SELECT min(n.{key}) FROM fx_{dim} n WHERE lower(n.name) = lower(y.name))"


_STATUS = f"""FROM mapped_obs o LEFT JOIN states s ON s.concept_id = o.value_coded LEFT JOIN last_program l ON l.patient_id = o.person_id
    WHERE o.concept_id = {_target('antiretroviral treatment status')} AND o.obs_id NOT IN (SELECT obs_id FROM fx_obs_edit_audit)"""
_STARTED = "(SELECT min(state) FROM states WHERE starts)"
_DAYS = "CAST(round(d.quantity / nullif(coalesce(d.daily_consumption, 1), 0)) AS INT)"

# name -> (fixture tables, named queries, select)
_STEPS: dict[str, tuple[list[str], list, str]] = {
    "mig_users_to_persons": (["src_users", "src_patient"], [PERSONS], """
        SELECT user_id, person_id, creator, date_created, changed_by, date_changed, voided, voided_by, date_voided, void_reason FROM persons"""),
    "mig_user_persons": (["src_users", "src_patient"], [PERSONS, USER_MAP], f"""
        SELECT t.person_id, {_BY}, {_CHANGED}, {_VOIDED}, {_uuid('person', 't.person_id')} FROM persons t"""),
    "mig_user_names": (["src_users", "src_patient"], [PERSONS, USER_MAP], f"""
        SELECT t.person_id, t.first_name AS given_name, t.middle_name, t.last_name AS family_name, {_BY}, {_CHANGED}, {_VOIDED},
          {_uuid('person_name', 't.person_id')} FROM persons t"""),
    "mig_user_rows": (["src_users", "src_patient"], [PERSONS, USER_MAP], f"""
        SELECT t.person_id AS user_id, t.username, t.password, t.salt, t.secret_question, t.secret_answer, {_BY}, {_CHANGED},
          t.person_id, {_uuid('users', 't.person_id')} FROM persons t"""),
    "mig_person": (["src_users", "src_patient"], [PERSONS, USER_MAP], f"""
        SELECT t.patient_id AS person_id, t.gender, t.birthdate, t.birthdate_estimated, t.dead, t.death_date, t.cause_of_death,
          {_BY}, {_CHANGED}, {_VOIDED}, {_uuid('person', 't.patient_id')} FROM fx_src_patient t"""),
    "mig_patient": (["src_users", "src_patient"], [PERSONS, USER_MAP], f"""
        SELECT t.patient_id, t.tribe, {_BY}, {_CHANGED}, {_VOIDED}, {_uuid('patient', 't.patient_id')} FROM fx_src_patient t"""),
    "mig_relationships": (["src_users", "src_patient", "src_relationship", "src_person"], [PERSONS, USER_MAP], _relationships(_RECODE)),
    "mig_relationships_as_written": (
        ["src_users", "src_patient", "src_relationship", "src_person"], [PERSONS, USER_MAP], _relationships(_RECODE_AS_WRITTEN)),
    "mig_addresses": (["src_users", "src_patient", "src_patient_address"], [PERSONS, USER_MAP], f"""
        SELECT t.patient_address_id AS person_address_id, t.patient_id AS person_id, t.preferred, t.address1, t.address2,
          t.city_village, t.state_province, t.postal_code, t.country, t.latitude, t.longitude, {_BY}, {_VOIDED},
          CAST(NULL AS VARCHAR) AS county_district, CAST(NULL AS VARCHAR) AS neighborhood_cell, CAST(NULL AS VARCHAR) AS region,
          CAST(NULL AS VARCHAR) AS subregion, CAST(NULL AS VARCHAR) AS township_division,
          {_uuid('person_address', 't.patient_address_id')} FROM fx_src_patient_address t"""),
    "mig_names": (["src_users", "src_patient", "src_patient_name"], [PERSONS, USER_MAP], f"""
        SELECT t.patient_id AS person_id, t.preferred, t.prefix, t.given_name, t.middle_name, t.family_name_prefix, t.family_name,
          t.family_name2, t.family_name_suffix, t.degree, {_BY}, {_VOIDED}, {_CHANGED},
          {_uuid('person_name', 't.patient_name_id')} FROM fx_src_patient_name t"""),
    "mig_identifiers": (
        ["src_users", "src_patient", "src_patient_identifier", "src_identifier_type", "dst_identifier_type"], [PERSONS, USER_MAP], f"""
        SELECT t.patient_id, t.identifier, {_typed('dst_identifier_type', 'patient_identifier_type_id')} AS identifier_type, t.preferred,
          t.location_id, {_BY}, {_VOIDED}, {_uuid('patient_identifier', *_IDENTIFIER_KEY)}
        FROM fx_src_patient_identifier t JOIN fx_src_identifier_type y ON y.patient_identifier_type_id = t.identifier_type
        WHERE lower(y.name) NOT IN {_CONTACTS}"""),
    "mig_attributes": (
        ["src_users", "src_patient", "src_patient_identifier", "src_identifier_type", "dst_attribute_type"], [PERSONS, USER_MAP], f"""
        SELECT t.patient_id AS person_id, t.identifier AS value, {_typed('dst_attribute_type', 'person_attribute_type_id')} AS person_attribute_type_id,
          {_BY}, {_VOIDED}, {_uuid('person_attribute', *_IDENTIFIER_KEY)}
        FROM fx_src_patient_identifier t JOIN fx_src_identifier_type y ON y.patient_identifier_type_id = t.identifier_type
        WHERE lower(y.name) IN {_CONTACTS}"""),
    "mig_programs": (["src_users", "src_patient", "src_patient_program"], [PERSONS, USER_MAP], f"""
        SELECT t.patient_program_id, t.patient_id, t.program_id, t.date_enrolled, t.date_completed, {_BY}, {_CHANGED}, {_VOIDED},
          CAST(NULL AS BIGINT) AS location_id, {_uuid('patient_program', 't.patient_program_id')} FROM fx_src_patient_program t"""),
    "mig_states_from_orders": (
        ["src_users", "src_patient", "src_patient_program", "src_orders", "src_encounter", "src_encounter_type", "concept_name",
         "program", "program_workflow", "program_workflow_state"], [PERSONS, USER_MAP, PROGRAM, STATES, DISPENSED], f"""
        SELECT l.patient_program_id, {_STARTED} AS state, CAST(t.date_created AS DATE) AS start_date, {_BY},
          {_uuid('patient_state', 't.order_id')} FROM dispensed t LEFT JOIN last_program l USING (patient_id)"""),
    "mig_states_from_regimen_orders": (
        ["src_users", "src_patient", "src_patient_program", "src_orders", "src_encounter", "src_drug_order", "src_drug", "concept_name",
         "program", "program_workflow", "program_workflow_state"], [PERSONS, USER_MAP, PROGRAM, STATES], f"""
        SELECT l.patient_program_id, {_STARTED} AS state, CAST(t.date_created AS DATE) AS start_date,
          coalesce({_user('t.creator')}, t.creator) AS creator, t.date_created, t.order_id
        FROM fx_src_orders t JOIN fx_src_encounter e USING (encounter_id) LEFT JOIN last_program l ON l.patient_id = e.patient_id
        WHERE t.order_id IN (SELECT order_id FROM fx_src_drug_order WHERE drug_inventory_id IN
          (SELECT drug_id FROM fx_src_drug WHERE concept_id IN (450, 451, 452, 458, 826, 827, 828, 829, 453)))"""),
    "mig_encounters": (
        ["src_users", "src_patient", "src_encounter", "src_encounter_type", "dst_encounter_type"], [PERSONS, USER_MAP], _encounters(_VISIT)),
    "mig_encounters_as_written": (
        ["src_users", "src_patient", "src_encounter", "src_encounter_type", "dst_encounter_type"], [PERSONS, USER_MAP],
        _encounters(_VISIT_AS_WRITTEN)),
    "mig_obs": (["src_users", "src_patient", "src_obs", "concept_map", "concept_name"], [PERSONS, USER_MAP, OBS], "SELECT * FROM mapped_obs"),
    "mig_obs_uninverted": (["src_users", "src_patient", "src_obs", "concept_map"], [PERSONS, USER_MAP], f"""
        SELECT t.obs_id, t.patient_id AS person_id, {_concept('t.concept_id')} AS concept_id, {_OBS_BEFORE},
          {_concept('t.value_coded')} AS value_coded, {_OBS_AFTER}, {_BY}, {_VOIDED}, {_uuid('obs', 't.obs_id')} FROM fx_src_obs t"""),
    "mig_unmapped_concepts": (["src_users", "src_patient", "src_obs", "concept_map", "concept_name"], [PERSONS, USER_MAP, OBS], """
        SELECT CASE WHEN concept_id IS NULL THEN 'not in the map' WHEN concept_id = 0 THEN 'no target' ELSE 'mapped' END AS outcome,
          count(*) AS observations FROM mapped_obs GROUP BY 1"""),
    "mig_eligibility_obs": (
        ["src_users", "src_patient", "src_obs", "src_encounter", "src_encounter_type", "src_concept", "src_concept_set", "concept_map",
         "concept_name"], [PERSONS, USER_MAP, *reason("intended"), stage("stages_today", f"DATE '{AS_OF}'")], f"""
        SELECT t.patient_id AS person_id, {_target('reason for art eligibility')} AS concept_id, t.encounter_id,
          t.encounter_datetime AS obs_datetime, t.location_id,
          {_concept('(SELECT min(c.concept_id) FROM fx_src_concept c WHERE lower(c.name) = lower(r.reason))')} AS value_coded, {_BY},
          {_uuid('obs_reason', 't.patient_id')}
        FROM fx_src_encounter t JOIN reasons r USING (patient_id) JOIN stages_today s USING (patient_id)
        WHERE s.stage > 1 AND (SELECT min(c.concept_id) FROM fx_src_concept c WHERE lower(c.name) = lower(r.reason)) IS NOT NULL
          AND t.encounter_id IN (SELECT min(v.encounter_id) FROM fx_src_encounter v JOIN fx_src_encounter_type y
            ON y.encounter_type_id = v.encounter_type AND lower(y.name) = 'hiv staging' GROUP BY v.patient_id)"""),
    "mig_regimen_obs": (
        ["src_users", "src_patient", "src_patient_program", "src_orders", "src_encounter", "src_encounter_type", "src_drug_order",
         "src_drug", "concept_name"], [PERSONS, USER_MAP, DISPENSED], f"""
        SELECT t.patient_id AS person_id, {_target('regimen category')} AS concept_id, t.encounter_id, t.date_created AS obs_datetime,
          {category('g.concept_id', of_patient('t.date_created'))} AS value_text, {_BY}, {_uuid('obs_regimen', 't.order_id')}
        FROM dispensed t LEFT JOIN fx_src_drug_order d USING (order_id) LEFT JOIN fx_src_drug g ON g.drug_id = d.drug_inventory_id
        LEFT JOIN fx_src_patient pt ON pt.patient_id = t.patient_id"""),
    "mig_states_from_obs": (
        ["src_users", "src_patient", "src_obs", "concept_map", "concept_name", "src_patient_program", "obs_edit_audit", "program",
         "program_workflow", "program_workflow_state"], [PERSONS, USER_MAP, OBS, PROGRAM, STATES], f"""
        SELECT l.patient_program_id, s.state, CAST(o.obs_datetime AS DATE) AS start_date, o.creator, o.obs_datetime AS date_created,
          {_uuid('patient_state_obs', 'o.obs_id')} {_STATUS}"""),
    "audit_replay": (
        ["src_users", "src_patient", "src_obs", "concept_map", "concept_name", "src_patient_program", "obs_edit_audit", "program",
         "program_workflow", "program_workflow_state"], [PERSONS, USER_MAP, OBS, PROGRAM, STATES], f"""
        SELECT l.patient_program_id, s.state, CAST(o.obs_datetime AS DATE) AS start_date, o.creator, o.obs_datetime AS date_created,
          {_uuid('patient_state_obs', 'o.obs_id')} {_STATUS}"""),
    "mig_orders": (
        ["src_users", "src_patient", "src_orders", "src_encounter", "src_drug_order", "src_prescription_totals"], [PERSONS, USER_MAP, DOSED], f"""
        SELECT t.order_id, t.order_type_id, t.concept_id, {_user('t.orderer')} AS orderer, t.encounter_id, t.instructions,
          coalesce(t.start_date, t.date_created) AS start_date,
          coalesce(t.auto_expire_date, coalesce(t.start_date, t.date_created) + to_days({_DAYS})) AS auto_expire_date,
          t.discontinued, t.discontinued_date, {_user('t.discontinued_by')} AS discontinued_by, t.discontinued_reason, {_BY},
          {_VOIDED}, e.patient_id, {_uuid('orders', 't.order_id')}
        FROM fx_src_orders t JOIN fx_src_encounter e USING (encounter_id) LEFT JOIN dosed d ON d.order_id = t.order_id"""),
    "mig_drug_orders": (
        ["src_orders", "src_encounter", "src_drug_order", "src_prescription_totals"],
        [DOSED, ("drug_map", f"SELECT * FROM (VALUES {_DRUG_VALUES}) v(old, new)")], """
        SELECT d.order_id, CAST((SELECT min(new) FROM drug_map m WHERE m.old = d.drug_inventory_id) AS BIGINT) AS drug_inventory_id, d.dose,
          d.daily_consumption AS equivalent_daily_dose, d.units, d.frequency, d.prn, d.complex, d.quantity FROM dosed d"""),
    "mig_export_obs": (["src_users", "src_patient", "src_obs", "concept_map"], [PERSONS, USER_MAP], f"""
        SELECT t.obs_id, t.patient_id AS person_id, coalesce({_concept('t.concept_id')}, t.concept_id) AS concept_id, {_OBS_BEFORE},
          coalesce({_concept('t.value_coded')}, t.value_coded) AS value_coded, {_OBS_AFTER}, {_OLD_BY}, {_OLD_VOIDED},
          {_uuid('obs', 't.obs_id')} FROM fx_src_obs t"""),
    "mig_export_person": (["src_users", "src_patient"], [PERSONS, USER_MAP], f"""
        SELECT t.patient_id AS person_id, t.gender, t.birthdate, t.birthdate_estimated, t.dead, t.death_date, t.cause_of_death,
          {_OLD_BY}, {_OLD_CHANGED}, {_OLD_VOIDED}, {_uuid('person', 't.patient_id')} FROM fx_src_patient t"""),
    "mig_export_patient": (["src_users", "src_patient"], [PERSONS, USER_MAP], f"""
        SELECT t.patient_id, t.tribe, {_OLD_BY}, {_OLD_CHANGED}, {_OLD_VOIDED}, {_uuid('patient', 't.patient_id')} FROM fx_src_patient t"""),
    "mig_export_programs": (["src_users", "src_patient", "src_patient_program"], [PERSONS, USER_MAP], f"""
        SELECT t.patient_program_id, t.patient_id, t.program_id, t.date_enrolled, t.date_completed, {_OLD_BY}, {_OLD_CHANGED},
          {_OLD_VOIDED}, CAST(NULL AS BIGINT) AS location_id, {_uuid('patient_program', 't.patient_program_id')}
        FROM fx_src_patient_program t"""),
    "mig_export_encounters": (
        ["src_users", "src_patient", "src_encounter", "src_encounter_type", "dst_encounter_type"], [PERSONS, USER_MAP], f"""
        SELECT t.encounter_id, coalesce((SELECT min(v.encounter_type_id) FROM fx_dst_encounter_type v WHERE v.name = {_VISIT}),
            t.encounter_type) AS encounter_type, t.patient_id, t.provider_id, t.location_id, t.form_id, t.encounter_datetime,
          {_OLD_BY}, {_OLD_VOIDED}, {_OLD_CHANGED}, {_uuid('encounter', 't.encounter_id')}
        FROM fx_src_encounter t JOIN fx_src_encounter_type y ON y.encounter_type_id = t.encounter_type"""),
    "mig_export_orders": (["src_users", "src_patient", "src_orders", "concept_map"], [PERSONS, USER_MAP], f"""
        SELECT t.order_id, t.order_type_id, coalesce({_concept('t.concept_id')}, t.concept_id) AS concept_id, t.orderer, t.encounter_id,
          t.instructions, t.start_date, t.auto_expire_date, t.discontinued, t.discontinued_date, t.discontinued_by,
          t.discontinued_reason, {_OLD_BY}, {_OLD_VOIDED}, {_uuid('orders', 't.order_id')} FROM fx_src_orders t"""),
    "mig_export_drug_orders": (["src_drug_order"], [], f"""
        SELECT t.order_id, t.drug_inventory_id, t.dose, t.units, t.frequency, t.prn, t.complex, t.quantity,
          {_uuid('drug_order', 't.order_id')} FROM fx_src_drug_order t"""),
    "mig_export_states_from_orders": (
        ["src_users", "src_patient", "src_patient_program", "src_orders", "src_encounter", "src_drug_order", "src_drug", "concept_name",
         "program", "program_workflow", "program_workflow_state"], [PERSONS, USER_MAP, PROGRAM, STATES], f"""
        SELECT l.patient_program_id, {_STARTED} AS state, CAST(t.date_created AS DATE) AS start_date, {_OLD_BY}
        FROM fx_src_orders t JOIN fx_src_encounter e USING (encounter_id) LEFT JOIN last_program l ON l.patient_id = e.patient_id
        WHERE t.order_id IN (SELECT order_id FROM fx_src_drug_order WHERE drug_inventory_id IN
          (SELECT drug_id FROM fx_src_drug WHERE concept_id IN (450, 451, 452, 458, 826, 827, 828, 829, 453)))"""),
    "mig_export_identifiers": (["src_users", "src_patient", "src_patient_identifier"], [PERSONS, USER_MAP], f"""
        SELECT t.patient_id, t.identifier, t.identifier_type, t.preferred, t.location_id, coalesce({_user('t.creator')}, t.creator) AS creator,
          t.date_created, {_OLD_VOIDED}, {_uuid('patient_identifier', *_IDENTIFIER_KEY)}
        FROM fx_src_patient_identifier t WHERE t.identifier_type NOT IN (2, 3, 5, 6, 8, 9, 11, 12)"""),
    "mig_export_states": (
        ["src_users", "src_patient", "src_obs", "concept_map", "concept_name", "src_patient_program", "program", "program_workflow",
         "program_workflow_state"], [PERSONS, USER_MAP, PROGRAM, STATES], f"""
        SELECT l.patient_program_id, s.state, CAST(t.obs_datetime AS DATE) AS start_date, coalesce({_user('t.creator')}, t.creator) AS creator,
          t.date_created FROM fx_src_obs t LEFT JOIN states s ON s.concept_id = {_concept('t.value_coded')}
        LEFT JOIN last_program l ON l.patient_id = t.patient_id WHERE t.concept_id = 28"""),
    "mig_slice": (["src_patient"], [], """
        SELECT patient_id FROM fx_src_patient ORDER BY date_created DESC, patient_id LIMIT 60 OFFSET 70"""),
    "quarantine": (["src_users", "src_patient"], [PERSONS, USER_MAP], f"""
        SELECT patient_id, concat_ws('; ', CASE WHEN birthdate IS NULL THEN 'birthdate missing' END,
          CASE WHEN gender IS NULL THEN 'gender missing' END,
          CASE WHEN death_date < CAST(birthdate AS TIMESTAMP) THEN 'died before birth' END,
          CASE WHEN {_user('t.creator')} IS NULL THEN 'creator unknown' END) AS errors
        FROM fx_src_patient t WHERE birthdate IS NULL OR gender IS NULL OR death_date < CAST(birthdate AS TIMESTAMP)
          OR {_user('t.creator')} IS NULL"""),
    "quarantine_rest_skipped": (["src_users", "src_patient", "src_encounter"], [PERSONS, USER_MAP], f"""
        SELECT e.encounter_id, e.patient_id FROM fx_src_encounter e WHERE e.patient_id NOT IN (SELECT patient_id
          FROM fx_src_patient t WHERE birthdate IS NULL OR gender IS NULL OR death_date < CAST(birthdate AS TIMESTAMP)
          OR {_user('t.creator')} IS NULL)"""),
    "upsert_keep_existing": (["src_patient", "patient", "raw_customer"][:2], [], """
        SELECT patient_id, creator, date_created FROM fx_patient WHERE patient_id IN (SELECT patient_id FROM fx_src_patient WHERE dead = 0)
        UNION ALL SELECT patient_id, creator, date_created FROM fx_src_patient WHERE dead = 1"""),
    "upsert_reset_owner": (["src_person", "src_relationship"], [], """
        SELECT t.relationship_id, coalesce(a.patient_id, -1) AS person_a, t.relationship
        FROM fx_src_relationship t LEFT JOIN fx_src_person a ON a.person_id = t.person_id"""),
    "key_maps_from_files": (["src_users", "src_patient", "concept_map"], [PERSONS, USER_MAP], """
        SELECT 'user' AS map, old_user_id AS old_key, new_user_id AS new_key, CAST(NULL AS VARCHAR) AS old_name FROM user_map
        UNION ALL SELECT 'concept', old_concept_id, new_concept_id, old_concept_name FROM fx_concept_map"""),
    "person_closure": (
        ["person", "patient", "patient_program", "patient_state", "encounter", "obs", "orders", "drug_order", "person_address",
         "person_attribute", "person_name", "person_name_code", "patient_identifier"], [], """
        SELECT 'person_address' AS table_name, person_address_id AS id FROM fx_person_address
          WHERE person_id IN (SELECT person_id FROM fx_person WHERE dead = 1)
        UNION ALL SELECT 'person_attribute', person_attribute_id FROM fx_person_attribute
          WHERE person_id IN (SELECT person_id FROM fx_person WHERE dead = 1)
        UNION ALL SELECT 'person_name', person_name_id FROM fx_person_name
          WHERE person_id IN (SELECT person_id FROM fx_person WHERE dead = 1)
        UNION ALL SELECT 'person_name_code', person_name_code_id FROM fx_person_name_code WHERE person_name_id IN (SELECT person_name_id
          FROM fx_person_name WHERE person_id IN (SELECT person_id FROM fx_person WHERE dead = 1))
        UNION ALL SELECT 'patient_identifier', patient_identifier_id FROM fx_patient_identifier
          WHERE patient_id IN (SELECT person_id FROM fx_person WHERE dead = 1)
        UNION ALL
        SELECT 'person' AS table_name, person_id AS id FROM fx_person WHERE dead = 1
        UNION ALL SELECT 'patient', patient_id FROM fx_patient WHERE patient_id IN (SELECT person_id FROM fx_person WHERE dead = 1)
        UNION ALL SELECT 'patient_program', patient_program_id FROM fx_patient_program WHERE patient_id IN (SELECT person_id FROM fx_person WHERE dead = 1)
        UNION ALL SELECT 'patient_state', patient_state_id FROM fx_patient_state WHERE patient_program_id IN (SELECT patient_program_id
          FROM fx_patient_program WHERE patient_id IN (SELECT person_id FROM fx_person WHERE dead = 1))
        UNION ALL SELECT 'encounter', encounter_id FROM fx_encounter WHERE patient_id IN (SELECT person_id FROM fx_person WHERE dead = 1)
        UNION ALL SELECT 'obs', obs_id FROM fx_obs WHERE person_id IN (SELECT person_id FROM fx_person WHERE dead = 1)
        UNION ALL SELECT 'orders', order_id FROM fx_orders WHERE encounter_id IN (SELECT encounter_id FROM fx_encounter
          WHERE patient_id IN (SELECT person_id FROM fx_person WHERE dead = 1))
        UNION ALL SELECT 'drug_order', order_id FROM fx_drug_order WHERE order_id IN (SELECT order_id FROM fx_orders WHERE encounter_id IN
          (SELECT encounter_id FROM fx_encounter WHERE patient_id IN (SELECT person_id FROM fx_person WHERE dead = 1)))"""),
}

_STEPS["stream_states_once"] = (
    [t for t in _STEPS["mig_states_from_obs"][0] if t != "obs_edit_audit"], _STEPS["mig_states_from_obs"][1],
    _STEPS["mig_states_from_obs"][2].replace("AND o.obs_id NOT IN (SELECT obs_id FROM fx_obs_edit_audit)", ""),
)

MIGRATION_SQL = {name: with_tables(tables, *queries) + select for name, (tables, queries, select) in _STEPS.items()}

# Raw tables that are not on the exclusion list.
_REFERENCE = ("customer", "lineitem", "nation", "part", "region", "supplier")
MIGRATION_SQL["reference_tables"] = "\nUNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in _REFERENCE)
