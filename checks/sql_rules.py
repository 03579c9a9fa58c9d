"""SQL for checking the views and the clinical rules."""

from __future__ import annotations

from checks.sql_readmodel import AS_OF, with_tables

VIEW_SQL = {
    "clinic_consultation_encounter": (["encounter"], "SELECT * FROM fx_encounter WHERE encounter_type = 53 AND voided = 0"),
    "clinic_registration_encounter": (["encounter"], "SELECT * FROM fx_encounter WHERE encounter_type = 9 AND voided = 0"),
    "earliest_start_date": (["patient_program", "patient_state", "person"], """
        SELECT pp.patient_id, arg_min(pp.date_enrolled, pp.patient_program_id) AS date_enrolled, min(s.start_date) AS earliest_start_date,
          any_value(pe.death_date) AS death_date
        FROM fx_patient_program pp LEFT JOIN fx_patient_state s ON s.patient_program_id = pp.patient_program_id
        LEFT JOIN fx_person pe ON pe.person_id = pp.patient_id
        WHERE pp.voided = 0 AND s.voided = 0 AND pp.program_id = 1 AND s.state = 7 GROUP BY pp.patient_id"""),
    "patient_pregnant_obs": (["obs"], "SELECT * FROM fx_obs WHERE concept_id = 6131 AND value_coded = 1065 AND voided = 0"),
    "patient_state_on_arvs": (["patient_state"], "SELECT * FROM fx_patient_state WHERE state = 7 AND voided = 0"),
    "regimen_observation": (["obs"], "SELECT * FROM fx_obs WHERE concept_id = 2559 AND voided = 0"),
    "start_date_observation": (["obs"], "SELECT * FROM fx_obs WHERE concept_id = 2516 AND voided = 0"),
    "tb_status_observations": (["obs"], "SELECT * FROM fx_obs WHERE concept_id = 7459 AND voided = 0"),
}

SRC = [
    "src_patient", "src_obs", "src_encounter", "src_encounter_type", "src_concept", "src_concept_set", "src_orders",
    "src_drug_order", "src_drug",
]


def age(birth: str, visit: str, created: str, estimated: str, as_of: str) -> str:
    """Years of a day count, by the year of day N after the start of the calendar."""
    n = f"date_diff('day', CAST({birth} AS DATE), CAST({visit} AS DATE))"
    years = f"CASE WHEN {n} < 366 THEN 0 ELSE year(DATE '0001-01-01' + CAST({n} - 366 AS INT)) END"
    return f"""(CASE WHEN {n} IS NULL THEN NULL ELSE {years} + CASE WHEN month({birth}) = 7 AND day({birth}) = 1
        AND {estimated} = 1 AND month(DATE '{as_of}') < 7 AND year({created}) = year(DATE '{as_of}') THEN 1 ELSE 0 END END)"""


def of_patient(visit: str, as_of: str = AS_OF, alias: str = "pt") -> str:
    return age(f"{alias}.birthdate", visit, f"{alias}.date_created", f"{alias}.birthdate_estimated", as_of)


def category(regimen: str, years: str) -> str:
    arms = ""
    for concept, peds, adult in (
        (450, "P1", "1A"), (451, "2P", "2A"), (452, "3P", "3A"), (458, "4P", "4A"), (826, "5P", "5A"),
        (827, "6P", "6A"), (828, "7P", "7A"), (829, "8P", "8A"), (453, "9P", "9A"),
    ):
        arms += f" WHEN {regimen} = {concept} AND {years} < 15 THEN '{peds}' WHEN {regimen} = {concept} AND {years} > 14 THEN '{adult}'"
    return f"CASE{arms} ELSE 'Nn' END"


def _concept(name: str) -> str:
    return f"(SELECT min(concept_id) FROM fx_src_concept WHERE lower(name) = '{name.lower()}')"


def stage(name: str, asked: str) -> tuple[str, str]:
    """A named query ``(patient_id, stage, band)`` for the day expression ``asked`` over ``pt``."""
    return name, f"""
        SELECT pt.patient_id, CASE WHEN {of_patient(asked)} <= 14 THEN 'peds' ELSE 'adult' END AS band,
          coalesce((SELECT max(CAST(substr(s.name, 11, 1) AS INT)) FROM fx_src_obs o
            JOIN fx_src_concept_set cs ON cs.concept_id = o.concept_id
            JOIN fx_src_concept s ON s.concept_id = cs.concept_set
            WHERE o.patient_id = pt.patient_id AND o.value_coded = {_concept('Yes')}
              AND o.encounter_id = (SELECT min(e.encounter_id) FROM fx_src_encounter e JOIN fx_src_encounter_type t
                ON t.encounter_type_id = e.encounter_type AND lower(t.name) = 'hiv staging'
                WHERE e.patient_id = pt.patient_id AND e.voided = 0)
              AND lower(s.name) IN (SELECT 'who stage ' || g.n || ' ' || CASE WHEN {of_patient(asked)} <= 14 THEN 'peds' ELSE 'adult' END
                FROM (VALUES (2), (3), (4)) g(n))), 1) AS stage
        FROM base pt"""


BASE = ("base", """
    SELECT p.*, (SELECT CAST(min(e.encounter_datetime) AS DATE) FROM fx_src_encounter e JOIN fx_src_encounter_type t
        ON t.encounter_type_id = e.encounter_type WHERE lower(t.name) = 'hiv staging' AND e.patient_id = p.patient_id) AS first_visit,
      (SELECT CAST(max(e.encounter_datetime) AS DATE) FROM fx_src_encounter e JOIN fx_src_encounter_type t
        ON t.encounter_type_id = e.encounter_type WHERE lower(t.name) = 'hiv staging' AND e.patient_id = p.patient_id) AS last_visit
    FROM fx_src_patient p""")


def reason(compat: str) -> list[tuple[str, str]]:
    own = "o.patient_id = x.patient_id AND " if compat == "intended" else ""
    yes = f"o.value_coded = {_concept('Yes')}"

    def exists(condition: str, scope: str = own) -> str:
        # set membership keeps the checking engine from nested loops
        if scope:
            return f"x.patient_id IN (SELECT o.patient_id FROM fx_src_obs o WHERE {condition})"
        return f"EXISTS (SELECT 1 FROM fx_src_obs o WHERE {condition})"

    def confirmed(name: str) -> str:
        return exists(f"o.concept_id = {_concept(name)} AND {yes} AND o.voided = 0")

    def low(limit: int) -> str:
        return exists(f"o.concept_id = {_concept('CD4 count')} AND o.value_numeric <= {limit} AND {yes} AND o.voided = 0", "own")

    severe = [confirmed(c) for c in (
        "Pneumocystis pneumonia", "Candidiasis of oesophagus", "Cryptococcal meningitis",
        "Severe unexplained wasting / malnutrition not responding to treatment(weight-for-height/ -age less than 70% or MUAC less than 11cm or oedema)",
        "Toxoplasmosis of the brain (from age 1 month)",
    )]
    thrush, sepsis, pneumonia = (confirmed(c) for c in ("Oral thrush", "Sepsis, severe", "Pneumonia, severe"))
    presumed = f"({' OR '.join(severe)} OR ({thrush} AND {sepsis}) OR ({thrush} AND {pneumonia}) OR ({sepsis} AND {pneumonia}))"
    limit = (
        "CASE WHEN x.age BETWEEN 0 AND 2 THEN 4000 WHEN x.age BETWEEN 3 AND 4 THEN 3000 WHEN x.age = 5 THEN 2500 "
        "WHEN x.age BETWEEN 6 AND 15 THEN 2000 END" if compat == "intended" else
        "CASE x.age WHEN 1 THEN 4000 WHEN 5 THEN 2500 WHEN 0 THEN 2000 END"
    )
    lowest = (
        f"(SELECT min(o.value_numeric) FROM fx_src_obs o WHERE {own} o.concept_id = {_concept('Lymphocyte count')} AND o.voided = 0)"
    )
    first_test = f"o.concept_id = {_concept('First positive HIV Test')} AND o.voided = 0 AND o.value_coded"
    last = "b.last_visit" if compat == "intended" else "(SELECT max(last_visit) FROM base)"
    cd4_750 = exists(
        f"(o.value_numeric <= 750 AND o.concept_id = {_concept('CD4 count')}) OR "
        f"(o.concept_id = {_concept('CD4 Count < 750')} AND {yes} AND o.voided = 0)"
    )
    female = "lower(x.gender) = 'female' AND x.asked >= DATE '2010-01-01'"
    return [
        BASE,
        stage("stages", "coalesce(pt.first_visit, DATE '2010-01-01')"),
        ("x", f"""
            SELECT b.patient_id, b.gender, b.first_visit, coalesce(b.first_visit, DATE '2010-01-01') AS asked, s.stage, s.band,
              {of_patient("coalesce(b.first_visit, DATE '2010-01-01')", alias='b')} AS age,
              12 * {of_patient(last, alias='b')} AS months
            FROM base b JOIN stages s USING (patient_id)"""),
        ("reasons", f"""
            SELECT x.patient_id, x.stage, CASE
              WHEN age <= 14 AND months <= 17 AND {exists(f"{first_test} = {_concept('Rapid Test')}")} AND {presumed} THEN 'Presumed HIV Disease'
              WHEN age <= 14 AND months <= 12 AND {exists(f"{first_test} = {_concept('PCR Test')}")} AND first_visit IS NOT NULL THEN 'PCR Test'
              WHEN stage >= 3 THEN 'WHO stage ' || stage || ' ' || band
              WHEN age <= 14 AND months >= 12 AND months < 24 THEN 'Child HIV positive'
              WHEN age <= 14 AND months >= 24 AND months < 56 AND {cd4_750} THEN 'CD4 count < 750'
              WHEN {low(350)} AND asked >= DATE '2011-07-01' THEN 'CD4 count < 350'
              WHEN {low(250)} THEN 'CD4 count < 250'
              WHEN age <= 14 AND {lowest} <= {limit} AND stage = 2 THEN 'Lymphocyte count below threshold with WHO stage 2'
              WHEN {female} AND {confirmed('Pregnant')} THEN 'Pregnant'
              WHEN {female} AND {confirmed('Breastfeeding')} THEN 'Breastfeeding' END AS reason
            FROM x"""),
    ]


_REASON_SELECT = """SELECT patient_id, reason,
    (SELECT min(concept_id) FROM fx_src_concept c WHERE lower(c.name) = lower(r.reason)) AS reason_concept_id FROM reasons r"""

RULE_SQL = {
    "rule_age": with_tables(SRC) + f"""SELECT pt.patient_id, e.encounter_id,
        CAST({of_patient('e.encounter_datetime', '2001-03-31')} AS BIGINT) AS age
        FROM fx_src_encounter e LEFT JOIN fx_src_patient pt USING (patient_id)""",
    "rule_regimen": with_tables(SRC) + f"""SELECT o.order_id, e.patient_id,
        {category('g.concept_id', of_patient('o.date_created'))} AS category
        FROM fx_src_orders o JOIN fx_src_encounter e USING (encounter_id) JOIN fx_src_drug_order d USING (order_id)
        LEFT JOIN fx_src_drug g ON g.drug_id = d.drug_inventory_id LEFT JOIN fx_src_patient pt ON pt.patient_id = e.patient_id""",
    "rule_stage": with_tables(SRC, BASE, stage("stages", f"DATE '{AS_OF}'"))
    + "SELECT patient_id, band, CAST(stage AS BIGINT) AS stage FROM stages",
    "rule_reason": with_tables(SRC, *reason("intended")) + _REASON_SELECT,
    "rule_reason_as_written": with_tables(SRC, *reason("as_written")) + _REASON_SELECT,
}
