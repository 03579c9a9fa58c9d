"""SQL for checking the read model, written apart from the Spark plans.

Events are ranked with ``row_number`` here, one rule at a time.
"""

from __future__ import annotations

from quarterfold.fixtures import TABLES, with_dependencies

AS_OF = "2001-12-31"


def table_sql(name: str) -> str:
    """A fixture projection as the checking engine's SQL."""
    text = TABLES[name].replace("{ts}", "TIMESTAMP")
    refs = {n: n[4:] if n.startswith("raw_") else f"fx_{n}" for n in ALL_NAMES}
    return text.format_map(refs)


ALL_NAMES = [*TABLES, *(f"raw_{t}" for t in ("customer", "orders", "lineitem", "part", "nation", "events"))]


def with_tables(names: list[str], *more: tuple[str, str]) -> str:
    """``WITH`` clause of fixture tables (as ``fx_<name>``) and further named queries."""
    parts = [f"fx_{n} AS ({table_sql(n)})" for n in with_dependencies(names)]
    parts += [f"{n} AS MATERIALIZED ({sql})" for n, sql in more]
    return "WITH " + ",\n".join(parts) + "\n"


READ_MODEL_TABLES = [
    "concept_name", "concept_set", "encounter_type", "program", "program_workflow", "program_workflow_state",
    "person", "patient", "encounter", "patient_program", "patient_state", "obs", "drug", "orders", "drug_order",
]


def _ids(*names: str) -> str:
    wanted = ", ".join("'" + n.lower().replace("'", "''") + "'" for n in names)
    return f"(SELECT concept_id FROM fx_concept_name WHERE lower(rtrim(name)) IN ({wanted}))"


_YES, _NO = _ids("YES"), _ids("NO")


def _either(*names: str) -> str:
    return f"(concept_id IN {_ids(*names)} AND value_coded IN {_YES}) OR value_coded IN {_ids(*names)}"


_NAME_OF_CODED = (
    "(SELECT name FROM fx_concept_name c WHERE c.concept_id = o.value_coded ORDER BY concept_name_id LIMIT 1)"
)
_NAME_BY_ID = (
    "(SELECT min(name) FROM fx_concept_name c WHERE c.concept_name_id = o.value_coded_name_id)"
)
_OBS_FACTS = [
    ("visit", "TRUE", None),
    ("pregnant", f"concept_id IN {_ids('IS PATIENT PREGNANT?')} AND value_coded IN {_YES}", None),
    ("reason", f"concept_id IN {_ids('Reason for ART eligibility')}",
     f"CASE WHEN value_coded_name_id IS NULL THEN {_NAME_OF_CODED} ELSE {_NAME_BY_ID} END"),
    ("tb", _either("Pulmonary TB (current)"), None),
    ("tb2", _either("Pulmonary tuberculosis within the last 2 years"), None),
    ("ks", _either("Karposi's sarcoma", "Kaposis sarcoma"), None),
    ("regimen", f"concept_id IN {_ids('Regimen Category')} AND visit = 'dispensing'", "value_text"),
    ("side", f"concept_id IN {_ids('Drug induced')} AND visit = 'hiv clinic consultation'", None),
    ("missed", f"concept_id IN {_ids('Missed antiretroviral drug construct')} "
     "AND visit IN ('art adherence', 'hiv clinic consultation')", "CAST(value_numeric AS VARCHAR)"),
    ("status", f"concept_id IN {_ids('TB status')} AND visit = 'hiv clinic consultation'", _NAME_OF_CODED),
    ("off", "visit = 'hiv clinic registration' AND ("
     f"(concept_id IN {_ids('Has the patient taken ART in the last two months')} "
     f"AND (value_coded IN {_NO} OR lower(rtrim(value_text)) = 'no')) OR "
     f"(concept_id IN {_ids('Date ART last taken')} "
     "AND date_diff('day', CAST(value_datetime AS DATE), CAST(obs_datetime AS DATE)) / 30.0 > 2))", None),
    ("moved_in", "visit = 'hiv clinic registration' "
     f"AND concept_id IN {_ids('Date antiretrovirals started')} "
     "AND coalesce(CAST(value_datetime AS DATE), TRY_CAST(value_text AS DATE)) IS NOT NULL",
     "CAST(coalesce(CAST(value_datetime AS DATE), TRY_CAST(value_text AS DATE)) AS VARCHAR)"),
]
_STATES = """
    SELECT pp.patient_id AS pid, CAST(s.start_date AS TIMESTAMP) AS tm, s.patient_state_id AS id,
      (SELECT name FROM fx_concept_name c WHERE c.concept_id = w.concept_id ORDER BY concept_name_id LIMIT 1) AS nm,
      w.concept_id IN """ + _ids("On antiretrovirals") + """ AS starts, w.concept_id IN """ + _ids("Treatment stopped") + """ AS stops,
      pw.program_id IN (SELECT program_id FROM fx_program WHERE concept_id IN """ + _ids("HIV PROGRAM") + """) AS hiv
    FROM fx_patient_state s JOIN fx_patient_program pp USING (patient_program_id)
    LEFT JOIN fx_program_workflow_state w ON w.program_workflow_state_id = s.state
    LEFT JOIN fx_program_workflow pw USING (program_workflow_id)"""
_DRUGS = f"""
    SELECT r.patient_id AS pid, r.start_date AS tm, r.order_id AS id,
      r.auto_expire_date + to_days(CAST(round(g.quantity / nullif(coalesce(g.equivalent_daily_dose, 1), 0)) AS INT)) AS expires
    FROM fx_drug_order g JOIN fx_orders r USING (order_id) JOIN fx_drug d ON d.drug_id = g.drug_inventory_id
    WHERE g.quantity > 0 AND (d.concept_id IN (792, 1610, 1613, 2988, 7994, 1612) OR d.concept_id IN
      (SELECT concept_id FROM fx_concept_name WHERE concept_id IN
        (SELECT concept_id FROM fx_concept_set WHERE concept_set IN {_ids('Arvs')})))"""


def _facts() -> str:
    parts = [
        f"SELECT '{k}' AS k, person_id AS pid, obs_datetime AS tm, obs_id AS id, {v or 'NULL'} AS v FROM obs_seen o WHERE {c}"
        for k, c, v in _OBS_FACTS
    ]
    parts += [
        "SELECT 'state', pid, tm, id, nm FROM state_seen",
        "SELECT 'stop', pid, tm, id, NULL FROM state_seen WHERE hiv AND stops",
        "SELECT 'start', pid, tm, id, NULL FROM state_seen WHERE hiv AND starts",
        "SELECT 'expiry', pid, tm, id, CAST(expires AS VARCHAR) FROM drug_seen",
        "SELECT 'death', person_id, date_created, person_id, CAST(death_date AS VARCHAR) FROM fx_person WHERE dead = 1",
    ]
    return "\nUNION ALL ".join(parts)


_OBS_SEEN = """
    SELECT o.*, lower(rtrim(t.name)) AS visit FROM fx_obs o LEFT JOIN fx_encounter e USING (encounter_id)
    LEFT JOIN fx_encounter_type t ON t.encounter_type_id = e.encounter_type"""


def _pivot(keys: str) -> str:
    def at(k):
        return f"max(CASE WHEN k = '{k}' AND newest = 1 THEN tm END)"

    def val(k, kind="VARCHAR"):
        return f"max(CASE WHEN k = '{k}' AND newest = 1 THEN CAST(v AS {kind}) END)"

    return f"""SELECT {keys},
      {at('pregnant')} AS preg, {val('reason')} AS reason_for_art_eligibility,
      {at('tb')} AS current_episode_of_tb, {at('tb2')} AS tb_within_the_last_2_years, {at('ks')} AS karposis_sarcoma,
      {val('death', 'TIMESTAMP')} AS death_date, {val('expiry', 'TIMESTAMP')} AS expiry_date_for_last_arvs,
      {at('stop')} AS arv_drugs_stopped, {val('state')} AS latest_state, {at('state')} AS latest_state_date,
      {val('regimen')} AS latest_regimen, {at('regimen')} AS latest_regimen_date, {at('side')} AS latest_side_effects,
      {at('visit')} AS last_visit_date, CAST(round({val('missed', 'DOUBLE')}) AS BIGINT) AS missed_drugs_count,
      {at('missed')} AS last_missed_drugs_date, {val('status')} AS tb_status, {at('status')} AS tb_status_date,
      {at('off')} AS patient_did_not_take_arvs_in_last_two_months,
      {at('moved_in')} AS moved_at, {val('moved_in', 'DATE')} AS moved_start,
      max(CASE WHEN k = 'start' AND oldest = 1 THEN tm END) AS first_start"""


def _ranked(keys: str) -> str:
    return f"""SELECT *, row_number() OVER (PARTITION BY k, {keys} ORDER BY tm DESC, id DESC) AS newest,
      row_number() OVER (PARTITION BY k, {keys} ORDER BY tm, id) AS oldest FROM facts"""


_DETAIL = """reason_for_art_eligibility, current_episode_of_tb, tb_within_the_last_2_years, karposis_sarcoma,
    death_date, expiry_date_for_last_arvs, arv_drugs_stopped, latest_state, latest_state_date, latest_regimen,
    latest_regimen_date, latest_side_effects, last_visit_date, missed_drugs_count, last_missed_drugs_date,
    tb_status, tb_status_date, patient_did_not_take_arvs_in_last_two_months"""

READ_MODEL = [
    ("obs_seen", _OBS_SEEN),
    ("state_seen", _STATES),
    ("drug_seen", _DRUGS),
    ("facts", "SELECT k, pid, tm, id, v, CAST(date_trunc('quarter', tm) AS DATE) AS q FROM (" + _facts() + ") f"),
    ("by_patient", _pivot("pid") + f" FROM ({_ranked('pid')}) GROUP BY pid"),
    ("by_quarter", _pivot("pid, q") + f" FROM ({_ranked('pid, q')}) GROUP BY pid, q"),
    ("started", f"""
        SELECT pt.patient_id, coalesce(b.moved_start, CAST(b.first_start AS DATE)) AS art_start_date,
          CASE WHEN b.moved_at IS NOT NULL THEN date_diff('day', pe.birthdate, b.moved_start)
               WHEN b.first_start IS NOT NULL THEN date_diff('day', pe.birthdate, DATE '{AS_OF}') END
            / CAST(365 AS DOUBLE) AS age_initiation,
          coalesce(b.moved_at, b.first_start) AS registration_date, pe.birthdate AS birth_date, pe.gender,
          b.* EXCLUDE (pid)
        FROM fx_patient pt LEFT JOIN fx_person pe ON pe.person_id = pt.patient_id
        LEFT JOIN by_patient b ON b.pid = pt.patient_id"""),
    ("p", f"""
        SELECT patient_id, art_start_date, age_initiation, registration_date, birth_date, gender,
          CASE WHEN art_start_date IS NOT NULL THEN preg END AS patient_pregnant_date, {_DETAIL} FROM started"""),
    ("d", f"""
        SELECT q.pid AS patient_id, q.q AS quarter_start, s.art_start_date, s.age_initiation, s.registration_date,
          CASE WHEN s.art_start_date IS NOT NULL THEN q.preg END AS patient_pregnant_date,
          {', '.join('q.' + c.strip() for c in _DETAIL.split(','))}
        FROM by_quarter q LEFT JOIN started s ON s.patient_id = q.pid"""),
]


def by_arrival(select: str) -> str:
    """The same with the last arrival winning, rows arriving by ``id * 7919 mod 100003``."""
    arrived = "((id * 7919) % 100003)"
    queries = [
        (n, q.replace("ORDER BY tm DESC,", f"ORDER BY {arrived} DESC,").replace("ORDER BY tm,", f"ORDER BY {arrived},"))
        for n, q in READ_MODEL
    ]
    return with_tables(READ_MODEL_TABLES, *queries) + select


def read_model(select: str, *more: tuple[str, str]) -> str:
    """``select`` over the read-model tables ``p`` and ``d``."""
    return with_tables(READ_MODEL_TABLES, *READ_MODEL, *more) + select
