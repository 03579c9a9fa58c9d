"""SQL for checking the report: one separate count per figure.

Conditions over ``p`` stand alone; those over details read ``pd``, a detail row
with the report columns of its patient prefixed ``p_``. ``:S`` and ``:E`` are
the first and last day.
"""

from __future__ import annotations

from checks.sql_readmodel import read_model, with_tables

_NEW = "CAST(registration_date AS DATE) >= :S AND CAST(registration_date AS DATE) <= :E AND art_start_date IS NOT NULL"
_CUM = "CAST(registration_date AS DATE) <= :E AND art_start_date IS NOT NULL"
_NEW_D = _NEW.replace("registration_date", "p_registration_date").replace("art_start_date", "p_art_start_date")
_CUM_D = _CUM.replace("registration_date", "p_registration_date").replace("art_start_date", "p_art_start_date")
_TEXT = "lower(rtrim(coalesce(reason_for_art_eligibility, '')))"
_FT = "CAST(registration_date AS DATE) = art_start_date"

_PAIRS = {
    "total_reg": "TRUE",
    "ft": _FT,
    "re": f"NOT {_FT} AND patient_did_not_take_arvs_in_last_two_months IS NOT NULL",
    "ti": f"NOT {_FT} AND patient_did_not_take_arvs_in_last_two_months IS NULL",
    "males": "upper(gender) = 'M'",
    "non_preg": "upper(gender) = 'F' AND patient_pregnant_date IS NULL",
    "preg_all_age": "upper(gender) = 'F' AND patient_pregnant_date IS NOT NULL",
    "a": "age_initiation < 2",
    "b": "age_initiation >= 2 AND age_initiation <= 14",
    "c": "age_initiation > 14",
    "unk_age": "(age_initiation IS NULL OR age_initiation = 0)",
    "pres_hiv": f"{_TEXT} = 'presumed severe hiv'",
    "conf_hiv": f"({_TEXT} = 'hiv dna polymerase chain reaction' OR {_TEXT} = 'hiv pcr')",
    "who_1_2": f"({_TEXT} = 'cd4 count less than or equal to 350' OR {_TEXT} = 'cd4 count less than or equal to 750')",
    "who_2": f"{_TEXT} = 'lymphocyte count below threshold with who stage 2'",
    "children": f"{_TEXT} = 'hiv infected'",
    "breastfeed": f"{_TEXT} = 'breastfeeding'",
    "preg": f"{_TEXT} = 'patient pregnant'",
    "who_3": "reason_for_art_eligibility ILIKE 'WHO STAGE III%'",
    "who_4": "reason_for_art_eligibility ILIKE 'WHO STAGE IV%'",
    "other_reason": f"""NOT ({_TEXT} = 'presumed severe hiv' OR {_TEXT} = 'hiv dna polymerase chain reaction'
        OR {_TEXT} = 'hiv infected' OR {_TEXT} = 'cd4 count less than or equal to 350'
        OR {_TEXT} = 'cd4 count less than or equal to 750'
        OR {_TEXT} = 'lymphocyte count below threshold with who stage 2' OR {_TEXT} = 'breastfeeding'
        OR {_TEXT} = 'patient pregnant' OR {_TEXT} LIKE 'who stage iii%' OR {_TEXT} LIKE 'who stage iv%' OR {_TEXT} = '')""",
}
_PAIRS_D = {
    "no_tb": "current_episode_of_tb IS NULL AND tb_within_the_last_2_years IS NULL",
    "tb_w2yrs": "current_episode_of_tb IS NULL AND CAST(tb_within_the_last_2_years AS DATE) <= :E",
    "current_tb": "CAST(current_episode_of_tb AS DATE) <= :E",
    "ks": "CAST(karposis_sarcoma AS DATE) <= :E",
}


def _gap(other: int) -> str:
    return f"coalesce(date_diff('day', art_start_date, CAST(latest_state_date AS DATE)), {other})"


_DIED = "lower(latest_state) = 'patient died'"
_OUTCOMES = {
    "died_1st_month": f"{_gap(31)} <= 30 AND {_DIED}",
    "died_2nd_month": f"{_gap(31)} > 30 AND {_gap(61)} <= 60 AND {_DIED}",
    "died_3rd_month": f"{_gap(31)} > 60 AND {_gap(91)} <= 90 AND {_DIED}",
    "died_after_3rd_month": f"{_gap(0)} > 90 AND {_DIED}",
    "died_total": f"{_DIED} AND CAST(latest_state_date AS DATE) < :E",
}
_MIDNIGHT = "<= CAST(:E AS TIMESTAMP)"
_ON_ART = f"(lower(latest_state) = 'on antiretrovirals' AND latest_state_date {_MIDNIGHT})"
_LATE = """(CASE WHEN p_expiry IS NOT NULL AND last_visit_date IS NOT NULL
    THEN date_diff('day', CAST(p_expiry AS DATE), CAST(last_visit_date AS DATE)) ELSE 0 END >= 60
    AND CAST(p_expiry AS DATE) <= :E)"""
_ALIVE = f"""NOT ((lower(latest_state) = 'patient died' AND latest_state_date {_MIDNIGHT})
    OR (lower(latest_state) = 'patient transferred out' AND latest_state_date {_MIDNIGHT})
    OR (arv_drugs_stopped IS NOT NULL AND arv_drugs_stopped {_MIDNIGHT}) OR {_LATE}) AND {_ON_ART}"""
_TESTED = "CAST(tb_status_date AS DATE) <= :E"
_OUTCOMES_D = {
    "total_on_art": _ALIVE,
    "defaulted": f"{_LATE} AND {_ON_ART}",
    "stopped": "CASE WHEN arv_drugs_stopped IS NOT NULL THEN CAST(arv_drugs_stopped AS DATE) <= :E ELSE FALSE END",
    "transfered": "CAST(latest_state_date AS DATE) <= :E AND lower(latest_state) = 'patient transferred out'",
    "unknown_outcome": f"""NOT ((lower(latest_state) = 'patient died' AND latest_state_date {_MIDNIGHT})
        OR (lower(latest_state) = 'patient transferred out' AND latest_state_date {_MIDNIGHT})
        OR (arv_drugs_stopped IS NOT NULL AND arv_drugs_stopped {_MIDNIGHT})
        OR (date_diff('day', CAST(expiry_date_for_last_arvs AS DATE), CAST(last_visit_date AS DATE)) >= 60
            AND CAST(expiry_date_for_last_arvs AS DATE) < :E)
        OR {_ON_ART} OR (lower(latest_state) = 'treatment stopped' AND latest_state_date {_MIDNIGHT}))""",
    **{
        "n" + r.lower(): f"{_ALIVE} AND upper(latest_regimen) = '{r}'"
        for r in ("1A", "1P", "2A", "2P", "3A", "3P", "4A", "4P", "5A", "6A", "7A", "8A", "9P")
    },
    "non_std": f"{_ALIVE} AND lower(coalesce(latest_regimen, 'Nn')) = 'nn'",
    "tb_no_suspect": f"{_ALIVE} AND {_TESTED} AND lower(tb_status) IN ('tb not suspected', 'nosup')",
    "tb_suspected": f"{_ALIVE} AND {_TESTED} AND lower(tb_status) IN ('tb suspected', 'sup')",
    "tb_confirm_not_treat": f"{_ALIVE} AND {_TESTED} AND lower(tb_status) IN ('confirmed tb not on treatment', 'norx')",
    "tb_confirmed": f"{_ALIVE} AND {_TESTED} AND lower(tb_status) IN ('confirmed tb on treatment', 'rx')",
    "unknown_tb": f"{_ALIVE} AND {_TESTED} AND lower(coalesce(tb_status, 'Unknown')) = 'unknown'",
    "side_effects": f"{_ALIVE} AND latest_side_effects {_MIDNIGHT}",
    "missed_0_6": f"{_ALIVE} AND coalesce(missed_drugs_count, 0) <= 6 "
    f"AND coalesce(last_missed_drugs_date, TIMESTAMP '0001-01-01') {_MIDNIGHT}",
    "missed_7plus": f"{_ALIVE} AND coalesce(missed_drugs_count, 0) >= 7 "
    f"AND coalesce(last_missed_drugs_date, TIMESTAMP '0001-01-01') {_MIDNIGHT}",
}

# figure -> (table, condition)
FIGURES: dict[str, tuple[str, str]] = {}
for _n, _c in _PAIRS.items():
    FIGURES[f"new_{_n}"] = ("p", f"{_NEW} AND {_c}")
    FIGURES[f"cum_{_n}"] = ("p", f"{_CUM} AND {_c}")
for _n, _c in _PAIRS_D.items():
    FIGURES[f"new_{_n}"] = ("pd", f"{_NEW_D} AND {_c}")
    FIGURES[f"cum_{_n}"] = ("pd", f"{_CUM_D} AND {_c}")
FIGURES |= {n: ("p", f"{_CUM} AND {c}") for n, c in _OUTCOMES.items()}
FIGURES |= {n: ("pd", f"{_CUM_D} AND {c}") for n, c in _OUTCOMES_D.items()}

_PD = ("pd", """
    SELECT d.* EXCLUDE (art_start_date, registration_date, age_initiation), p.art_start_date AS p_art_start_date,
      p.registration_date AS p_registration_date, p.expiry_date_for_last_arvs AS p_expiry
    FROM d LEFT JOIN p USING (patient_id)""")


def _bounded(condition: str, start: str, end: str) -> str:
    return condition.replace(":S", start).replace(":E", end)


def figure(name: str, start: str, end: str) -> str:
    table, condition = FIGURES[name]
    where = _bounded(condition, f"DATE '{start}'", f"DATE '{end}'")
    return read_model(f"SELECT count(DISTINCT patient_id) AS value FROM {table} WHERE {where}", _PD)


def report(start: str, end: str, cells) -> str:
    parts = []
    for name, position, line, label, which in cells:
        table, condition = FIGURES[name]
        where = _bounded(condition, f"DATE '{start}'", f"DATE '{end}'")
        parts.append(
            f"SELECT CAST({position} AS BIGINT) AS position, CAST({'NULL' if line is None else line} AS BIGINT) AS line, "
            f"'{label}' AS label, '{which}' AS figure, '{name}' AS indicator, "
            f"(SELECT count(DISTINCT patient_id) FROM {table} WHERE {where}) AS value"
        )
    return read_model("\nUNION ALL ".join(parts), _PD)


def _of_periods(periods: str) -> str:
    """All figures of the periods ``(s, e)`` of a query."""
    parts = [
        f"SELECT q.s AS start_date, q.e AS end_date, '{name}' AS indicator, count(DISTINCT t.patient_id) AS value "
        f"FROM periods q LEFT JOIN {table} t ON {_bounded(condition, 'q.s', 'q.e')} GROUP BY q.s, q.e"
        for name, (table, condition) in FIGURES.items()
    ]
    return read_model("\nUNION ALL ".join(parts), _PD, ("periods", periods))


def all_quarters(from_year: int, to_year: int) -> str:
    return _of_periods(f"""
        SELECT CAST(s AS DATE) AS s, CAST(s + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS e
        FROM generate_series(TIMESTAMP '{from_year}-01-01', TIMESTAMP '{to_year}-10-01', INTERVAL 3 MONTH) g(s)""")


PERIODS = _of_periods("""
    SELECT DISTINCT CAST(date_trunc('year', encounter_datetime) AS DATE) AS s,
      CAST(date_trunc('year', encounter_datetime) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE) AS e FROM fx_encounter
    UNION ALL SELECT DISTINCT CAST(date_trunc('quarter', encounter_datetime) AS DATE),
      CAST(date_trunc('quarter', encounter_datetime) + INTERVAL 99 DAY AS DATE) FROM fx_encounter""")
CALENDAR = read_model("""
    SELECT CAST(s AS DATE) AS start_date, CAST(s + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS end_date,
      (SELECT count(*) FROM p WHERE date_trunc('quarter', registration_date) = s) AS registered
    FROM generate_series((SELECT CAST(date_trunc('year', min(registration_date)) AS TIMESTAMP) FROM p),
      (SELECT date_trunc('year', max(registration_date)) + INTERVAL 9 MONTH FROM p), INTERVAL 3 MONTH) g(s)""")


_LABEL = """CASE WHEN date_trunc('quarter', s) = date_trunc('quarter', e)
    THEN year(s) || ' - ' || CASE quarter(s) WHEN 1 THEN '1st' WHEN 2 THEN '2nd' WHEN 3 THEN '3rd' ELSE '4th' END || ' Quarter'
    ELSE strftime(s, '%d/%b/%Y') || ' to ' || strftime(e, '%d/%b/%Y') END AS period"""
_SITE = """(SELECT array_to_string(list_transform(regexp_split_to_array(trim(property_value), '\\s+'),
    lambda w: upper(w[1]) || lower(w[2:])), ' ') FROM fx_global_property WHERE property = 'current_health_center_name') AS site"""
_TABLES = ["global_property", "encounter"]
HEADER = with_tables(_TABLES) + f"""SELECT {_SITE}, {_LABEL} FROM (
    SELECT CAST(min(encounter_datetime) AS DATE) AS s, CAST(max(encounter_datetime) AS DATE) AS e FROM fx_encounter)"""
HEADERS = with_tables(_TABLES) + f"""SELECT s, e, {_SITE}, {_LABEL} FROM (
    SELECT DISTINCT CAST(date_trunc('quarter', encounter_datetime) AS DATE) AS s,
      CAST(date_trunc('quarter', encounter_datetime) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS e FROM fx_encounter)"""
