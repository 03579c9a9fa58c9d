"""Target-side clinical tables."""

from __future__ import annotations

# Reason texts by quantity mod 12, cases mixed on purpose.
REASON_TEXTS = (
    "PRESUMED SEVERE HIV",
    "HIV PCR",
    "HIV DNA POLYMERASE CHAIN REACTION",
    "CD4 COUNT LESS THAN OR EQUAL TO 350",
    "CD4 COUNT LESS THAN OR EQUAL TO 750",
    "LYMPHOCYTE COUNT BELOW THRESHOLD WITH WHO STAGE 2",
    "HIV Infected",
    "BREASTFEEDING",
    "PATIENT PREGNANT",
    "WHO stage III adult",
    "WHO STAGE IV PEDS",
    "UNKNOWN",
)
# Concepts the rules look up by name (id, name).
NAMED_CONCEPTS = (
    (1065, "YES"),
    (1066, "NO"),
    (6131, "IS PATIENT PREGNANT?"),
    (7563, "Reason for ART eligibility"),
    (8206, "Pulmonary TB (current)"),
    (7539, "Pulmonary tuberculosis within the last 2 years"),
    (507, "Kaposis sarcoma"),
    (2559, "Regimen Category"),
    (7755, "Drug induced"),
    (2667, "Missed antiretroviral drug construct"),
    (7459, "TB status"),
    (7752, "Has the patient taken ART in the last two months"),
    (7751, "Date ART last taken"),
    (2516, "Date antiretrovirals started"),
    (7882, "HIV PROGRAM"),
    (7883, "TB PROGRAM"),
    (1085, "Arvs"),
    (7001, "First treatment drug"),
    (7002, "Second treatment drug"),
    (7003, "Third treatment drug"),
    (1742, "Patient died"),
    (1744, "Patient transferred out"),
    (1579, "Treatment stopped"),
    (7012, "Pre-ART (Continue)"),
    (7010, "On antiretrovirals"),
    (7454, "TB NOT suspected"),
    (7455, "TB suspected"),
    (7456, "Confirmed TB not on treatment"),
    (7458, "Confirmed TB on treatment"),
    (1067, "Unknown"),
    (1576, "Antiretroviral treatment status"),
)
# Visit types (id, name).
VISIT_TYPES = (
    (9, "HIV CLINIC REGISTRATION"),
    (52, "HIV STAGING"),
    (53, "HIV CLINIC CONSULTATION"),
    (54, "DISPENSING"),
    (68, "ART ADHERENCE"),
)
# Programmes (program id, concept id).
PROGRAMS = ((1, 7882), (2, 7883))
# Workflow states (state id, concept id).
WORKFLOW_STATES = ((1, 7012), (2, 1744), (3, 1742), (6, 1579), (7, 7010))
# Regimen texts by quantity mod 17, the last one missing.
REGIMEN_TEXTS = (
    "1A", "1P", "2A", "2P", "3A", "3P", "4A", "4P", "5A", "6A", "7A", "8A", "9P", "P1", "9A", "Nn",
)
REASON_BASE = 9001


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _cases(pairs, subject: str, otherwise: str = "NULL") -> str:
    arms = " ".join(f"WHEN {k} THEN {v}" for k, v in pairs)
    return f"CASE {subject} {arms} ELSE {otherwise} END"


def _values(rows, columns: str) -> str:
    body = ", ".join("(" + ", ".join(str(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) AS v({columns})"


_names = [(cid, _quoted(n), cid * 10) for cid, n in NAMED_CONCEPTS]
_names += [(REASON_BASE + i, _quoted(n), (REASON_BASE + i) * 10) for i, n in enumerate(REASON_TEXTS)]
# a second spelling of each reason: other case and a trailing blank
_names += [
    (REASON_BASE + i, _quoted(n.swapcase() + " "), (REASON_BASE + i) * 10 + 1)
    for i, n in enumerate(REASON_TEXTS)
]

# an earlier synonym of the programme: the name looked for isn't the first one
_names += [(7882, "'Programme one'", 5)]

TARGET_SIDE: dict[str, str] = {
    "concept_name": (
        "SELECT CAST(concept_id AS BIGINT) AS concept_id, name, "
        "CAST(concept_name_id AS BIGINT) AS concept_name_id FROM ("
        + _values(_names, "concept_id, name, concept_name_id") + ") n"
    ),
    "concept_set": (
        "SELECT CAST(concept_id AS BIGINT) AS concept_id, CAST(concept_set AS BIGINT) AS concept_set FROM ("
        + _values([(7001, 1085), (7002, 1085), (7003, 1085)], "concept_id, concept_set") + ") s"
    ),
    "encounter_type": (
        "SELECT CAST(encounter_type_id AS BIGINT) AS encounter_type_id, name FROM ("
        + _values([(i, _quoted(n)) for i, n in VISIT_TYPES], "encounter_type_id, name") + ") t"
    ),
    "program": (
        "SELECT CAST(p AS BIGINT) AS program_id, CAST(c AS BIGINT) AS concept_id FROM ("
        + _values(PROGRAMS, "p, c") + ") t"
    ),
    "program_workflow": (
        "SELECT CAST(p AS BIGINT) AS program_workflow_id, CAST(p AS BIGINT) AS program_id FROM ("
        + _values(PROGRAMS, "p, c") + ") t"
    ),
    "program_workflow_state": (
        "SELECT CAST(state_id AS BIGINT) AS program_workflow_state_id, CAST(1 AS BIGINT) AS program_workflow_id, "
        "CAST(concept_id AS BIGINT) AS concept_id FROM ("
        + _values(WORKFLOW_STATES, "state_id, concept_id") + ") s"
    ),
    "global_property": (
        "SELECT * FROM (VALUES ('current_health_center_name', '  mulanje   district HOSPITAL '), "
        "('default_locale', 'en')) AS v(property, property_value)"
    ),
    "person": """
        SELECT c_custkey AS person_id,
          CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
          CASE WHEN c_custkey % 17 = 0 THEN NULL
               ELSE DATE '1950-01-01' + CAST((c_custkey * 7919) % 16500 AS INT) END AS birthdate,
          CASE WHEN c_custkey % 5 = 0 THEN 1 ELSE 0 END AS birthdate_estimated,
          CASE WHEN c_custkey % 11 = 0 THEN 1 ELSE 0 END AS dead,
          CASE WHEN c_custkey % 11 = 0 THEN
            CAST(DATE '1995-01-01' + CAST((c_custkey * 31) % 2400 + c_custkey % 900 AS INT) AS {ts}) END AS death_date,
          CAST(c_nationkey AS BIGINT) + 1 AS creator,
          CAST(DATE '1995-01-01' + CAST((c_custkey * 31) % 2400 AS INT) AS {ts}) AS date_created,
          0 AS voided
        FROM {raw_customer}""",
    "patient": """
        SELECT c_custkey AS patient_id, CAST(c_nationkey AS BIGINT) + 1 AS creator,
          CAST(DATE '1995-01-01' + CAST((c_custkey * 31) % 2400 AS INT) AS {ts}) AS date_created, 0 AS voided
        FROM {raw_customer}""",
    "person_address": """
        SELECT c_custkey * 10 + 1 AS person_address_id, c_custkey AS person_id, c_mktsegment AS city_village
        FROM {raw_customer} WHERE c_custkey % 4 <> 0""",
    "person_attribute": """
        SELECT c_custkey * 10 + k AS person_attribute_id, c_custkey AS person_id, k AS person_attribute_type_id, c_name AS value
        FROM {raw_customer} CROSS JOIN (SELECT * FROM (VALUES (CAST(1 AS BIGINT)), (CAST(2 AS BIGINT))) AS v(k)) two""",
    "person_name": """
        SELECT c_custkey * 10 + 2 AS person_name_id, c_custkey AS person_id, c_name AS given_name, c_mktsegment AS family_name
        FROM {raw_customer}""",
    "person_name_code": """
        SELECT person_name_id * 10 + 3 AS person_name_code_id, person_name_id, substr(given_name, 1, 4) AS given_name_code
        FROM {person_name} WHERE person_id % 3 <> 0""",
    "patient_identifier": """
        SELECT c_custkey * 10 + 4 AS patient_identifier_id, c_custkey AS patient_id, c_name AS identifier
        FROM {raw_customer} WHERE c_custkey % 5 <> 0""",
    "encounter": f"""
        SELECT o_orderkey AS encounter_id, o_custkey AS patient_id, o_orderdate AS encounter_datetime,
          CAST({_cases([("'1-URGENT'", 9), ("'2-HIGH'", 52), ("'3-MEDIUM'", 53),
                        ("'4-NOT SPECIFIED'", 54), ("'5-LOW'", 68)], "o_orderpriority")} AS BIGINT) AS encounter_type,
          CASE WHEN o_orderkey % 43 = 0 THEN 1 ELSE 0 END AS voided
        FROM {{raw_orders}}""",
    "patient_program": """
        SELECT c_custkey AS patient_program_id, c_custkey AS patient_id, CAST(1 AS BIGINT) AS program_id,
          CAST(DATE '1995-01-01' + CAST((c_custkey * 31) % 2400 + 7 AS INT) AS {ts}) AS date_enrolled,
          CAST(DATE '1995-01-01' + CAST((c_custkey * 31) % 2400 AS INT) AS {ts}) AS date_created,
          CASE WHEN c_custkey % 47 = 0 THEN 1 ELSE 0 END AS voided
        FROM {raw_customer}
        UNION ALL
        SELECT CAST(3000000000 AS BIGINT) + c_custkey AS patient_program_id, c_custkey AS patient_id, CAST(1 AS BIGINT) AS program_id,
          CAST(DATE '1995-01-01' + CAST((c_custkey * 31) % 2400 - 30 AS INT) AS {ts}) AS date_enrolled,
          CAST(DATE '1995-01-01' + CAST((c_custkey * 31) % 2400 AS INT) AS {ts}) AS date_created, 0 AS voided
        FROM {raw_customer} WHERE c_custkey % 4 = 1""",
    "patient_state": f"""
        SELECT o_orderkey AS patient_state_id,
          CASE WHEN o_custkey % 4 = 1 AND o_orderkey % 3 = 0 THEN CAST(3000000000 AS BIGINT) ELSE CAST(0 AS BIGINT) END + o_custkey
            AS patient_program_id,
          CAST({_cases([(0, 3), (1, 2), (2, 6), (3, 1)], "o_orderkey % 10", "7")} AS BIGINT) AS state,
          CAST(o_orderdate AS DATE) AS start_date,
          CASE WHEN o_orderkey % 41 = 0 THEN 1 ELSE 0 END AS voided
        FROM {{raw_orders}} WHERE o_custkey % 6 <> 0
        UNION ALL
        SELECT CAST(1000000000 AS BIGINT) + 2 * o_custkey AS patient_state_id, o_custkey AS patient_program_id,
          CAST(7 AS BIGINT) AS state, sd AS start_date, 0 AS voided
        FROM {{first_art}}
        UNION ALL
        SELECT CAST(1000000001 AS BIGINT) + 2 * o_custkey AS patient_state_id, o_custkey AS patient_program_id,
          CAST(3 AS BIGINT) AS state, sd + CAST(o_custkey % 120 AS INT) AS start_date, 0 AS voided
        FROM {{first_art}}""",
    "first_art": """
        SELECT o_custkey, CAST(MIN(o_orderdate) AS DATE) AS sd FROM {raw_orders}
        WHERE o_custkey % 6 = 0 AND o_orderkey % 10 >= 4 GROUP BY o_custkey""",
    "li": """
        SELECT l_orderkey, l_linenumber, MAX(l_shipdate) AS dt, CAST(MAX(l_quantity) AS INT) AS q,
          MIN(l_partkey) AS pk
        FROM {raw_lineitem} GROUP BY l_orderkey, l_linenumber""",
    "visit_item": """
        SELECT l_orderkey * 10 + l_linenumber AS obs_id, o_custkey AS person_id, l_orderkey AS encounter_id,
          dt, q, pk, l_linenumber, o_orderpriority,
          CASE WHEN pk % 24 < 12 THEN pk % 24 WHEN pk % 24 < 18 THEN 5 ELSE 8 END AS k
        FROM {li} JOIN {raw_orders} ON l_orderkey = o_orderkey""",
    "obs": f"""
        SELECT obs_id, person_id,
          CAST({_cases([(0, 6131), (1, 7563), (2, 8206), (3, 7539), (4, 507), (5, 2559), (6, 7755), (7, 2667),
                        (8, 7459), (9, 7752), (10, 7751), (11, 2516)], "k")} AS BIGINT) AS concept_id,
          encounter_id, dt AS obs_datetime,
          CAST(CASE WHEN k IN (0, 2, 3, 4, 9) THEN CASE WHEN q % 2 = 0 THEN 1065 ELSE 1066 END
               WHEN k = 1 THEN {REASON_BASE} + q % 12
               WHEN k = 8 THEN {_cases([(0, 7454), (1, 7455), (2, 7456), (3, 7458), (4, 1067)], "q % 6")}
          END AS BIGINT) AS value_coded,
          CAST(CASE WHEN k = 1 AND q % 5 < 2 THEN ({REASON_BASE} + q % 12) * 10 + q % 5 END AS BIGINT)
            AS value_coded_name_id,
          CASE WHEN k = 10 THEN CAST(CAST(dt AS DATE) + CAST(-3 * q AS INT) AS {{ts}})
               WHEN k = 11 AND q % 8 <> 0 THEN CAST(CAST(dt AS DATE) + CAST(-20 * q AS INT) AS {{ts}})
          END AS value_datetime,
          CAST(q % 12 AS DOUBLE) AS value_numeric,
          CASE WHEN k = 5 THEN {_cases([(i, _quoted(t)) for i, t in enumerate(REGIMEN_TEXTS)], "q % 17")}
               WHEN k = 11 AND q % 8 = 0 THEN CAST(CAST(dt AS DATE) + CAST(-20 * q AS INT) AS VARCHAR(10))
          END AS value_text,
          CASE WHEN obs_id % 37 = 0 THEN 1 ELSE 0 END AS voided
        FROM {{visit_item}}""",
    "drug": """
        SELECT p_partkey AS drug_id,
          CAST(CASE WHEN p_type = 'PROMO' THEN 1610 WHEN p_type = 'SMALL' THEN 7001 + p_partkey % 3 ELSE 5000 END
            AS BIGINT) AS concept_id, p_name AS name
        FROM {raw_part}""",
    "drug_item": """
        SELECT obs_id AS order_id, person_id AS patient_id, encounter_id, dt, q, pk, l_linenumber
        FROM {visit_item} WHERE o_orderpriority = '4-NOT SPECIFIED'""",
    "orders": """
        SELECT order_id, patient_id, encounter_id, dt AS start_date,
          CASE WHEN q % 9 = 0 THEN NULL ELSE CAST(CAST(dt AS DATE) + q AS {ts}) END AS auto_expire_date,
          dt AS date_created
        FROM {drug_item}""",
    "drug_order": """
        SELECT order_id, pk AS drug_inventory_id, q AS quantity,
          CAST(CASE WHEN q % 7 = 0 THEN NULL ELSE 1 + l_linenumber % 3 END AS DOUBLE)
            AS equivalent_daily_dose
        FROM {drug_item}""",
}
