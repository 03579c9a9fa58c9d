"""Source-side tables of a migration."""

from __future__ import annotations

from quarterfold.fixtures.target_side import _cases, _quoted, _values

# Source concepts (id, name, target id; None = not in the map).
SOURCE_CONCEPTS = (
    (2, "Unknown", 1067),
    (3, "Yes", 1065),
    (4, "No", 1066),
    (13, "CD4 count done", 0),
    (14, "CD4 count", 5497),
    (23, "Lymphocyte count", 952),
    (24, "WHO stage 4 peds", 1223),
    (25, "WHO stage 3 adult", 7047),
    (26, "WHO stage 3 peds", 1222),
    (27, "WHO stage 4 adult", 7048),
    (28, "Antiretroviral treatment status", 1576),
    (37, "WHO stage 2 adult", 1205),
    (135, "WHO Stage 2 peds", 1221),
    (91, "Peripheral neuropathy", 821),
    (92, "Hepatitis", 29),
    (93, "Skin rash", 512),
    (96, "Anaemia", 3),
    (288, "Severe unexplained wasting / malnutrition not responding to treatment"
          "(weight-for-height/ -age less than 70% or MUAC less than 11cm or oedema)", 3068),
    (321, "CD4 count < 250", 2543),
    (322, "Died", 1742),
    (325, "Transfer out", 1744),
    (328, "Pregnant", 1755),
    (346, "Lymphocyte count below threshold with WHO stage 2", 7559),
    (386, "ART Stop", 1579),
    (390, "On ART", 7010),
    (391, "Child HIV positive", 9101),
    (392, "CD4 count < 750", 9102),
    (407, "Yes drug induced", 1581),
    (408, "Yes not drug induced", 0),
    (450, "Regimen one", 9450),
    (462, "First positive HIV Test", 6395),
    (463, "PCR Test", 844),
    (464, "Rapid Test", 3657),
    (465, "Presumed HIV Disease", 0),
    (467, "Candidiasis of oesophagus", 5340),
    (471, "Pneumocystis pneumonia", 882),
    (472, "Cryptococcal meningitis", 1359),
    (474, "Oral thrush", 5334),
    (475, "Sepsis, severe", 7554),
    (476, "Pneumonia, severe", 7555),
    (504, "Toxoplasmosis of the brain (from age 1 month)", 2583),
    (646, "CD4 count < 350", 7031),
    (801, "Breastfeeding", 834),
    (910, "Stage two sign", 9910),
    (911, "Stage three sign", 9911),
    (912, "Stage four sign", 9912),
    (999, "Left out of the map", None),
)
# Members of the stage sets (member, set).
STAGE_MEMBERS = (
    (910, 37), (910, 135), (911, 25), (911, 26), (912, 27), (912, 24), (467, 24), (467, 27), (474, 26),
)
# Source visit types.
SOURCE_VISITS = (
    (1, "HIV FIRST VISIT"), (2, "HIV Staging"), (3, "ART VISIT"), (4, "Give Drugs"), (5, "HEIGHT/WEIGHT"),
    (6, "GENERAL RECEPTION"), (7, "BARCODE SCAN"), (8, "TB RECEPTION"), (9, "REFFERED"),
    (10, "DATE OF ART INITIATION"), (11, "Unlisted visit"), (12, "UPDATE OUTCOME"),
)
# Target visit types the recode can reach.
TARGET_VISITS = (
    (9, "HIV CLINIC REGISTRATION"), (53, "HIV CLINIC CONSULTATION"), (54, "DISPENSING"), (56, "ART ENROLLMENT"),
    (6, "VITALS"), (5, "REGISTRATION"), (60, "TB CLINIC VISIT"), (61, "IS PATIENT REFERRED?"),
)
# Identifier types of the source and the target of either kind.
IDENTIFIER_TYPES = (
    (1, "National id"), (2, "Occupation"), (3, "Cell phone number"), (4, "ARV Number"), (5, "Physical address"),
    (6, "Traditional authority"), (7, "Old number"), (8, "Home phone number"), (9, "Office phone number"),
    (10, "Pre ART number"), (11, "Filing number"), (12, "Dormant filing number"),
)
TARGET_IDENTIFIER_TYPES = ((3, "National id"), (4, "ARV Number"), (17, "Filing number"), (22, "Pre ART Number"))
TARGET_ATTRIBUTE_TYPES = (
    (12, "Cell Phone Number"), (13, "Occupation"), (14, "Home Phone Number"), (15, "Office Phone Number"),
    (19, "Physical Address"),
)
# What an observation asks, by part key mod 32.
_ASKED = (
    (0, 14), (1, 14), (2, 23), (3, 328), (4, 801), (5, 462), (6, 471), (7, 467), (8, 472), (9, 288), (10, 504),
    (11, 474), (12, 475), (13, 476), (14, 910), (15, 910), (16, 911), (17, 912), (18, 28), (19, 28), (20, 91),
    (21, 92), (22, 93), (23, 96), (24, 392), (25, 999), (26, 13), (27, 14), (28, 910), (29, 462), (30, 91), (31, 2),
)
# Drug concepts by drug id mod 12.
_DRUG_CONCEPTS = (
    (0, 450), (1, 451), (2, 452), (3, 458), (4, 826), (5, 827), (6, 828), (7, 829), (8, 453), (9, 5000), (10, 5001),
    (11, 450),
)

_DAY = "CAST(DATE '1995-01-01' + CAST((c_custkey * 31) % 2400 AS INT) AS {ts})"


def _named(rows, key: str) -> str:
    return (
        f"SELECT CAST(i AS BIGINT) AS {key}, name FROM ("
        + _values([(i, _quoted(n)) for i, n in rows], "i, name") + ") t"
    )


SOURCE_SIDE: dict[str, str] = {
    "src_concept": _named([(i, n) for i, n, _ in SOURCE_CONCEPTS], "concept_id"),
    "src_concept_set": (
        "SELECT CAST(m AS BIGINT) AS concept_id, CAST(s AS BIGINT) AS concept_set FROM ("
        + _values(STAGE_MEMBERS, "m, s") + ") t"
    ),
    "concept_map": (
        "SELECT CAST(i AS BIGINT) AS old_concept_id, name AS old_concept_name, CAST(n AS BIGINT) AS new_concept_id FROM ("
        + _values([(i, _quoted(n), t) for i, n, t in SOURCE_CONCEPTS if t is not None], "i, name, n") + ") t"
    ),
    "src_encounter_type": _named(SOURCE_VISITS, "encounter_type_id"),
    "dst_encounter_type": _named(TARGET_VISITS, "encounter_type_id"),
    "src_identifier_type": _named(IDENTIFIER_TYPES, "patient_identifier_type_id"),
    "dst_identifier_type": _named(TARGET_IDENTIFIER_TYPES, "patient_identifier_type_id"),
    "dst_attribute_type": _named(TARGET_ATTRIBUTE_TYPES, "person_attribute_type_id"),
    "src_users": """
        SELECT CAST(n_nationkey AS BIGINT) + 1 AS user_id, lower(n_name) AS username,
          concat('pw', CAST(n_nationkey AS VARCHAR(9))) AS password, concat('s', CAST(n_regionkey AS VARCHAR(9))) AS salt,
          'question' AS secret_question, 'answer' AS secret_answer, n_name AS first_name,
          CASE WHEN n_nationkey % 3 = 0 THEN 'M' END AS middle_name,
          concat('User', CAST(n_nationkey AS VARCHAR(9))) AS last_name,
          CAST(n_nationkey % 5 + 1 AS BIGINT) AS creator,
          CAST(DATE '1994-01-01' + n_nationkey AS {ts}) AS date_created,
          CAST(CASE WHEN n_nationkey % 4 = 0 THEN n_nationkey % 3 + 1 END AS BIGINT) AS changed_by,
          CASE WHEN n_nationkey % 4 = 0 THEN CAST(DATE '1994-06-01' AS {ts}) END AS date_changed,
          CASE WHEN n_nationkey % 7 = 0 THEN 1 ELSE 0 END AS voided,
          CAST(CASE WHEN n_nationkey % 7 = 0 THEN 2 END AS BIGINT) AS voided_by,
          CASE WHEN n_nationkey % 7 = 0 THEN CAST(DATE '1994-09-01' AS {ts}) END AS date_voided,
          CASE WHEN n_nationkey % 7 = 0 THEN 'left' END AS void_reason
        FROM {raw_nation}""",
    "src_patient": f"""
        SELECT c_custkey AS patient_id,
          CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
          CASE WHEN c_custkey % 17 = 0 THEN NULL
               WHEN c_custkey % 15 = 0 THEN CAST(concat(CAST(1985 + c_custkey % 13 AS VARCHAR(4)), '-07-01') AS DATE)
               WHEN c_custkey % 3 = 0 THEN DATE '1992-03-01' + CAST((c_custkey * 7919) % 3200 AS INT)
               ELSE DATE '1950-01-01' + CAST((c_custkey * 7919) % 16500 AS INT) END AS birthdate,
          CASE WHEN c_custkey % 5 = 0 THEN 1 ELSE 0 END AS birthdate_estimated,
          CASE WHEN c_custkey % 11 = 0 THEN 1 ELSE 0 END AS dead,
          CASE WHEN c_custkey % 11 = 0 THEN
            CAST(DATE '1995-01-01' + CAST((c_custkey * 31) % 2400 + c_custkey % 900 AS INT) AS {{ts}}) END AS death_date,
          CAST(CASE WHEN c_custkey % 22 = 0 THEN 43 END AS BIGINT) AS cause_of_death,
          CAST(c_nationkey % 7 AS BIGINT) AS tribe,
          CAST(CASE WHEN c_custkey % 29 = 0 THEN 900 ELSE c_nationkey + 1 END AS BIGINT) AS creator,
          {_DAY} AS date_created,
          CAST(CASE WHEN c_custkey % 3 = 0 THEN c_nationkey + 1 END AS BIGINT) AS changed_by,
          CASE WHEN c_custkey % 3 = 0 THEN {_DAY} END AS date_changed,
          CASE WHEN c_custkey % 19 = 0 THEN 1 ELSE 0 END AS voided,
          CAST(CASE WHEN c_custkey % 19 = 0 THEN 3 END AS BIGINT) AS voided_by,
          CASE WHEN c_custkey % 19 = 0 THEN {_DAY} END AS date_voided,
          CASE WHEN c_custkey % 19 = 0 THEN 'duplicate' END AS void_reason
        FROM {{raw_customer}}""",
    "src_person": """
        SELECT c_custkey + 5000000 AS person_id, c_custkey AS patient_id FROM {raw_customer} WHERE c_custkey % 23 <> 0""",
    "src_relationship": f"""
        SELECT c_custkey AS relationship_id, c_custkey + 5000000 AS person_id,
          (c_custkey * 7) % 1000 + 5000000 AS relative_id, CAST(c_custkey % 10 AS BIGINT) AS relationship,
          CAST(c_nationkey + 1 AS BIGINT) AS creator, {_DAY} AS date_created, 0 AS voided,
          CAST(NULL AS BIGINT) AS voided_by, CAST(NULL AS {{ts}}) AS date_voided, CAST(NULL AS VARCHAR(9)) AS void_reason
        FROM {{raw_customer}}""",
    "src_patient_address": f"""
        SELECT c_custkey * 3 AS patient_address_id, c_custkey AS patient_id, 1 AS preferred, c_name AS address1,
          CASE WHEN c_custkey % 4 = 0 THEN c_mktsegment END AS address2, c_mktsegment AS city_village,
          CAST(NULL AS VARCHAR(9)) AS state_province, CAST(c_nationkey AS VARCHAR(9)) AS postal_code, 'MW' AS country,
          CAST(NULL AS VARCHAR(9)) AS latitude, CAST(NULL AS VARCHAR(9)) AS longitude,
          CAST(c_nationkey + 1 AS BIGINT) AS creator, {_DAY} AS date_created, 0 AS voided,
          CAST(NULL AS BIGINT) AS voided_by, CAST(NULL AS {{ts}}) AS date_voided, CAST(NULL AS VARCHAR(9)) AS void_reason
        FROM {{raw_customer}} WHERE c_custkey % 8 <> 1""",
    "src_patient_name": f"""
        SELECT c_custkey + 7000000 AS patient_name_id, c_custkey AS patient_id, 1 AS preferred, CAST(NULL AS VARCHAR(9)) AS prefix,
          c_name AS given_name,
          CASE WHEN c_custkey % 3 = 0 THEN 'J' END AS middle_name, CAST(NULL AS VARCHAR(9)) AS family_name_prefix,
          c_mktsegment AS family_name, CAST(NULL AS VARCHAR(9)) AS family_name2,
          CAST(NULL AS VARCHAR(9)) AS family_name_suffix, CAST(NULL AS VARCHAR(9)) AS degree,
          CAST(c_nationkey + 1 AS BIGINT) AS creator, {_DAY} AS date_created, 0 AS voided,
          CAST(NULL AS BIGINT) AS voided_by, CAST(NULL AS {{ts}}) AS date_voided, CAST(NULL AS VARCHAR(9)) AS void_reason,
          CAST(CASE WHEN c_custkey % 5 = 0 THEN 900 END AS BIGINT) AS changed_by, CAST(NULL AS {{ts}}) AS date_changed
        FROM {{raw_customer}}
        UNION ALL
        SELECT c_custkey + 8000000 AS patient_name_id, c_custkey AS patient_id, 0 AS preferred, CAST(NULL AS VARCHAR(9)) AS prefix,
          c_name AS given_name, 'second' AS middle_name, CAST(NULL AS VARCHAR(9)) AS family_name_prefix,
          c_mktsegment AS family_name, CAST(NULL AS VARCHAR(9)) AS family_name2,
          CAST(NULL AS VARCHAR(9)) AS family_name_suffix, CAST(NULL AS VARCHAR(9)) AS degree,
          CAST(c_nationkey + 1 AS BIGINT) AS creator, {_DAY} AS date_created, 1 AS voided,
          CAST(2 AS BIGINT) AS voided_by, {_DAY} AS date_voided, 'duplicate' AS void_reason,
          CAST(NULL AS BIGINT) AS changed_by, CAST(NULL AS {{ts}}) AS date_changed
        FROM {{raw_customer}} WHERE c_custkey % 6 = 0""",
    "src_patient_identifier": f"""
        SELECT c_custkey AS patient_id, concat('I', CAST(c_custkey AS VARCHAR(12))) AS identifier,
          CAST(c_custkey % 12 + 1 AS BIGINT) AS identifier_type, 0 AS preferred, CAST(c_nationkey AS BIGINT) AS location_id,
          CAST(c_nationkey + 1 AS BIGINT) AS creator, {_DAY} AS date_created, 0 AS voided,
          CAST(NULL AS BIGINT) AS voided_by, CAST(NULL AS {{ts}}) AS date_voided, CAST(NULL AS VARCHAR(9)) AS void_reason
        FROM {{raw_customer}}
        UNION ALL
        SELECT c_custkey AS patient_id, concat('P', CAST(c_custkey AS VARCHAR(12))) AS identifier,
          CAST(1 AS BIGINT) AS identifier_type, 1 AS preferred, CAST(c_nationkey AS BIGINT) AS location_id,
          CAST(900 AS BIGINT) AS creator, {_DAY} AS date_created, 0 AS voided,
          CAST(NULL AS BIGINT) AS voided_by, CAST(NULL AS {{ts}}) AS date_voided, CAST(NULL AS VARCHAR(9)) AS void_reason
        FROM {{raw_customer}} WHERE c_custkey % 2 = 0
        UNION ALL
        SELECT c_custkey AS patient_id, concat('T', CAST(c_custkey AS VARCHAR(12))) AS identifier, t AS identifier_type,
          0 AS preferred, CAST(c_nationkey AS BIGINT) AS location_id, CAST(c_nationkey + 1 AS BIGINT) AS creator, {_DAY} AS date_created,
          0 AS voided, CAST(NULL AS BIGINT) AS voided_by, CAST(NULL AS {{ts}}) AS date_voided, CAST(NULL AS VARCHAR(9)) AS void_reason
        FROM {{raw_customer}} CROSS JOIN (SELECT * FROM (VALUES (CAST(3 AS BIGINT)), (CAST(8 AS BIGINT))) AS v(t)) two
        WHERE c_custkey % 5 = 0""",
    "src_patient_program": f"""
        SELECT c_custkey AS patient_program_id, c_custkey AS patient_id, CAST(1 AS BIGINT) AS program_id,
          {_DAY} AS date_enrolled, CAST(NULL AS {{ts}}) AS date_completed, CAST(c_nationkey + 1 AS BIGINT) AS creator,
          {_DAY} AS date_created, CAST(NULL AS BIGINT) AS changed_by, CAST(NULL AS {{ts}}) AS date_changed, 0 AS voided,
          CAST(NULL AS BIGINT) AS voided_by, CAST(NULL AS {{ts}}) AS date_voided, CAST(NULL AS VARCHAR(9)) AS void_reason
        FROM {{raw_customer}} WHERE c_custkey % 9 <> 0
        UNION ALL
        SELECT c_custkey + 1000000000 AS patient_program_id, c_custkey AS patient_id, CAST(1 AS BIGINT) AS program_id,
          {_DAY} AS date_enrolled, CAST(NULL AS {{ts}}) AS date_completed, CAST(900 AS BIGINT) AS creator,
          CAST(DATE '2001-01-01' AS {{ts}}) AS date_created, CAST(NULL AS BIGINT) AS changed_by,
          CAST(NULL AS {{ts}}) AS date_changed, 0 AS voided,
          CAST(NULL AS BIGINT) AS voided_by, CAST(NULL AS {{ts}}) AS date_voided, CAST(NULL AS VARCHAR(9)) AS void_reason
        FROM {{raw_customer}} WHERE c_custkey % 10 = 0""",
    "src_encounter": f"""
        SELECT o_orderkey AS encounter_id, o_custkey AS patient_id,
          CAST({_cases([("'1-URGENT'", 1), ("'2-HIGH'", 2), ("'3-MEDIUM'", 3), ("'4-NOT SPECIFIED'", 4)],
                       "o_orderpriority", "5 + o_orderkey % 8")} AS BIGINT) AS encounter_type,
          CAST(o_orderkey % 25 + 1 AS BIGINT) AS provider_id, CAST(o_orderkey % 7 AS BIGINT) AS location_id,
          CAST(NULL AS BIGINT) AS form_id,
          CASE WHEN o_custkey % 9 = 4 THEN CAST(CAST(o_orderdate AS DATE) + 6200 AS {{ts}}) ELSE o_orderdate END AS encounter_datetime,
          CAST(o_orderkey % 26 + 1 AS BIGINT) AS creator,
          CAST(CAST(o_orderdate AS DATE) + 1 AS {{ts}}) AS date_created,
          CASE WHEN o_orderkey % 31 = 0 THEN 1 ELSE 0 END AS voided,
          CAST(CASE WHEN o_orderkey % 31 = 0 THEN o_orderkey % 30 + 1 END AS BIGINT) AS voided_by,
          CASE WHEN o_orderkey % 31 = 0 THEN CAST(CAST(o_orderdate AS DATE) + 2 AS {{ts}}) END AS date_voided,
          CASE WHEN o_orderkey % 31 = 0 THEN 'entered twice' END AS void_reason,
          CAST(CASE WHEN o_orderkey % 4 = 0 THEN o_orderkey % 28 + 1 END AS BIGINT) AS changed_by,
          CASE WHEN o_orderkey % 4 = 0 THEN CAST(CAST(o_orderdate AS DATE) + 4 AS {{ts}}) END AS date_changed
        FROM {{raw_orders}}""",
    "src_obs": f"""
        SELECT obs_id, person_id AS patient_id, CAST({_cases(_ASKED, "pk % 32")} AS BIGINT) AS concept_id,
          encounter_id, CAST(NULL AS BIGINT) AS order_id, dt AS obs_datetime, CAST(pk % 7 AS BIGINT) AS location_id,
          CAST(CASE WHEN pk % 32 IN (0, 1, 27) THEN CASE WHEN q % 2 = 0 THEN 3 END
                    WHEN pk % 32 IN (5, 29) THEN CASE WHEN q % 2 = 0 THEN 463 ELSE 464 END
                    WHEN pk % 32 IN (18, 19) THEN {_cases([(0, 322), (1, 325), (2, 386)], "q % 5", "390")}
                    WHEN pk % 32 IN (20, 21, 22, 23, 30) THEN {_cases([(0, 3), (1, 4), (2, 407), (3, 408)], "q % 6", "2")}
                    WHEN pk % 32 IN (2, 26, 31) THEN NULL
                    WHEN q % 2 = 0 THEN 3 ELSE 4 END AS BIGINT) AS value_coded,
          CASE WHEN pk % 32 IN (18, 19) THEN dt END AS value_datetime,
          CAST(CASE WHEN pk % 32 IN (0, 1, 27) THEN q * 20 WHEN pk % 32 = 2 THEN q * 100 ELSE q END AS DOUBLE) AS value_numeric,
          CASE WHEN pk % 32 = 31 THEN 'note' END AS value_text,
          CAST(obs_id % 26 + 1 AS BIGINT) AS creator, dt AS date_created,
          CASE WHEN obs_id % 37 = 0 THEN 1 ELSE 0 END AS voided,
          CAST(CASE WHEN obs_id % 37 = 0 THEN 5 END AS BIGINT) AS voided_by,
          CASE WHEN obs_id % 37 = 0 THEN CAST(CAST(dt AS DATE) + 9 AS {{ts}}) END AS date_voided,
          CASE WHEN obs_id % 37 = 0 THEN 'mistaken' END AS void_reason,
          CAST(CASE WHEN obs_id % 5 = 0 THEN obs_id - 1 END AS BIGINT) AS obs_group_id,
          CASE WHEN obs_id % 6 = 0 THEN concat('A', CAST(obs_id AS VARCHAR(12))) END AS accession_number,
          CAST(CASE WHEN obs_id % 7 = 0 THEN obs_id % 11 END AS BIGINT) AS value_group_id,
          CASE WHEN obs_id % 3 = 0 THEN CAST(obs_id % 2 AS INT) END AS value_boolean,
          CAST(CASE WHEN obs_id % 9 = 0 THEN pk END AS BIGINT) AS value_drug,
          CASE WHEN obs_id % 8 = 0 THEN '<' WHEN obs_id % 8 = 1 THEN '>' END AS value_modifier,
          CASE WHEN obs_id % 10 = 0 THEN dt END AS date_started,
          CASE WHEN obs_id % 10 = 0 THEN CAST(CAST(dt AS DATE) + q AS {{ts}}) END AS date_stopped,
          CASE WHEN obs_id % 12 = 0 THEN 'remark' END AS comments
        FROM {{visit_item}}""",
    "src_drug": f"""
        SELECT CAST(p_partkey AS BIGINT) AS drug_id, CAST({_cases(_DRUG_CONCEPTS, "p_partkey % 12")} AS BIGINT) AS concept_id,
          p_name AS name
        FROM {{raw_part}}""",
    "src_orders": """
        SELECT order_id, CAST(1 AS BIGINT) AS order_type_id, CAST(q AS BIGINT) AS concept_id,
          CAST(order_id % 26 + 1 AS BIGINT) AS orderer, encounter_id, CAST(NULL AS VARCHAR(9)) AS instructions,
          CASE WHEN q % 5 = 0 THEN NULL ELSE dt END AS start_date,
          CASE WHEN q % 3 = 0 THEN CAST(CAST(dt AS DATE) + q AS {ts}) END AS auto_expire_date,
          CASE WHEN order_id % 19 = 0 THEN 1 ELSE 0 END AS discontinued, CAST(order_id % 26 + 1 AS BIGINT) AS creator, dt AS date_created,
          CASE WHEN order_id % 53 = 0 THEN 1 ELSE 0 END AS voided,
          CAST(CASE WHEN order_id % 53 = 0 THEN 4 END AS BIGINT) AS voided_by,
          CASE WHEN order_id % 53 = 0 THEN CAST(CAST(dt AS DATE) + 3 AS {ts}) END AS date_voided,
          CASE WHEN order_id % 53 = 0 THEN 'wrong drug' END AS void_reason,
          CASE WHEN order_id % 19 = 0 THEN CAST(CAST(dt AS DATE) + 5 AS {ts}) END AS discontinued_date,
          CAST(CASE WHEN order_id % 19 = 0 THEN order_id % 27 + 1 END AS BIGINT) AS discontinued_by,
          CAST(CASE WHEN order_id % 19 = 0 THEN 407 END AS BIGINT) AS discontinued_reason
        FROM {drug_item}""",
    "src_drug_order": """
        SELECT order_id, pk AS drug_inventory_id, CAST(1 AS DOUBLE) AS dose,
          'tabs' AS units, 'OD' AS frequency, 0 AS prn, 0 AS complex, q AS quantity
        FROM {drug_item}""",
    "src_prescription_totals": """
        SELECT person_id AS patient_id, pk AS drug_id, CAST(o_orderdate AS DATE) AS prescription_date,
          CAST(MAX(l_linenumber % 3) AS DOUBLE) AS daily_consumption
        FROM {visit_item} JOIN {raw_orders} ON encounter_id = o_orderkey WHERE q % 2 = 0
        GROUP BY person_id, pk, CAST(o_orderdate AS DATE)""",
    "obs_edit_audit": """
        SELECT o_orderkey * 10 + 1 AS obs_id FROM {raw_orders} WHERE o_orderkey % 4 = 0""",
}
