"""The report's indicators as conditions over the two read-model tables.

Conditions are SQL over a report row ``p`` and a detail row ``d``, kept to the
letter: ``<`` against ``<=``, day comparison against midnight comparison, which
table a column comes from, and what NULL does. Those over details read "some
quarter row of the patient satisfies this".

``{name}`` in a condition stands for a term of ``REPORT_TERMS`` or
``DETAIL_TERMS``. A single figure has its terms spelled out in place; the whole
report computes each term once per row and lets the conditions share it.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

# State names.
ON_ART = "On antiretrovirals"
DIED = "Patient died"
TRANSFERRED = "Patient transferred out"
STOPPED = "Treatment stopped"
# Reason texts.
PRESUMED = "PRESUMED SEVERE HIV"
PCR_LONG = "HIV DNA POLYMERASE CHAIN REACTION"
PCR_SHORT = "HIV PCR"
CD4_350 = "CD4 COUNT LESS THAN OR EQUAL TO 350"
CD4_750 = "CD4 COUNT LESS THAN OR EQUAL TO 750"
LYMPHOCYTES = "LYMPHOCYTE COUNT BELOW THRESHOLD WITH WHO STAGE 2"
INFECTED = "HIV infected"
BREASTFEEDING = "Breastfeeding"
PREGNANT = "PATIENT PREGNANT"
STAGE_3 = "WHO STAGE III"
STAGE_4 = "WHO STAGE IV"
# Days.
DEFAULT_AFTER_DAYS = 60
MONTH_ENDS = (30, 60, 90)


def sql_day(value) -> str:
    """A day as a SQL literal."""
    return f"DATE'{value}'"


def key(column: str) -> str:
    """Comparison key of a text: case and trailing blanks do not count."""
    return f"lower(rtrim({column}))"


def texts(*values: str) -> str:
    return "(" + ", ".join("'" + v.rstrip().lower().replace("'", "\\'") + "'" for v in values) + ")"


# At or before 00:00 of the last day; later on that day does not count.
MIDNIGHT = "<= CAST({end} AS TIMESTAMP_NTZ)"

# Term name -> SQL with {start} and {end}; later terms may use earlier ones.
REPORT_TERMS: dict[str, str] = {
    "registered": "to_date(p.registration_date) <= {end}",
    "in_period": "to_date(p.registration_date) BETWEEN {start} AND {end}",
    "first_time": "to_date(p.registration_date) = p.art_start_date",
    "off_treatment": "p.patient_did_not_take_arvs_in_last_two_months IS NOT NULL",
    "gender": key("p.gender"),
    "reason": key("coalesce(p.reason_for_art_eligibility, '')"),
    "died": f"{key('p.latest_state')} IN {texts(DIED)}",
    "days": "datediff(p.latest_state_date, p.art_start_date)",
}
DETAIL_TERMS: dict[str, str] = {
    "registered": "to_date(p.registration_date) <= {end}",
    "in_period": "to_date(p.registration_date) BETWEEN {start} AND {end}",
    "state": key("d.latest_state"),
    "stated": f"d.latest_state_date {MIDNIGHT}",
    "stopped": f"(d.arv_drugs_stopped IS NOT NULL AND d.arv_drugs_stopped {MIDNIGHT})",
    # last visit two months or more past the last expiry known for the patient
    "overdue": "(coalesce(datediff(d.last_visit_date, p.expiry_date_for_last_arvs), 0) "
    f">= {DEFAULT_AFTER_DAYS} AND to_date(p.expiry_date_for_last_arvs) <= {{end}})",
    "on_art": f"({{state}} IN {texts(ON_ART)} AND {{stated}})",
    # on treatment at the end of the period as far as this quarter row says
    "alive": f"(NOT (({{state}} IN {texts(DIED)} AND {{stated}}) OR ({{state}} IN {texts(TRANSFERRED)} AND {{stated}}) "
    "OR {stopped} OR {overdue}) AND {on_art})",
    "tested": "to_date(d.tb_status_date) <= {end}",
    "status": key("coalesce(d.tb_status, 'Unknown')"),
    "regimen": key("coalesce(d.latest_regimen, 'Nn')"),
    "missed": "coalesce(d.missed_drugs_count, 0)",
    "counted": f"(d.last_missed_drugs_date IS NULL OR d.last_missed_drugs_date {MIDNIGHT})",
}


@dataclass(frozen=True)
class Indicator:
    """``condition`` holds beside the common part: on treatment and registered."""

    name: str
    new_only: bool
    on_details: bool
    condition: str

    def sql(self, terms: Mapping[str, str]) -> str:
        common = "{in_period}" if self.new_only else "{registered}"
        return f"(p.art_start_date IS NOT NULL AND {common} AND ({self.condition}))".format_map(terms)

    def spelled_out(self, start: str, end: str) -> str:
        return self.sql(spelled_out(DETAIL_TERMS if self.on_details else REPORT_TERMS, start, end))


def spelled_out(terms: Mapping[str, str], start: str, end: str) -> dict[str, str]:
    """Every term as SQL over ``p`` and ``d`` alone."""
    known = {"start": start, "end": end}
    for name, text in terms.items():
        known[name] = text.format_map(known)
    return known


# Both a period and a cumulative figure; over the report table alone.
_PAIRED_REPORT: dict[str, str] = {
    "total_reg": "TRUE",
    "ft": "{first_time}",
    "re": "NOT ({first_time}) AND {off_treatment}",
    "ti": "NOT ({first_time}) AND NOT ({off_treatment})",
    "males": "{gender} = 'm'",
    "non_preg": "{gender} = 'f' AND p.patient_pregnant_date IS NULL",
    "preg_all_age": "{gender} = 'f' AND p.patient_pregnant_date IS NOT NULL",
    "a": "p.age_initiation < 2",
    "b": "p.age_initiation BETWEEN 2 AND 14",
    "c": "p.age_initiation > 14",
    "unk_age": "coalesce(p.age_initiation, 0D) = 0D",
    "pres_hiv": f"{{reason}} IN {texts(PRESUMED)}",
    "conf_hiv": f"{{reason}} IN {texts(PCR_LONG, PCR_SHORT)}",
    "who_1_2": f"{{reason}} IN {texts(CD4_350, CD4_750)}",
    "who_2": f"{{reason}} IN {texts(LYMPHOCYTES)}",
    "children": f"{{reason}} IN {texts(INFECTED)}",
    "breastfeed": f"{{reason}} IN {texts(BREASTFEEDING)}",
    "preg": f"{{reason}} IN {texts(PREGNANT)}",
    "who_3": f"{{reason}} LIKE '{STAGE_3.lower()}%'",
    "who_4": f"{{reason}} LIKE '{STAGE_4.lower()}%'",
    # the short PCR text is not among the excluded ones
    "other_reason": f"NOT ({{reason}} IN "
    + texts(PRESUMED, PCR_LONG, INFECTED, CD4_350, CD4_750, LYMPHOCYTES, BREASTFEEDING, PREGNANT, "")
    + f" OR {{reason}} LIKE '{STAGE_3.lower()}%' OR {{reason}} LIKE '{STAGE_4.lower()}%')",
}

# Both figures; over some detail row.
_PAIRED_DETAILS: dict[str, str] = {
    "no_tb": "d.current_episode_of_tb IS NULL AND d.tb_within_the_last_2_years IS NULL",
    "tb_w2yrs": "d.current_episode_of_tb IS NULL AND to_date(d.tb_within_the_last_2_years) <= {end}",
    "current_tb": "to_date(d.current_episode_of_tb) <= {end}",
    "ks": "to_date(d.karposis_sarcoma) <= {end}",
}

# Cumulative only; over the report table alone.
_OUTCOME_REPORT: dict[str, str] = {
    "died_1st_month": f"coalesce({{days}}, 31) <= {MONTH_ENDS[0]} AND {{died}}",
    "died_2nd_month": f"coalesce({{days}}, 31) > {MONTH_ENDS[0]} AND coalesce({{days}}, 61) <= {MONTH_ENDS[1]} AND {{died}}",
    "died_3rd_month": f"coalesce({{days}}, 31) > {MONTH_ENDS[1]} AND coalesce({{days}}, 91) <= {MONTH_ENDS[2]} AND {{died}}",
    "died_after_3rd_month": f"coalesce({{days}}, 0) > {MONTH_ENDS[2]} AND {{died}}",
    "died_total": "{died} AND to_date(p.latest_state_date) < {end}",
}

# Regimen columns and TB status texts of the report.
REGIMENS = ("1A", "1P", "2A", "2P", "3A", "3P", "4A", "4P", "5A", "6A", "7A", "8A", "9P")
TB_STATUS = {
    "tb_no_suspect": ("TB NOT suspected", "Nosup"),
    "tb_suspected": ("TB suspected", "sup"),
    "tb_confirm_not_treat": ("Confirmed TB not on treatment", "Norx"),
    "tb_confirmed": ("Confirmed TB on treatment", "RX"),
    "unknown_tb": ("Unknown",),
}

# Cumulative only; over some detail row.
_OUTCOME_DETAILS: dict[str, str] = {
    "total_on_art": "{alive}",
    "defaulted": "{overdue} AND {on_art}",
    "stopped": "d.arv_drugs_stopped IS NOT NULL AND to_date(d.arv_drugs_stopped) <= {end}",
    "transfered": f"to_date(d.latest_state_date) <= {{end}} AND {{state}} IN {texts(TRANSFERRED)}",
    # none of the known outcomes; an arm that is NULL leaves the row out
    "unknown_outcome": f"NOT (({{state}} IN {texts(DIED)} AND {{stated}}) OR ({{state}} IN {texts(TRANSFERRED)} AND {{stated}}) "
    "OR {stopped} OR (datediff(d.last_visit_date, d.expiry_date_for_last_arvs) "
    f">= {DEFAULT_AFTER_DAYS} AND to_date(d.expiry_date_for_last_arvs) < {{end}}) "
    f"OR {{on_art}} OR ({{state}} IN {texts(STOPPED)} AND {{stated}}))",
    **{f"n{text.lower()}": f"{{alive}} AND {{regimen}} IN {texts(text)}" for text in REGIMENS},
    "non_std": f"{{alive}} AND {{regimen}} IN {texts('Nn')}",
    **{name: f"{{alive}} AND {{tested}} AND {{status}} IN {texts(*wanted)}" for name, wanted in TB_STATUS.items()},
    "side_effects": f"{{alive}} AND d.latest_side_effects {MIDNIGHT}",
    "missed_0_6": "{alive} AND {missed} <= 6 AND {counted}",
    "missed_7plus": "{alive} AND {missed} >= 7 AND {counted}",
}


def _registry() -> dict[str, Indicator]:
    found: list[Indicator] = []
    for on_details, paired, single in (
        (False, _PAIRED_REPORT, _OUTCOME_REPORT),
        (True, _PAIRED_DETAILS, _OUTCOME_DETAILS),
    ):
        for name, condition in paired.items():
            found.append(Indicator(f"new_{name}", True, on_details, condition))
            found.append(Indicator(f"cum_{name}", False, on_details, condition))
        found += [Indicator(name, False, on_details, condition) for name, condition in single.items()]
    return {i.name: i for i in found}


INDICATORS: dict[str, Indicator] = _registry()
