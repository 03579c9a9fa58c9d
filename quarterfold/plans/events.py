"""Clinical tables to fold-ready events.

Each source row becomes one event ``(patient_id, at, <slots>)``. A slot is the
candidate value of one read-model column, NULL when the row says nothing about
it. Slots carry their own ordering key, so "the last one wins" is a plain
``max`` (``min`` for the first treatment start): it combines on the map side,
and applying the same event twice changes nothing.

Ordering: by ``(event time, row id)``, or with ``arrival`` set by that column
of the source tables (the last row to arrive wins, whatever its date).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, functions as F

from quarterfold.operators.lookups import Dictionary, arv_drugs, concept_roles
from quarterfold.operators.mapping import left_lookup
from quarterfold.operators.rows import dealt

# SQL condition of a slot, alone or with the SQL of its value.
Rule = str | tuple[str, str]

# Concept names each rule looks for.
CONCEPT_ROLES: Mapping[str, tuple[str, ...]] = {
    "pregnant": ("IS PATIENT PREGNANT?",),
    "reason": ("Reason for ART eligibility",),
    "tb": ("Pulmonary TB (current)",),
    "tb_two_years": ("Pulmonary tuberculosis within the last 2 years",),
    "kaposi": ("Karposi's sarcoma", "Kaposis sarcoma"),
    "regimen": ("Regimen Category",),
    "side_effect": ("Drug induced",),
    "missed": ("Missed antiretroviral drug construct",),
    "tb_status": ("TB status",),
    "taken": ("Has the patient taken ART in the last two months",),
    "last_taken": ("Date ART last taken",),
    "started": ("Date antiretrovirals started",),
    "yes": ("YES",),
    "no": ("NO",),
}
# Rules that also look at the type of the visit.
VISIT_GATED = ("regimen", "side_effect", "missed", "tb_status", "taken", "last_taken", "started")
# Visit types the rules look for.
VISIT_ROLES: Mapping[str, tuple[str, ...]] = {
    "dispensing": ("DISPENSING",),
    "consultation": ("HIV CLINIC CONSULTATION",),
    "adherence": ("ART ADHERENCE",),
    "registration": ("HIV CLINIC REGISTRATION",),
}
# Drug concepts that count as antiretrovirals beside the named set.
ARV_SET = "Arvs"
ARV_CONCEPTS = (792, 1610, 1613, 2988, 7994, 1612)
# Workflow names.
PROGRAM = "HIV PROGRAM"
STATE_ROLES: Mapping[str, tuple[str, ...]] = {"started": ("On antiretrovirals",), "stopped": ("Treatment stopped",)}

# Slot name -> type of the value kept beside its time; None keeps the time only.
SLOTS: Mapping[str, str | None] = {
    "last_visit": None,
    "pregnant": None,
    "tb": None,
    "tb_two_years": None,
    "kaposi": None,
    "side_effects": None,
    "not_on_art": None,
    "stopped": None,
    "reason": "struct<coded: bigint, name_id: bigint>",
    "regimen": "string",
    "missed": "double",
    "tb_status": "bigint",
    "state": "bigint",
    "expiry": "timestamp_ntz",
    "death": "timestamp_ntz",
    "transfer_in": "date",
    "first_start": None,
}
FIRST_WINS = ("first_start",)


@dataclass(frozen=True)
class Ordering:
    """How competing events are ranked.

    ``arrival`` and ``version`` name columns of the source tables. ``version``
    tells apart an update from the row it updates: same time and id, the
    higher version wins.
    """

    arrival: str | None = None
    version: str | None = None

    def _fields(self, slot: str) -> dict[str, str]:
        """Fields of a slot in ranking order, with their types."""
        ranked = {"at": "timestamp_ntz", "id": "bigint"}
        if self.arrival:
            ranked = {"seq": "bigint", "id": "bigint", "at": "timestamp_ntz"}
        elif self.version:
            ranked["ver"] = "bigint"
        return ranked | ({"v": SLOTS[slot]} if SLOTS[slot] else {})

    def _time_only(self, slot: str) -> bool:
        return SLOTS[slot] is None and not self.arrival

    def slot_type(self, slot: str) -> str:
        if self._time_only(slot):
            return "timestamp_ntz"
        return f"struct<{', '.join(f'{n}: {t}' for n, t in self._fields(slot).items())}>"

    def slot(self, name: str, rule: Rule | None) -> str:
        """SQL of a slot: its candidate where the rule holds, else NULL."""
        if rule is None:
            return f"CAST(NULL AS {self.slot_type(name)}) AS {name}"
        condition, value = rule if isinstance(rule, tuple) else (rule, None)
        fields = ", ".join(f"'{f}', {value if f == 'v' else f}" for f in self._fields(name))
        packed = "at" if self._time_only(name) else f"named_struct({fields})"
        return f"CAST(CASE WHEN {condition} THEN {packed} END AS {self.slot_type(name)}) AS {name}"

    def winner(self, name: str, rule: Rule) -> Column:
        """The candidate of a slot that wins, to be aggregated over rows that still have the columns of the rule."""
        candidate = F.expr(self.slot(name, rule))
        return (F.min(candidate) if name in FIRST_WINS else F.max(candidate)).alias(name)

    def ranking(self) -> list[str]:
        """The ranking columns a source table brings."""
        named = {"seq": self.arrival, "ver": None if self.arrival else self.version}
        return [f"CAST({column} AS BIGINT) AS {name}" for name, column in named.items() if column]

    def time(self, slot: str) -> str:
        """Event time of the winning row of a slot."""
        return slot if self._time_only(slot) else f"{slot}.at"


def _asks(column: str, roles: Mapping[str, tuple[str, ...]], *wanted: str) -> str:
    order = list(roles)
    return f"(coalesce({column}, 0) & {sum(1 << order.index(w) for w in wanted)}) <> 0"


def _concept(*roles: str) -> str:
    """The question of an observation has one of the roles."""
    return _asks("concept_roles", CONCEPT_ROLES, *roles)


def _value(*roles: str) -> str:
    """The coded answer of an observation has one of the roles."""
    return _asks("value_roles", CONCEPT_ROLES, *roles)


def _visit(*roles: str) -> str:
    return _asks("visit_roles", VISIT_ROLES, *roles)


def _named_or_confirmed(role: str) -> str:
    return f"(({_concept(role)}) AND ({_value('yes')})) OR ({_value(role)})"


# Condition, or condition and value, of each slot by source.
OBSERVATION_RULES: Mapping[str, Rule] = {
    "last_visit": "TRUE",
    "pregnant": f"({_concept('pregnant')}) AND ({_value('yes')})",
    "tb": _named_or_confirmed("tb"),
    "tb_two_years": _named_or_confirmed("tb_two_years"),
    "kaposi": _named_or_confirmed("kaposi"),
    "reason": (_concept("reason"), "named_struct('coded', value_coded, 'name_id', value_coded_name_id)"),
}
_SAID_NO = f"(({_value('no')}) OR coalesce(lower(rtrim(value_text)) = 'no', FALSE))"
_TREATMENT_LAPSED = "coalesce(datediff(at, value_datetime) > 60, FALSE)"
_GIVEN_START = "coalesce(to_date(value_datetime), try_to_date(value_text, 'yyyy-MM-dd'), to_date(try_to_timestamp(value_text)))"
VISIT_RULES: Mapping[str, Rule] = {
    "regimen": (_concept("regimen"), "value_text"),
    "side_effects": _concept("side_effect"),
    "missed": (_concept("missed"), "value_numeric"),
    "tb_status": (_concept("tb_status"), "value_coded"),
    "not_on_art": f"(({_concept('taken')}) AND {_SAID_NO}) OR (({_concept('last_taken')}) AND {_TREATMENT_LAPSED})",
    "transfer_in": (f"({_concept('started')}) AND {_GIVEN_START} IS NOT NULL", _GIVEN_START),
}
# Visits at which each of them counts.
VISITS_OF: Mapping[str, str] = {
    "regimen": _visit("dispensing"),
    "side_effects": _visit("consultation"),
    "missed": _visit("adherence", "consultation"),
    "tb_status": _visit("consultation"),
    "not_on_art": _visit("registration"),
    "transfer_in": _visit("registration"),
}


def is_state(role: str) -> str:
    """The state has the role in the programme."""
    return f"in_program AND ({_asks('state_roles', STATE_ROLES, role)})"


STATE_RULES: Mapping[str, Rule] = {
    "state": ("TRUE", "state"),
    "stopped": is_state("stopped"),
    "first_start": f"{is_state('started')} AND at IS NOT NULL",
}
# Quantity over daily dose, rounded to whole days; no dose counts as one a day, a zero dose gives no date.
EXPIRY_RULES: Mapping[str, Rule] = {
    "expiry": ("TRUE", "auto_expire_date + make_dt_interval(CAST(round("
               "try_divide(CAST(quantity AS DOUBLE), coalesce(equivalent_daily_dose, 1D))) AS INT))"),
}
DEATH_RULES: Mapping[str, Rule] = {"death": ("TRUE", "death_date")}


def combined(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Slots, which are all columns but the keys, combined per keys."""
    return df.groupBy(*keys).agg(*[(F.min(s) if s in FIRST_WINS else F.max(s)).alias(s) for s in df.columns if s not in keys])


class ClinicalEvents:
    """Events of the sources, built from a mapping of table name to DataFrame."""

    def __init__(self, tables, ordering: Ordering = Ordering()):
        self.tables, self.ordering = tables, ordering

    # lookups ---------------------------------------------------------------

    @cached_property
    def words(self) -> Dictionary:
        return Dictionary(self.tables)

    @cached_property
    def _questions(self) -> DataFrame:
        return self.words.roles(CONCEPT_ROLES).withColumnRenamed("roles", "concept_roles")

    @cached_property
    def _answers(self) -> DataFrame:
        return self.words.roles(CONCEPT_ROLES).selectExpr("concept_id AS value_coded", "roles AS value_roles")

    @cached_property
    def _visit_types(self) -> DataFrame:
        types = self.tables["encounter_type"].withColumnRenamed("encounter_type_id", "concept_id")
        named = concept_roles(types, VISIT_ROLES)
        return F.broadcast(named.selectExpr("concept_id AS encounter_type", "roles AS visit_roles"))

    # event sources ----------------------------------------------------------

    def _event(self, df: DataFrame, rules: Mapping[str, Rule]) -> DataFrame:
        """One slot per rule, the other slots empty, so that sources can be united."""
        return df.selectExpr(
            "patient_id", "trunc(to_date(at), 'quarter') AS quarter_start",
            *[self.ordering.slot(name, rules.get(name)) for name in SLOTS],
        )

    def observations(self, obs: DataFrame | None = None) -> DataFrame:
        """Rules of observations; every observation is a visit. One read of the table.

        Rows are combined per patient and quarter and, for rules that look at the type of the visit, per visit as well; a
        visit with very many rows does not reach the join as such. Rows of the other rules have no visit and meet none.
        Slots are made while rows are combined: what is shuffled and sorted for that are the few columns of the rows.
        """
        obs = self.tables["obs"] if obs is None else obs
        rows = obs.selectExpr(
            "person_id AS patient_id", "obs_datetime AS at", "obs_id AS id", *self.ordering.ranking(), "encounter_id",
            "concept_id", "value_coded", "value_coded_name_id", "value_datetime", "value_numeric", "value_text",
        )
        rows = rows.join(self._questions, "concept_id", "left").join(self._answers, "value_coded", "left")
        placed = rows.selectExpr(
            "*", "trunc(to_date(at), 'quarter') AS quarter_start",
            f"CASE WHEN {_concept(*VISIT_GATED)} THEN encounter_id END AS visit",
        )
        slots = dealt(placed, "patient_id", "visit").groupBy("patient_id", "quarter_start", "visit").agg(
            *[self.ordering.winner(name, rule) for name, rule in (OBSERVATION_RULES | VISIT_RULES).items()])
        visits = self.tables["encounter"].select(F.col("encounter_id").alias("visit"), "encounter_type")
        visits = visits.join(self._visit_types, "encounter_type").select("visit", "visit_roles")
        rows = left_lookup(slots, visits, "visit")
        return rows.selectExpr(
            "patient_id", "quarter_start",
            *[
                f"CASE WHEN {VISITS_OF[name]} THEN {name} END AS {name}" if name in VISIT_RULES
                else name if name in OBSERVATION_RULES else self.ordering.slot(name, None)
                for name in SLOTS
            ],
        )

    def states(self, patient_state: DataFrame | None = None) -> DataFrame:
        states = self.tables["patient_state"] if patient_state is None else patient_state
        rows = states.selectExpr(
            "patient_program_id", "patient_state_id AS id", *self.ordering.ranking(), "state",
            "CAST(start_date AS TIMESTAMP_NTZ) AS at",
        )
        rows = rows.join(
            self.tables["patient_program"].select("patient_program_id", "patient_id"), "patient_program_id"
        ).join(self.words.states(STATE_ROLES, PROGRAM).select("state", "in_program", "state_roles"), "state", "left")
        return self._event(rows, STATE_RULES)

    def drug_expiry(self, drug_order: DataFrame | None = None) -> DataFrame:
        drugs = self.tables["drug_order"] if drug_order is None else drug_order
        t = self.tables
        arvs = arv_drugs(t["drug"], t["concept_set"], t["concept_name"], ARV_SET, ARV_CONCEPTS).selectExpr(
            "drug_id AS drug_inventory_id")
        given = drugs.filter("quantity > 0").selectExpr(
            "order_id", *self.ordering.ranking(), "drug_inventory_id", "quantity", "equivalent_daily_dose"
        )
        orders = t["orders"].selectExpr("order_id", "patient_id", "start_date AS at", "auto_expire_date")
        rows = given.join(arvs, "drug_inventory_id", "left_semi").join(orders, "order_id")
        return self._event(rows.withColumn("id", F.col("order_id")), EXPIRY_RULES)

    def deaths(self, person: DataFrame | None = None) -> DataFrame:
        """The quarter of a death is that of the person record, as the record system has it."""
        people = self.tables["person"] if person is None else person
        rows = people.filter("dead = 1").selectExpr(
            "person_id AS patient_id", "date_created AS at", "person_id AS id", *self.ordering.ranking(), "death_date"
        )
        return self._event(rows, DEATH_RULES)

    def all(self) -> DataFrame:
        parts = [self.observations(), self.states(), self.drug_expiry(), self.deaths()]
        return reduce(DataFrame.unionAll, parts)
