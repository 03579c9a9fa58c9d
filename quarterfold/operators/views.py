"""Named views over the clinical tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quarterfold.functions import not_voided

# Ids the views are defined with.
CONSULTATION_TYPE = 53
REGISTRATION_TYPE = 9
TREATMENT_PROGRAM = 1
ON_TREATMENT_STATE = 7
PREGNANT_CONCEPT = 6131
YES_CONCEPT = 1065
REGIMEN_CONCEPT = 2559
START_DATE_CONCEPT = 2516
TB_STATUS_CONCEPT = 7459


def clinic_consultation_encounter(tables) -> DataFrame:
    return not_voided(tables["encounter"]).filter(F.col("encounter_type") == CONSULTATION_TYPE)


def clinic_registration_encounter(tables) -> DataFrame:
    return not_voided(tables["encounter"]).filter(F.col("encounter_type") == REGISTRATION_TYPE)


def earliest_start_date(tables) -> DataFrame:
    """First day in the treatment state per patient of the treatment programme.

    With several enrolments the enrolment date is that of the lowest
    enrolment id.
    """
    states = not_voided(tables["patient_state"]).filter(F.col("state") == ON_TREATMENT_STATE)
    enrolled = not_voided(tables["patient_program"]).filter(F.col("program_id") == TREATMENT_PROGRAM)
    deaths = tables["person"].select(F.col("person_id").alias("patient_id"), "death_date")
    per_patient = (
        enrolled.select("patient_program_id", "patient_id", "date_enrolled")
        .join(states.select("patient_program_id", "start_date"), "patient_program_id")
        .groupBy("patient_id")
        .agg(
            F.min(F.struct("patient_program_id", "date_enrolled"))["date_enrolled"].alias("date_enrolled"),
            F.min("start_date").alias("earliest_start_date"),
        )
    )
    return per_patient.join(deaths, "patient_id", "left")


def _observed(tables, concept: int) -> DataFrame:
    return not_voided(tables["obs"]).filter(F.col("concept_id") == concept)


def patient_pregnant_obs(tables) -> DataFrame:
    return _observed(tables, PREGNANT_CONCEPT).filter(F.col("value_coded") == YES_CONCEPT)


def patient_state_on_arvs(tables) -> DataFrame:
    return not_voided(tables["patient_state"]).filter(F.col("state") == ON_TREATMENT_STATE)


def regimen_observation(tables) -> DataFrame:
    return _observed(tables, REGIMEN_CONCEPT)


def start_date_observation(tables) -> DataFrame:
    return _observed(tables, START_DATE_CONCEPT)


def tb_status_observations(tables) -> DataFrame:
    return _observed(tables, TB_STATUS_CONCEPT)


VIEWS = {
    view.__name__: view
    for view in (
        clinic_consultation_encounter, clinic_registration_encounter, earliest_start_date, patient_pregnant_obs,
        patient_state_on_arvs, regimen_observation, start_date_observation, tb_status_observations,
    )
}
