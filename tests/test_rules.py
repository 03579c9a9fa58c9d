from __future__ import annotations

from quarterfold.operators import rules
from tests.tiny import frame

AS_OF = "2001-12-31"
WASTING = rules.ELIGIBILITY_ROLES["wasting"][0]
CONCEPTS = [
    "Yes", "No", "CD4 count", "CD4 count < 750", "CD4 count < 350", "CD4 count < 250", "Lymphocyte count", "Pregnant", "Breastfeeding",
    "First positive HIV Test", "PCR Test", "Rapid Test", "Oral thrush", "Sepsis, severe", "Pneumonia, severe", WASTING,
    "Presumed HIV Disease", "Child HIV positive", "Lymphocyte count below threshold with WHO stage 2",
    "WHO stage 2 adult", "WHO stage 3 adult", "WHO stage 4 adult", "WHO stage 2 peds", "WHO stage 3 peds", "WHO stage 4 peds",
    "sign two", "sign three", "sign four",
]
ID = {name: 100 + i for i, name in enumerate(CONCEPTS)}
SETS = [(ID["sign two"], ID["WHO stage 2 adult"]), (ID["sign two"], ID["WHO stage 2 peds"]), (ID["sign three"], ID["WHO stage 3 adult"]),
        (ID["sign four"], ID["WHO stage 4 adult"]), (ID["sign four"], ID["WHO stage 4 peds"])]


class Source:
    def __init__(self, spark):
        self.spark, self.people, self.visits, self.told = spark, [], [], []

    def patient(self, pid, birthdate, gender="Female", staged=("2000-06-01",)):
        self.people.append({"patient_id": pid, "gender": gender, "birthdate": birthdate, "birthdate_estimated": 0, "date_created": "2000-01-01 00:00:00"})
        for n, on in enumerate(staged):
            self.visits.append({"encounter_id": pid * 10 + n, "patient_id": pid, "encounter_type": 2, "encounter_datetime": f"{on} 00:00:00", "voided": 0})
        return self

    def says(self, pid, concept, answer="Yes", number=None, voided=0, visit=None):
        self.told.append({"patient_id": pid, "encounter_id": pid * 10 if visit is None else visit, "concept_id": ID[concept],
                          "value_coded": ID[answer] if answer else None, "value_numeric": number, "voided": voided})
        return self

    def __getitem__(self, name):
        return {
            "patient": lambda: frame(self.spark, self.people, "patient_id long, gender string, birthdate date, birthdate_estimated int, date_created timestamp_ntz"),
            "encounter": lambda: frame(self.spark, self.visits, "encounter_id long, patient_id long, encounter_type long, encounter_datetime timestamp_ntz, voided int"),
            "obs": lambda: frame(self.spark, self.told, "patient_id long, encounter_id long, concept_id long, value_coded long, value_numeric double, voided int"),
            "encounter_type": lambda: self.spark.createDataFrame([(1, "ART Visit"), (2, "hiv staging ")], "encounter_type_id long, name string"),
            "concept": lambda: self.spark.createDataFrame([(i, n) for n, i in ID.items()], "concept_id long, name string"),
            "concept_set": lambda: self.spark.createDataFrame(SETS, "concept_id long, concept_set long"),
        }[name]()


def test_regimen_category_by_age_on_the_day(spark):
    src = Source(spark).patient(1, "1986-01-01").patient(2, None)
    cases = [(1, 450, "2000-12-31"), (1, 450, "2001-12-31"), (1, 453, "2001-12-31"), (1, 829, "2000-01-01"), (1, 5000, "2001-12-31"),
             (1, None, "2001-12-31"), (2, 450, "2001-12-31")]
    df = frame(spark, [{"n": n, "patient_id": p, "r": r, "on": on} for n, (p, r, on) in enumerate(cases)], "n int, patient_id long, r long, on date")
    got = {x.n: x.category for x in rules.regimen_category(df, src["patient"], "r", "on", AS_OF).collect()}
    assert [got[n] for n in range(len(cases))] == ["P1", "1A", "9A", "8P", "Nn", "Nn", "Nn"]


def test_stage_is_the_highest_confirmed(spark):
    src = (
        Source(spark).patient(1, "1970-01-01").says(1, "sign three").says(1, "sign four")
        .patient(2, "1970-01-01").says(2, "sign four", "No").says(2, "sign two")
        .patient(3, "1990-01-01").says(3, "sign three")  # not a sign for children
        .patient(4, "1970-01-01", staged=()).says(4, "sign four")
        .patient(5, "1970-01-01", staged=("2000-01-01", "2001-01-01")).says(5, "sign four", visit=51)  # second visit
    )
    asked = src["patient"].selectExpr("patient_id", "DATE'2001-01-01' AS asked")
    assert {r.patient_id: r.stage for r in rules.who_stage(src, asked, AS_OF).collect()} == {1: 4, 2: 2, 3: 1, 4: 1, 5: 1}


def eligible(spark):
    return (
        Source(spark)
        .patient(1, "2000-01-01").says(1, "First positive HIV Test", "Rapid Test").says(1, "Oral thrush").says(1, "Sepsis, severe")
        .patient(2, "2000-01-01").says(2, "First positive HIV Test", "Rapid Test").says(2, "Oral thrush")
        .patient(3, "2000-01-01").says(3, "First positive HIV Test", "PCR Test")
        .patient(4, "1999-05-01")
        .patient(5, "1997-06-01").says(5, "CD4 count", None, 750.0, voided=1)
        .patient(6, "1992-06-01").says(6, "Lymphocyte count", None, 2000.0).says(6, "sign two")
        .patient(7, "1970-01-01").says(7, "Lymphocyte count", None, 100.0).says(7, "sign two")
        .patient(8, "1970-01-01", staged=("2011-07-01",)).says(8, "CD4 count", "Yes", 350.0)
        .patient(9, "1970-01-01", staged=("2011-06-30",)).says(9, "CD4 count", "Yes", 350.0)
        .patient(10, "1970-01-01", staged=("2011-06-30",)).says(10, "CD4 count", "Yes", 250.0)
        .patient(11, "1970-01-01", staged=("2011-06-30",)).says(11, "Pregnant").says(11, "Breastfeeding")
        .patient(12, "1970-01-01", staged=()).says(12, "Breastfeeding")
        .patient(13, "1970-01-01", gender="F").says(13, "Pregnant")
        .patient(14, "1970-01-01").says(14, "sign three").says(14, "CD4 count", "Yes", 100.0)
        .patient(15, "1970-01-01", gender="Male", staged=("2011-06-30",)).says(15, "CD4 count", None, 100.0)
    )


def test_eligibility_reasons_in_order(spark):
    got = {r.patient_id: r.reason for r in rules.art_eligibility_reason(eligible(spark), AS_OF).collect()}
    assert got == {
        1: "Presumed HIV Disease", 2: None, 3: "PCR Test", 4: "Child HIV positive", 5: "CD4 count < 750",
        6: "Lymphocyte count below threshold with WHO stage 2", 7: None, 8: "CD4 count < 350", 9: None, 10: "CD4 count < 250",
        11: "Pregnant", 12: "Breastfeeding", 13: None, 14: "WHO stage 3 adult", 15: None,
    }


def test_eligibility_as_written_looks_at_everybody(spark):
    got = {r.patient_id: r.reason for r in rules.art_eligibility_reason(eligible(spark), AS_OF, "as_written").collect()}
    assert got[9] == "Pregnant"  # some other patient is
    assert got[15] is None and got[10] == "CD4 count < 250"
