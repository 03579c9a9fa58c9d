"""Key maps between the two record systems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarterfold.operators.lookups import fixed_table

CONCEPT_MAP_SCHEMA = "old_concept_id bigint, old_concept_name string, new_concept_id bigint"
DRUG_MAP_SCHEMA = "drug_id bigint, old_name string, new_name string, new_drug_id bigint"
USER_MAP_SCHEMA = "old_user_id bigint, new_user_id bigint, old_patient_id bigint, new_person_id bigint"

# Drug id and name in the source, name and id in the target.
DRUG_MAP = (
    (1, "Stavudine 30 Lamivudine 150", "D4T / 3TC (Stavudine Lamivudine 30/150 tablet)", 738),
    (2, "Stavudine 40 Lamivudine 150", "Coviro40 (Lamivudine + Stavudine 150/40mg tablet)", 91),
    (5, "Stavudine 30 Lamivudine 150 Nevirapine 200", "Triomune-30", 2),
    (6, "Stavudine 40 Lamivudine 150 Nevirapine 200", "Triomune-40", 3),
    (7, "Efavirenz 600", "EFV (Efavirenz 600mg tablet)", 11),
    (8, "Zidovudine 300 Lamivudine 150", "AZT+3TC (Zidovudine and Lamivudine tablet)", 39),
    (9, "Nevirapine 200", "NVP (Nevirapine 200 mg tablet)", 22),
    (10, "Abacavir 300", "ABC (Abacavir 300mg tablet)", 40),
    (11, "Didanosine 125", "DDI (Didanosine 125mg tablet)", 9),
    (12, "Lopinavir 133 Ritonavir 33", "LPV/r (Lopinavir and Ritonavir 133/33mg tablet)", 739),
    (13, "Didanosine 200", "DDI (Didanosine 200mg tablet)", 10),
    (14, "Tenofovir 300", "TDF (Tenofavir 300 mg tablet)", 14),
    (16, "Cotrimoxazole 480", "Cotrimoxazole (480mg tablet)", 297),
    (17, "Lopinavir 200 Ritonavir 50", "LPV/r (Lopinavir and Ritonavir 200/50mg tablet)", 73),
    (18, "Zidovudine Lamivudine Nevirapine", "AZT+3TC+NVP", 614),
    (22, "Lamivudine 150", "3TC (Lamivudine 150mg tablet)", 42),
    (51, "Efavirenz 200", "EFV (Efavirenz 200mg tablet)", 30),
    (56, "Stavudine 6 Lamivudine 30 Nevirapine 50", "Triomune baby (d4T + 3TC + NVP 6/30/50mg tablet)", 72),
    (57, "Stavudine 6 Lamivudine 30", "Lamivir baby (Stavudine and Lamivudine 6/30mg tabl", 73),
    (59, "Zidovudine 300 Lamivudine 150 Nevirapine 200", "AZT/3TC/NVP (300/150/200mg tablet)", 731),
    (148, "Tenofovir Disoproxil Fumarate/Lamivudine 300mg/300", "TDF+3TC (Tenofavir and Lamivudine 300/300mg tablet", 734),
)


def load_map(spark: SparkSession, kind: str, path: str | None = None) -> DataFrame:
    """A key map: ``concept`` and ``user`` from a CSV or parquet file, ``drug`` also from the built-in table."""
    schemas = {"concept": CONCEPT_MAP_SCHEMA, "drug": DRUG_MAP_SCHEMA, "user": USER_MAP_SCHEMA}
    if kind not in schemas:
        raise KeyError(f"unknown map {kind!r}; one of {', '.join(schemas)}")
    if path is None:
        if kind != "drug":
            raise ValueError(f"the {kind} map has no built-in table; give its path")
        return fixed_table(spark, DRUG_MAP, DRUG_MAP_SCHEMA)
    if path.endswith(".csv"):
        return spark.read.csv(path, schema=schemas[kind], header=True)
    return spark.read.schema(schemas[kind]).parquet(path)
