"""Settings kept as key and value rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quarterfold.functions import ci_equals, title_case


def setting(properties: DataFrame, name: str) -> DataFrame:
    """The value of one setting, one row or none."""
    return properties.filter(ci_equals(F.col("property"), name)).agg(
        F.min("property_value").alias("value")
    ).filter(F.col("value").isNotNull())


def current_site(properties: DataFrame) -> DataFrame:
    """Name of the clinic, each word capitalised."""
    return setting(properties, "current_health_center_name").select(title_case(F.col("value")).alias("site"))
