"""Silver to Gold: the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wardline import schemas
from wardline.functions.dates import quarter_of


def dim_hospital(registry: DataFrame) -> DataFrame:
    return registry.to(schemas.DIM_HOSPITAL)


def dim_time(admissions: DataFrame) -> DataFrame:
    """Every (year, month, week) that occurs, with its quarter."""
    weeks = admissions.select("ano", "mes", "semana_epidemiologica").distinct()
    return weeks.withColumn("trimestre", quarter_of("mes")).to(schemas.DIM_TIME)


def fact(admissions: DataFrame) -> DataFrame:
    return admissions.to(schemas.FACT)
