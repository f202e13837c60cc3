"""Weekly case counts and their change."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wardline import schemas
from wardline.functions.numbers import pct_change
from wardline.operators.joins import with_state
from wardline.operators.ranking import lag_over

SERIES = ["uf", "cid_principal"]
PERIOD = ["ano", "mes", "semana_epidemiologica"]


def weekly_cases(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Cases by state, diagnosis and week. A week that spans two months counts in each.

    Admissions are counted by facility first; only the counts meet the
    facilities, whose state they are then added up by.
    """
    counts = fact.groupBy("cnes_id", "cid_principal", *PERIOD).agg(F.count("*").alias("_n"))
    return with_state(counts, dim).groupBy(*SERIES, *PERIOD).agg(F.sum("_n").alias("qtd_casos"))


def weekly_lag(cases: DataFrame) -> DataFrame:
    """Add the cases of the series' previous week that has any. A series is at most one row per week."""
    return lag_over(cases, SERIES, PERIOD, "qtd_casos", "qtd_casos_semana_anterior")


def disease_trend(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Weekly cases by state and diagnosis, with the change against the previous week in percent."""
    change = pct_change("qtd_casos", "qtd_casos_semana_anterior")
    return weekly_lag(weekly_cases(fact, dim)).withColumn("variacao_pct", change).to(schemas.DISEASE_TREND)
