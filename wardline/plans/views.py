"""Business views over the Gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wardline import vocabulary as V
from wardline.functions.numbers import per_thousand
from wardline.operators import rollups as R
from wardline.operators.joins import join_municipality, with_facility
from wardline.operators.ranking import rank_desc_few

MONTH_KEYS = ["cnes_id", "ano", "mes"]


def overview(fact: DataFrame, dim: DataFrame, municipalities: DataFrame, pressure: DataFrame) -> DataFrame:
    """Admissions, money, stay and pressure by month and municipality.

    The mean index weighs every facility-month by its admissions. The level is
    the greatest in text order.
    """
    monthly = R.facility_rollup(fact, MONTH_KEYS, money="valor_total")
    with_index = monthly.join(pressure.select(*MONTH_KEYS, "indice_pressao", "nivel_risco"), MONTH_KEYS, "left")
    placed = join_municipality(with_facility(with_index, dim, ["uf", "codigo_municipio"]),
                               municipalities, ["nome_municipio"])
    return placed.groupBy("ano", "mes", "uf", "nome_municipio").agg(
        R.rows().alias("qtd_internacoes"),
        R.total_money().alias("valor_total_pago"),
        R.mean_stay().alias("permanencia_media"),
        R.mean_by_rows("indice_pressao").alias("indice_pressao_medio"),
        F.max("nivel_risco").alias("nivel_risco_predominante"),
    )


def monthly_trend(trend: DataFrame) -> DataFrame:
    """Cases and mean weekly change by state, diagnosis and month."""
    return trend.groupBy("uf", "cid_principal", "ano", "mes").agg(
        F.sum("qtd_casos").alias("qtd_casos_mes"),
        F.avg("variacao_pct").alias("variacao_media_pct"),
    )


def pressure_by_region(fact: DataFrame, dim: DataFrame, municipalities: DataFrame, pressure: DataFrame,
                       count_rate: bool = False) -> DataFrame:
    """Pressure by place, over all months.

    `internacoes_por_1000hab` adds up days of stay, as its users know it; with
    `count_rate` a column of admissions per 1000 inhabitants is added. Of
    several levels the first in text order is shown.
    """
    monthly = R.facility_rollup(fact, MONTH_KEYS)
    with_index = monthly.join(pressure.select(*MONTH_KEYS, "indice_pressao", "nivel_risco"), MONTH_KEYS)
    placed = join_municipality(
        with_facility(with_index, dim, ["uf", "codigo_municipio", "latitude", "longitude"]),
        municipalities, ["nome_municipio", "regiao_saude", "populacao"])
    rates = {"internacoes_por_1000hab": R.total_days()}
    if count_rate:
        rates["admissoes_por_1000hab"] = R.rows()
    return placed.groupBy("uf", "nome_municipio", "latitude", "longitude", "regiao_saude", "populacao").agg(
        R.mean_by_rows("indice_pressao").alias("indice_pressao_medio"),
        F.min("nivel_risco").alias("nivel_risco_regiao"),
        *[per_thousand(total, "populacao").alias(name) for name, total in rates.items()],
    ).drop("populacao")


def critical_ranking(dim: DataFrame, municipalities: DataFrame, pressure: DataFrame) -> DataFrame:
    """Facility-months in an alert level, ranked by index within their month."""
    alerts = pressure.filter(F.col("nivel_risco").isin(*V.ALERT_LEVELS))
    placed = join_municipality(with_facility(alerts, dim, ["nome_estabelecimento", "uf", "codigo_municipio"]),
                               municipalities, ["nome_municipio"])
    ranked = rank_desc_few(placed, ["ano", "mes"], "indice_pressao", "ranking_criticidade")
    return ranked.select("nome_estabelecimento", "uf", "nome_municipio", "ano", "mes", "indice_pressao",
                         "nivel_risco", "qtd_internacoes", "permanencia_media", "ranking_criticidade")
