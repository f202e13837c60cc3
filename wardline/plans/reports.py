"""Report queries on a slice of cases, and the figures derived from them."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from wardline import vocabulary as V
from wardline.functions.dates import month_start
from wardline.functions.numbers import money_sum, per_thousand
from wardline.operators import rollups as R
from wardline.operators.joins import join_municipality, with_facility
from wardline.operators.quality import slice_cases
from wardline.operators.ranking import top_groups, top_ranked


@dataclass(frozen=True)
class CaseSlice:
    """Which cases a report is about."""

    codes: tuple[str, ...]
    state: str
    first_year: int
    last_year: int

    def of(self, df: DataFrame) -> DataFrame:
        return slice_cases(df, self.codes, self.state, self.first_year, self.last_year)


def _placed(fact: DataFrame, dim: DataFrame, municipalities: DataFrame, cases: CaseSlice, keys: list[str],
            facility: Iterable[str], place: Iterable[str], money: str | None = None) -> DataFrame:
    """Facility-level partial sums of the sliced cases, with facility and municipality columns."""
    sliced = fact.filter(F.col("cid_principal").isin(*cases.codes)
                         & F.col("ano").between(cases.first_year, cases.last_year))
    in_state = dim.filter(F.col("uf") == cases.state)
    partial = R.facility_rollup(sliced, ["cnes_id", *keys], money=money)
    return join_municipality(with_facility(partial, in_state, ["uf", "codigo_municipio", *facility]),
                             municipalities, place)


def case_overview(fact: DataFrame, dim: DataFrame, municipalities: DataFrame, cases: CaseSlice) -> DataFrame:
    """Cases, money and mean stay by month and municipality."""
    placed = _placed(fact, dim, municipalities, cases, ["ano", "mes"], [], ["nome_municipio"], money="valor_total")
    return placed.groupBy("ano", "mes", "uf", "nome_municipio").agg(
        R.rows().alias("qtd_internacoes"),
        R.total_money().alias("valor_total_pago"),
        R.mean_stay().alias("permanencia_media"),
    )


def case_trend(monthly_trend: DataFrame, cases: CaseSlice) -> DataFrame:
    """The slice of the monthly trend view."""
    return cases.of(monthly_trend)


def case_map(fact: DataFrame, dim: DataFrame, municipalities: DataFrame, cases: CaseSlice) -> DataFrame:
    """Cases and cases per 1000 inhabitants by place."""
    placed = _placed(fact, dim, municipalities, cases, [], ["latitude", "longitude"],
                     ["nome_municipio", "regiao_saude", "populacao"])
    return placed.groupBy("uf", "nome_municipio", "latitude", "longitude", "regiao_saude", "populacao").agg(
        R.rows().alias("qtd_casos"),
        per_thousand(R.rows(), "populacao").alias("casos_por_1000hab"),
    ).drop("populacao")


def facilities_by_cases(fact: DataFrame, dim: DataFrame, municipalities: DataFrame, cases: CaseSlice,
                        n: int = 20) -> DataFrame:
    """The `n` facilities with most cases and their rank. Facilities of one name and place count as one."""
    placed = _placed(fact, dim, municipalities, cases, [], ["nome_estabelecimento"], ["nome_municipio"])
    by_name = placed.groupBy("nome_estabelecimento", "uf", "nome_municipio").agg(
        R.rows().alias("qtd_casos"), R.mean_stay().alias("permanencia_media"))
    return top_ranked(by_name, "qtd_casos", n, "ranking_criticidade", ["nome_estabelecimento", "nome_municipio"])


def pressure_map(pressure_by_region: DataFrame, state: str) -> DataFrame:
    """One state of the regional pressure view."""
    return pressure_by_region.filter(F.col("uf") == state)


def pressure_ranking(critical_ranking: DataFrame, state: str, n: int = 30) -> DataFrame:
    """The latest `n` entries of one state in the national ranking; ranks stay national."""
    ties = ["nome_estabelecimento", "nome_municipio", "nivel_risco", "qtd_internacoes", "permanencia_media"]
    return (critical_ranking.filter(F.col("uf") == state)
            .orderBy(F.col("ano").desc(), F.col("mes").desc(), "ranking_criticidade",
                     *[F.col(c).asc_nulls_last() for c in ties])
            .limit(n))


def timeline(trend: DataFrame, newest_first: bool = False) -> DataFrame:
    """Monthly trend with the month as a date, in time order."""
    period = F.col("periodo").desc() if newest_first else F.col("periodo").asc()
    return (trend.select(month_start("ano", "mes").alias("periodo"), "cid_principal", "qtd_casos_mes",
                         "variacao_media_pct")
            .orderBy(period, "cid_principal"))


def ranking_table(ranking: DataFrame) -> DataFrame:
    """The facility ranking under its display headings."""
    # Column -> heading.
    headings = {
        "ranking_criticidade": "#",
        "nome_estabelecimento": "Hospital",
        "nome_municipio": "Município",
        "qtd_casos": "Casos",
        "permanencia_media": "Permanência média (dias)",
    }
    return ranking.select(*[F.col(name).alias(heading) for name, heading in headings.items()])


def headline_kpis(overview: DataFrame) -> DataFrame:
    """One row: cases, money, mean of the group means, municipalities affected."""
    return overview.agg(
        F.sum("qtd_internacoes").alias("total_internacoes"),
        money_sum("valor_total_pago").alias("valor_total"),
        F.avg("permanencia_media").alias("permanencia_media"),
        F.count_distinct("nome_municipio").alias("municipios_afetados"),
    )


def top_municipalities(overview: DataFrame, n: int = 15) -> DataFrame:
    return top_groups(overview, "nome_municipio", "qtd_internacoes", n)


def cases_by_year(overview: DataFrame) -> DataFrame:
    return overview.groupBy("ano").agg(F.sum("qtd_internacoes").alias("qtd_internacoes"))


def pressure_headline(ranking: DataFrame) -> DataFrame:
    """One row: mean index, entries in overload, facilities."""
    return ranking.agg(
        F.avg("indice_pressao").alias("indice_pressao_medio"),
        F.count_if(F.col("nivel_risco") == V.OVERLOAD_LEVEL).alias("em_sobrecarga"),
        F.count_distinct("nome_estabelecimento").alias("hospitais_monitorados"),
    )


def value_counts(df: DataFrame, column: str, name: str = "qtd_hospitais") -> DataFrame:
    """Rows per value, most frequent first; NULL is not counted."""
    return (df.na.drop(subset=[column]).groupBy(column).agg(F.count("*").alias(name))
            .orderBy(F.col(name).desc(), column))


def ingest_report(seen: DataFrame, kept: DataFrame, spine: DataFrame, key: str = "ano_mes") -> DataFrame:
    """Every expected month: rows seen, rows kept, and whether nothing of it was kept."""
    counts = (seen.groupBy(key).agg(F.count("*").alias("vistas"))
              .join(kept.groupBy(key).agg(F.count("*").alias("gravadas")), key, "full"))
    filled = {name: F.coalesce(F.col(name), F.lit(0)) for name in ("vistas", "gravadas")}
    return (spine.select(key).join(counts, key, "left").withColumns(filled)
            .withColumn("vazio", F.col("gravadas") == 0))


def ingest_summary(report: DataFrame) -> DataFrame:
    """One row: months expected, rows seen and kept, months that came out empty."""
    return report.agg(
        F.count("*").alias("meses"),
        F.sum("vistas").alias("vistas"),
        F.sum("gravadas").alias("gravadas"),
        F.count_if("vazio").alias("meses_vazios"),
    )


def estimate_summary(filled: DataFrame, flag: str = "is_estimated") -> DataFrame:
    """One row: reference rows with real and with estimated values."""
    return filled.agg(F.count_if(~F.col(flag)).alias("reais"), F.count_if(F.col(flag)).alias("estimados"))
