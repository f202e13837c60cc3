"""The whole run on a small lake, and SQL over what it leaves behind."""

import json

import pytest
from pyspark.sql import functions as F

from wardline import vocabulary as V
from wardline.plans import landing, reports
from wardline.plans.full_run import Paths, full_run
from wardline.plans.reports import CaseSlice
from wardline.sinks import writers
from wardline.sinks.catalog import GOLD_TABLES
from wardline.sources import tables

CASES = CaseSlice(("A90",), "SP", 2022, 2023)


def raw_month(spark, year, month, rows):
    """A month as it is downloaded: lower-case names, real dates, ids that are numbers in even months."""
    row = F.col("id")
    base = spark.range(rows).select(
        (row + year * 100000 + month * 1000).alias("n_aih"), F.lit("SP").alias("uf_zi"), (row % 3).alias("munic_res"),
        (row % 3).alias("munic_mov"), F.expr(f"date_add(date'{year}-{month:02d}-01', cast(id % 28 AS int))").alias("dt_inter"),
        F.lit("20230105").alias("dt_saida"), F.when(row % 2 == 0, "A90").otherwise("J18").alias("diag_princ"),
        (row / 4).alias("val_tot"), (row % 15 - 1).alias("dias_perm"), (row % 90).cast("string").alias("idade"),
        F.lit("F").alias("sexo"), F.lit(0).alias("morte"), (row % 7 + 1).alias("cnes"))
    return base if month % 2 else base.drop("idade")


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("lake"))
    paths = Paths(*[f"{base}/{name}" for name in ("admissions", "registry", "municipalities", "silver", "gold")])
    for year in (2021, 2022, 2023):
        for month in (1, 2, 12):
            landing.land_admissions(raw_month(spark, year, month, 200), paths.admissions, "SP", year, month)
    landing.land_admissions(raw_month(spark, 2023, 12, 150), paths.admissions, "SP", 2023, 12)
    landing.land_admissions(raw_month(spark, 2023, 12, 50), paths.admissions, "SP", 2024, 1, ["Z"])

    pages = [{"estabelecimentos": [
        {"codigo_cnes": i, "nome_fantasia": f"H{i}", "codigo_tipo_unidade": 5, "codigo_uf": 35 if i != 6 else 33,
         "codigo_municipio": 355030 if i % 2 else 3509502, "data_atualizacao": "2024-01-01"} for i in range(1, 7)]}]
    answers = spark.createDataFrame([(json.dumps(p),) for p in pages], "payload string")
    records, _ = landing.registry_of_state(answers, "SP")
    writers.land_registry(records.withColumn("uf", F.lit("SP")), paths.registry)

    localities = spark.createDataFrame([(json.dumps(
        [{"id": 3550308, "nome": "A, B"}, {"id": 3509502, "nome": "C"}]),)], "payload string")
    statistics = spark.createDataFrame([(json.dumps(
        [{"resultados": [{"series": [{"localidade": {"id": "3550308"}, "serie": {"2024": "1000"}}]}]}]),)],
        "payload string")
    reference = landing.municipality_reference(localities, statistics, "SP", 500)
    assert sorted(r.is_estimated for r in reference.collect()) == [False, True]
    writers.write_csv(reference.drop("is_estimated"), paths.municipalities)
    return paths


@pytest.fixture(scope="module")
def views(spark, lake):
    full_run(spark, lake, "lake")
    return full_run(spark, lake, "lake")  # a second run replaces the first


def test_tables_have_the_declared_columns(spark, views):
    for name, (schema, _) in GOLD_TABLES.items():
        table = spark.table(f"lake.{name}")
        assert table.dtypes == [(f.name, f.dataType.simpleString()) for f in schema.fields]
        assert table.count() > 0
    assert spark.table("lake.municipios_referencia").count() == 2


def test_landed_months_are_replaced_and_rules_applied(spark, lake, views):
    # 8 months of 200 and the relanded one of 150; one row in 15 has a negative stay.
    kept = sum(1 for rows in [200] * 8 + [150] for i in range(rows) if i % 15 != 0)
    assert spark.table("lake.fato_internacoes").count() == kept
    assert tables.read_table(spark, f"{lake.silver}/internacoes").count() == kept
    assert spark.table("lake.fato_internacoes").filter("ano = 2023 AND mes = 12").count() == sum(
        1 for i in range(150) if i % 15 != 0)


def test_registry_of_another_state_is_left_out(spark, views):
    assert sorted(r.cnes_id for r in spark.table("lake.dim_hospital").collect()) == [1, 2, 3, 4, 5]


def test_views_are_registered_and_consistent(spark, views):
    overview = spark.table("vw_acompanhamento_geral")
    joined = spark.sql("SELECT count(*) AS n FROM lake.fato_internacoes JOIN lake.dim_hospital USING (cnes_id)").first().n
    assert overview.agg(F.sum("qtd_internacoes")).first()[0] == joined
    assert {r.nome_municipio for r in overview.collect()} == {"A, B", "C"}
    trend = spark.table("vw_tendencia_doencas")
    assert trend.agg(F.sum("qtd_casos_mes")).first()[0] == spark.table("lake.fato_internacoes").count()
    assert spark.table("vw_pressao_por_regiao").count() == 2
    ranking = spark.table("vw_ranking_hospitais_criticos")
    assert {r.nivel_risco for r in ranking.collect()} <= set(V.ALERT_LEVELS)


def test_another_session_reads_the_same_views_by_name(spark, views, rows):
    other = spark.newSession()
    for name, view in views.items():
        kept = other.table(f"lake.{name}")
        assert kept.columns == view.columns
        rounded = [F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in view.dtypes]
        assert rows(kept.select(*rounded)) == rows(view.select(*rounded))
        assert kept.dtypes == view.dtypes
    assert spark.table("silver_internacoes_preview").count() == spark.table("lake.fato_internacoes").count()


def test_plain_sql_gives_the_same_report(spark, views, rows):
    star = [spark.table(f"lake.{n}") for n in ("fato_internacoes", "dim_hospital", "municipios_referencia")]
    by_sql = spark.sql("""
        SELECT ano, mes, dim_hospital.uf, nome_municipio, count(*) AS qtd_internacoes,
               sum(valor_total) AS valor_total_pago, avg(dias_permanencia) AS permanencia_media
        FROM lake.fato_internacoes JOIN lake.dim_hospital USING (cnes_id)
        LEFT JOIN lake.municipios_referencia place
          ON dim_hospital.codigo_municipio IN (place.codigo_municipio, place.codigo_municipio div 10)
        WHERE cid_principal = 'A90' AND dim_hospital.uf = 'SP' AND ano BETWEEN 2022 AND 2023 GROUP BY ALL""")
    report = reports.case_overview(*star, CASES)
    rounded = [F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in report.dtypes]
    assert rows(report.select(*rounded)) == rows(by_sql.select(*rounded))


def test_codes_not_found_are_reported(spark, rows):
    def answer(code, state):
        return (json.dumps({"codigo_cnes": code, "codigo_uf": state}),)
    answers = spark.createDataFrame([answer(1, 35), answer(2, 33), answer(9, 35)], "payload string")
    codes = spark.createDataFrame([(1,), (2,), (3,)], "cnes_id long")
    found, missing = landing.registry_of_codes(answers, codes, "SP")
    assert rows(found, "codigo_cnes") == [(1,)]
    assert rows(missing) == [(2,), (3,)]
