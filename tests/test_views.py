"""Views and reports against rows worked out one by one, with skew, fan-out and gaps in the data."""

import pytest
from pyspark.sql import functions as F

from plans import plan_of
from wardline import schemas
from wardline.plans import gold, reports, silver, trends, views
from wardline.plans.reports import CaseSlice

CASES = CaseSlice(("A90",), "SP", 2022, 2023)


@pytest.fixture(scope="module")
def star(spark):
    row = F.col("id")
    hot = F.when(row % 3 == 0, 1).otherwise(row % 12)
    fact = spark.range(4000).select(
        hot.alias("cnes_id"), (row % 5).alias("municipio_id"), (row % 52 + 1).cast("int").alias("semana_epidemiologica"),
        F.when(row % 4 < 2, "A90").when(row % 4 == 2, "J18").alias("cid_principal"),
        (row % 977 / 100).alias("valor_total"),
        F.when(row % 13 != 0, row % 29).cast("int").alias("dias_permanencia"),
        (F.lit(2021) + row % 3).cast("int").alias("ano"), (row % 12 + 1).cast("int").alias("mes"))
    dim = spark.createDataFrame(
        [(i, f"H{i // 2}", 5, True, None if i == 7 else ("SP" if i % 2 else "RJ"),
          None if i == 5 else (353440 if i < 4 else 3550308), None if i == 9 else -20.0 - i % 3, -45.0, None, None, 1)
         for i in range(1, 11)], schemas.DIM_HOSPITAL)
    places = spark.createDataFrame(
        [(3534401, "P", "SP", "norte", 1000, 2.0), (3534402, "Q", "SP", "sul", 0, 2.0),
         (3550308, "R", "SP", None, None, 2.0)], schemas.MUNICIPALITIES)
    levels = ["Baixo risco", "Atenção", "Crítico", "Sobrecarga iminente", None]
    pressure = spark.createDataFrame(
        [(i, 2021 + y, m, 5, 3.0, 1, 0, levels[(i + y + m) % 5], None if (i + m) % 6 == 0 else float((i * m) % 10))
         for i in range(12) for y in range(3) for m in range(1, 12)], schemas.PRESSURE)
    return fact, dim, places, pressure


class Expected:
    """The fixture's rows on the driver, and what follows from them, worked out one row at a time."""

    def __init__(self, star):
        self.fact, dim, self.places, pressure = ([r.asDict() for r in df.collect()] for df in star)
        self.dim = {d["cnes_id"]: d for d in dim}
        self.pressure = {(p["cnes_id"], p["ano"], p["mes"]): p for p in pressure}

    def spots(self, facility):
        """The municipalities a facility's code stands for, with or without the check digit; None for none."""
        code = facility["codigo_municipio"]
        return [m for m in self.places if code in (m["codigo_municipio"], m["codigo_municipio"] // 10)] or [None]

    def cases(self, keep=lambda admission, facility: True):
        for admission in self.fact:
            facility = self.dim.get(admission["cnes_id"])
            if facility and keep(admission, facility):
                for spot in self.spots(facility):
                    yield admission, facility, spot


def of(record, name):
    return record and record[name]


def mean(values):
    known = [v for v in values if v is not None]
    return sum(known) / len(known) if known else None


def per_thousand(amount, spot):
    people = of(spot, "populacao")
    return amount / people * 1000 if people else None


def gathered(items, key):
    groups = {}
    for item in items:
        groups.setdefault(key(*item), []).append(item)
    return groups


def comparable(found):
    rounded = [tuple(round(v, 6) + 0.0 if isinstance(v, float) else v for v in row) for row in found]
    return sorted(rounded, key=lambda row: [(v is not None, str(type(v)), v) for v in row])


def same(got, names, expected):
    assert got.columns == names
    assert expected
    assert comparable(map(tuple, got.collect())) == comparable(expected)


def in_slice(admission, facility):
    return (admission["cid_principal"] in CASES.codes and facility["uf"] == CASES.state
            and CASES.first_year <= admission["ano"] <= CASES.last_year)


def days(group):
    return [a["dias_permanencia"] for a, *_ in group]


def test_overview(star):
    world = Expected(star)
    expected = []
    months = gathered(world.cases(), lambda a, f, s: (a["ano"], a["mes"], f["uf"], of(s, "nome_municipio")))
    for key, group in months.items():
        known = [world.pressure.get((a["cnes_id"], a["ano"], a["mes"])) for a, *_ in group]
        levels = [p["nivel_risco"] for p in known if p and p["nivel_risco"]]
        expected.append((*key, len(group), sum(a["valor_total"] for a, *_ in group), mean(days(group)),
                         mean(of(p, "indice_pressao") for p in known), max(levels, default=None)))
    names = ["ano", "mes", "uf", "nome_municipio", "qtd_internacoes", "valor_total_pago", "permanencia_media",
             "indice_pressao_medio", "nivel_risco_predominante"]
    same(views.overview(*star), names, expected)


def test_pressure_by_region(star):
    world = Expected(star)
    measured = (c for c in world.cases() if (c[0]["cnes_id"], c[0]["ano"], c[0]["mes"]) in world.pressure)
    regions = gathered(measured, lambda a, f, s: (f["uf"], of(s, "nome_municipio"), f["latitude"], f["longitude"],
                                                  of(s, "regiao_saude"), of(s, "populacao")))
    expected = []
    for key, group in regions.items():
        known = [world.pressure[a["cnes_id"], a["ano"], a["mes"]] for a, *_ in group]
        levels = [p["nivel_risco"] for p in known if p["nivel_risco"]]
        spot = group[0][2]
        stays = [d for d in days(group) if d is not None]
        expected.append((*key[:-1], mean(p["indice_pressao"] for p in known), min(levels, default=None),
                         per_thousand(sum(stays), spot) if stays else None, per_thousand(len(group), spot)))
    names = ["uf", "nome_municipio", "latitude", "longitude", "regiao_saude", "indice_pressao_medio", "nivel_risco_regiao",
             "internacoes_por_1000hab", "admissoes_por_1000hab"]
    same(views.pressure_by_region(*star, count_rate=True), names, expected)
    assert views.pressure_by_region(*star).columns == names[:-1]


def test_ranking(star):
    world = Expected(star)
    alarming = [(p, world.dim[p["cnes_id"]], spot) for p in world.pressure.values()
                if p["nivel_risco"] in ("Crítico", "Sobrecarga iminente") and p["cnes_id"] in world.dim
                for spot in world.spots(world.dim[p["cnes_id"]])]

    def place(p):
        level = -1 if p["indice_pressao"] is None else p["indice_pressao"]
        rivals = [q["indice_pressao"] for q, *_ in alarming if (q["ano"], q["mes"]) == (p["ano"], p["mes"])]
        return 1 + sum((-1 if v is None else v) > level for v in rivals)

    expected = [(f["nome_estabelecimento"], f["uf"], of(s, "nome_municipio"), p["ano"], p["mes"], p["indice_pressao"],
                 p["nivel_risco"], p["qtd_internacoes"], p["permanencia_media"], place(p)) for p, f, s in alarming]
    names = ["nome_estabelecimento", "uf", "nome_municipio", "ano", "mes", "indice_pressao", "nivel_risco",
             "qtd_internacoes", "permanencia_media", "ranking_criticidade"]
    ranking = views.critical_ranking(*star[1:])
    same(ranking, names, expected)
    latest = sorted((row for row in expected if row[1] == "SP"), key=lambda row: (-row[3], -row[4], row[9], row[0]))
    got = reports.pressure_ranking(ranking, "SP", 10).collect()
    assert [r.ranking_criticidade for r in got] == [row[9] for row in latest[:10]]


def test_trend(star):
    world = Expected(star)
    weeks = gathered(((a, world.dim.get(a["cnes_id"])) for a in world.fact), lambda a, f: (
        of(f, "uf"), a["cid_principal"], a["ano"], a["mes"], a["semana_epidemiologica"]))
    trend = trends.disease_trend(star[0], star[1])
    found = [r.asDict() for r in trend.collect()]
    series = ["uf", "cid_principal", "ano", "mes", "semana_epidemiologica"]
    assert {tuple(r[n] for n in series): r["qtd_casos"] for r in found} == {k: len(g) for k, g in weeks.items()}
    by_month = gathered(((r,) for r in found), lambda r: tuple(r[n] for n in series[:4]))
    expected = [(*key, sum(r["qtd_casos"] for r, in group), mean(r["variacao_pct"] for r, in group))
                for key, group in by_month.items()]
    same(views.monthly_trend(trend), [*series[:4], "qtd_casos_mes", "variacao_media_pct"], expected)


def test_case_reports(star):
    cases = list(Expected(star).cases(in_slice))
    months = gathered(cases, lambda a, f, s: (a["ano"], a["mes"], f["uf"], of(s, "nome_municipio")))
    same(reports.case_overview(*star[:3], CASES),
         ["ano", "mes", "uf", "nome_municipio", "qtd_internacoes", "valor_total_pago", "permanencia_media"],
         [(*key, len(group), sum(a["valor_total"] for a, *_ in group), mean(days(group))) for key, group in months.items()])
    regions = gathered(cases, lambda a, f, s: (f["uf"], of(s, "nome_municipio"), f["latitude"], f["longitude"],
                                               of(s, "regiao_saude"), of(s, "populacao")))
    same(reports.case_map(*star[:3], CASES),
         ["uf", "nome_municipio", "latitude", "longitude", "regiao_saude", "qtd_casos", "casos_por_1000hab"],
         [(*key[:-1], len(group), per_thousand(len(group), group[0][2])) for key, group in regions.items()])
    by_name = gathered(cases, lambda a, f, s: (f["nome_estabelecimento"], f["uf"], of(s, "nome_municipio")))
    listed = sorted(by_name.items(), key=lambda item: (-len(item[1]), item[0][0], item[0][2] is None, item[0][2] or ""))
    same(reports.facilities_by_cases(*star[:3], CASES, n=3),
         ["nome_estabelecimento", "uf", "nome_municipio", "qtd_casos", "permanencia_media", "ranking_criticidade"],
         [(*key, len(group), mean(days(group)), 1 + sum(len(other) > len(group) for other in by_name.values()))
          for key, group in listed[:3]])


def test_figures(spark, rows):
    overview = spark.createDataFrame(
        [(2022, 1, "SP", "P", 3, 1.5, 2.0), (2022, 2, "SP", None, 1, 2.5, 4.0), (2023, 1, "SP", "Q", 5, None, None)],
        "ano int, mes int, uf string, nome_municipio string, qtd_internacoes long, valor_total_pago double, "
        "permanencia_media double")
    assert rows(reports.headline_kpis(overview)) == [(9, 4.0, 3.0, 2)]
    assert rows(reports.cases_by_year(overview)) == [(2022, 4), (2023, 5)]
    assert rows(reports.top_municipalities(overview, 1)) == [("Q", 5)]
    ranking = spark.createDataFrame([("a", "Crítico", 50.0), ("a", "Sobrecarga iminente", 70.0), ("b", "Crítico", 30.0)],
                                    "nome_estabelecimento string, nivel_risco string, indice_pressao double")
    assert rows(reports.pressure_headline(ranking)) == [(50.0, 1, 2)]
    assert [tuple(r) for r in reports.value_counts(ranking, "nivel_risco").collect()] == [
        ("Crítico", 2), ("Sobrecarga iminente", 1)]


def test_empty_reports_stay_typed(star):
    nothing = CaseSlice(("Z99",), "SP", 2022, 2023)
    assert reports.case_overview(*star[:3], nothing).isEmpty()
    assert reports.headline_kpis(reports.case_overview(*star[:3], nothing)).first().municipios_afetados == 0


def test_timeline(spark):
    trend = spark.createDataFrame([("A90", 2023, 2, 5, 1.0), ("A90", 2022, 12, 4, None)],
                                  "cid_principal string, ano int, mes int, qtd_casos_mes long, variacao_media_pct double")
    assert [str(r.periodo) for r in reports.timeline(trend).collect()] == ["2022-12-01", "2023-02-01"]
    assert [str(r.periodo) for r in reports.timeline(trend, True).collect()] == ["2023-02-01", "2022-12-01"]


def test_silver_admissions(spark):
    names = schemas.ADMISSIONS.names
    base = dict.fromkeys(names, None)
    raw = [dict(base, N_AIH="1", DT_INTER="20230105", DIAS_PERM=2, VAL_TOT=5.0),
           dict(base, N_AIH="1", DT_INTER="20230106", DIAS_PERM=9, VAL_TOT=5.0),
           dict(base, N_AIH="2", DT_INTER="05/01/2023", DIAS_PERM=2, VAL_TOT=5.0),
           dict(base, N_AIH="3", DT_INTER="2023-01-01", DIAS_PERM=-2, VAL_TOT=5.0),
           dict(base, N_AIH="3", DT_INTER="2023-01-02", DIAS_PERM=2, VAL_TOT=5.0),
           dict(base, N_AIH="4", DT_INTER="2023-01-02", DIAS_PERM=4294967296, VAL_TOT=5.0)]
    bronze = spark.createDataFrame([tuple(r[n] for n in names) for r in raw], schemas.ADMISSIONS).withColumn("uf", F.lit("SP"))
    got = silver.silver_admissions(bronze)
    assert got.columns == schemas.SILVER_ADMISSIONS.names
    # A rejected copy takes its admission with it, as copies are removed before the rules.
    assert [(r.N_AIH, r.dias_permanencia, r.semana_epidemiologica) for r in got.collect()] == [("1", 2, 1)]
    assert gold.dim_time(got).first().trimestre == 1


def test_registry_drops_facilities_whose_latest_state_is_unknown(spark):
    def record(code, state, date):
        return (code, "n", 5, state, 1, None, None, 1, None, date)
    raw = spark.createDataFrame([record(1, 35, "2020-01-01"), record(1, 99, "2021-01-01"), record(2, 35, None)],
                                schemas.REGISTRY)
    got = silver.silver_registry(raw).collect()
    assert [(r.cnes_id, r.uf, r.leitos_sus, r.eh_tipo_hospitalar) for r in got] == [(2, "SP", None, True)]


def test_plans_have_no_nested_loops_or_ungrouped_windows(star):
    for df in (views.overview(*star), views.pressure_by_region(*star), views.critical_ranking(*star[1:]),
               reports.case_map(*star[:3], CASES), trends.disease_trend(star[0], star[1])):
        plan = plan_of(df)
        assert "NestedLoop" not in plan
        assert "Cartesian" not in plan
        assert "SinglePartition" not in plan


def test_slices_reach_the_scan(spark, star, tmp_path):
    path = str(tmp_path / "fact")
    star[0].write.partitionBy("ano", "mes").parquet(path)
    fact = spark.read.schema(schemas.FACT).parquet(path)
    plan = plan_of(reports.case_overview(fact, *star[1:3], CASES))
    scan = plan[plan.index("FileScan parquet"):].split("\n")[0]
    assert "PartitionFilters: [isnotnull(ano" in scan
    assert "EqualTo(cid_principal,A90)" in scan or "In(cid_principal" in scan
    assert "municipio_id" not in scan
    view = plan_of(views.overview(fact, *star[1:]).filter("ano = 2022 AND uf = 'SP'"))
    assert "ano" in view[view.index("PartitionFilters"):].split("]")[0]
