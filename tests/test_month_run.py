"""Runs for a few months, and what a reader sees while a run is under way."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from wardline import schemas
from wardline.plans import full_run as runs, landing, months
from wardline.sinks import writers
from wardline.sources import tables

CLUSTERED = ("cluster", "nivel_risco")  # K-Means may number and cut them otherwise


def land(spark, paths, year, month, ids, cost=1.0, day=None):
    rows = [(str(i), "SP", 1, 1, f"{year}-{day or month:02d}-{i % 27 + 1:02d}", None, "A90" if i % 2 else "J18", "p",
             cost + i, i % 9 - (i % 11 == 0) * 20, i % 90, "F", 0, i % 5 + 1) for i in ids]
    landing.land_admissions(spark.createDataFrame(rows, schemas.ADMISSIONS), paths.admissions, "SP", year, month)


@pytest.fixture
def lake(spark, tmp_path):
    paths = runs.Paths(*[f"{tmp_path}/{name}" for name in ("admissions", "registry", "municipalities", "silver", "gold")])
    land(spark, paths, 2022, 1, range(0, 60))
    land(spark, paths, 2022, 2, range(40, 120), cost=0.5)  # 40 to 59 are in both
    land(spark, paths, 2022, 3, range(100, 130), day=2)  # admitted the month before
    records = spark.createDataFrame([(i, f"H{i}", 5, 35, 350001, None, None, 1, None, "2024-01-01") for i in range(1, 6)], schemas.REGISTRY)
    writers.land_registry(records.withColumn("uf", F.lit("SP")), paths.registry)
    writers.write_csv(spark.createDataFrame([(3500015, "A", "SP", "R", 1000, 1.0)], schemas.MUNICIPALITIES), paths.municipalities)
    return paths


def state(spark, paths, database, rows):
    found = {name: rows(spark.table(f"{database}.{name}").drop(*CLUSTERED)) for name in (
        "fato_internacoes", "dim_hospital", "dim_tempo", "kpi_tendencia_doencas", "kpi_pressao_hospitalar")}
    found["silver"] = rows(tables.read_table(spark, f"{paths.silver}/internacoes", schemas.SILVER_ADMISSIONS))
    found["ids"] = rows(tables.read_table(spark, f"{paths.silver}/ids", months.INDEX).withColumn("meses", F.array_join("meses", ",")))
    return found


def test_a_run_for_some_months_equals_a_full_run(spark, lake, rows, tmp_path):
    runs.full_run(spark, lake, "by_month", keep_index=True)
    fresh = replace(lake, silver=f"{tmp_path}/silver2", gold=f"{tmp_path}/gold2")

    def check(changed):
        runs.month_run(spark, lake, changed, "by_month")
        runs.full_run(spark, fresh, "in_full", keep_index=True)
        assert state(spark, lake, "by_month", rows) == state(spark, fresh, "in_full", rows)

    land(spark, lake, 2022, 4, range(20, 70), cost=0.1)  # a new month that wins some ids and loses others
    check(["202204"])
    land(spark, lake, 2022, 2, range(110, 118), cost=9.0, day=1)  # landed again: ids leave it, others fall back to older copies
    check(["202202"])
    land(spark, lake, 2022, 3, range(500, 503), day=6)  # its month of admission loses all rows
    land(spark, lake, 2022, 5, range(11, 12))  # a row the rules reject
    check(["202203", "202205"])


def test_only_what_changed_is_written(spark, lake, rows, tmp_path):
    runs.full_run(spark, lake, "narrow", keep_index=True)
    first = {r["partition"]: location(spark, "narrow", r["partition"]) for r in spark.sql("SHOW PARTITIONS narrow.fato_internacoes").collect()}
    land(spark, lake, 2022, 7, range(900, 905))
    runs.month_run(spark, lake, ["202207"], "narrow")
    second = {r["partition"]: location(spark, "narrow", r["partition"]) for r in spark.sql("SHOW PARTITIONS narrow.fato_internacoes").collect()}
    assert set(second) == {*first, "ano=2022/mes=7"}
    assert all(second[name] == first[name] for name in first)
    again = state(spark, lake, "narrow", rows)
    runs.month_run(spark, lake, ["202207"], "narrow")
    assert state(spark, lake, "narrow", rows) == again
    runs.month_run(spark, lake, [], "narrow")
    assert state(spark, lake, "narrow", rows) == again


def location(spark, database, partition):
    year, month = (value.split("=")[1] for value in partition.split("/"))
    about = spark.sql(f"DESCRIBE FORMATTED {database}.fato_internacoes PARTITION (ano = {year}, mes = {month})")
    return about.where("col_name = 'Location'").first()["data_type"]


@pytest.mark.parametrize("broken", ["disease_trend", "pressure_levels"])
def test_a_run_that_ends_half_way_leaves_the_tables_as_they_were(spark, lake, rows, monkeypatch, broken):
    runs.full_run(spark, lake, "halted", keep_index=True)
    names = ("fato_internacoes", "dim_hospital", "dim_tempo", "kpi_tendencia_doencas", "kpi_pressao_hospitalar")
    before = {name: rows(spark.table(f"halted.{name}")) for name in names}
    land(spark, lake, 2022, 1, range(0, 5), cost=70.0)

    def stop(*_):
        raise RuntimeError("lost")

    module = runs.trends if broken == "disease_trend" else runs.pressure
    with monkeypatch.context() as patch:
        patch.setattr(module, broken, stop)
        with pytest.raises(RuntimeError, match="lost"):
            runs.full_run(spark, lake, "halted")
    assert {name: rows(spark.table(f"halted.{name}")) for name in names} == before
    runs.full_run(spark, lake, "halted")
    assert spark.table("halted.fato_internacoes").where("valor_total >= 70 AND valor_total < 75").count() > 0
