"""Silver and its id index taken on by month, beside building them anew, and what that writes and shuffles."""

from dataclasses import replace

import pytest
from plans import plan_of
from pyspark.sql import functions as F

from wardline import schemas
from wardline.plans import full_run as runs, landing, months
from wardline.sources import tables


def land(spark, paths, year, month, ids, cost=1.0, day=None):
    rows = [(None if i is None else str(i), "SP", 1, 1, f"{year}-{day or month:02d}-{(i or 0) % 27 + 1:02d}", None, "A90", "p",
             cost + (i or 0), (i or 0) % 9 - ((i or 1) % 11 == 0) * 20, 30, "F", 0, (i or 0) % 5 + 1) for i in ids]
    landing.land_admissions(spark.createDataFrame(rows, schemas.ADMISSIONS), paths.admissions, "SP", year, month)


def build(spark, paths):
    bronze = runs.read_drifting_parquet(spark, paths.admissions, schemas.ADMISSIONS, schemas.ADMISSION_PARTITIONS)
    runs.write_partitioned(runs.silver.silver_admissions(bronze), f"{paths.silver}/internacoes", ["ano", "mes", "uf"])
    months.build_index(spark, paths.admissions, paths.silver)


def state(spark, paths, rows):
    index = tables.read_table(spark, f"{paths.silver}/ids", months.INDEX).withColumn("meses", F.array_join("meses", ","))
    return rows(tables.read_table(spark, f"{paths.silver}/internacoes", schemas.SILVER_ADMISSIONS)), rows(index)


@pytest.fixture
def lake(spark, tmp_path):
    paths = runs.Paths(*[f"{tmp_path}/{name}" for name in ("admissions", "registry", "municipalities", "silver", "gold")])
    land(spark, paths, 2022, 1, [None, *range(0, 30)])
    land(spark, paths, 2022, 2, [None, *range(20, 60)], cost=0.5)
    land(spark, paths, 2022, 3, range(25, 65), day=2)  # 25 to 29 are in three months
    return paths


def test_silver_and_index_by_month_are_those_of_a_build(spark, lake, rows, tmp_path, monkeypatch):
    build(spark, lake)
    fresh = replace(lake, silver=f"{tmp_path}/silver2")
    aside = []
    monkeypatch.setattr(months, "materialize", lambda df, name, write=months.materialize: aside.append(name) or write(df, name))
    land(spark, lake, 2022, 4, [*range(10, 35), 900], cost=0.1)
    months.update_silver(spark, lake.admissions, lake.silver, ["202204"])
    build(spark, fresh)
    assert state(spark, lake, rows) == state(spark, fresh, rows)
    land(spark, lake, 2022, 1, [11], day=5)  # month 1 loses its rows, the null id falls back to month 2
    land(spark, lake, 2022, 4, [77], day=6)
    months.update_silver(spark, lake.admissions, lake.silver, ["202201", "202204"])
    build(spark, fresh)
    found = state(spark, lake, rows)
    assert found == state(spark, fresh, rows) and any(row[0] is None for row in found[1])
    # neither the copies nor the partitions that are replaced are written a second time
    assert not {"copies", "content"} & set(aside)


def test_an_index_of_many_months(spark, rows):
    names = [f"{2000 + at // 12}{at % 12 + 1:02d}" for at in range(140)]
    copies = [("a", name) for name in names] + [("b", names[139]), ("b", names[139]), ("c", names[62]), ("c", names[63]),
                                                (None, names[126]), (None, names[0]), ("", names[5]), ("d", names[125])]
    bronze = spark.createDataFrame(copies, "N_AIH string, ano_mes string")
    stayed = spark.createDataFrame([("a", 2000, 1, "SP"), (None, 2001, 2, "RJ"), ("", 2002, 3, "MG")],
                                   "N_AIH string, ano int, mes int, uf string")
    index = months._indexed(bronze, stayed, names[::-1])
    assert index.schema.names == months.INDEX.names
    assert {row.N_AIH: (row.meses, row.ano, row.mes, row.uf) for row in index.collect()} == {
        "a": (names, 2000, 1, "SP"), "b": ([names[139]], None, None, None), "c": ([names[62], names[63]], None, None, None),
        "d": ([names[125]], None, None, None), "": ([names[5]], 2002, 3, "MG"), None: ([names[0], names[126]], 2001, 2, "RJ")}


def test_an_index_is_gathered_in_place_with_one_shuffle_of_each_side(spark, lake):
    plan = plan_of(months._indexed(spark.createDataFrame([("a", "202201")], "N_AIH string, ano_mes string"),
                                   spark.createDataFrame([("a", 1, 1, "SP")], "N_AIH string, ano int, mes int, uf string").hint("merge"),
                                   ["202201", "202202"]))
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan and "collect_set" not in plan
    assert plan.count("hashpartitioning") == 2
