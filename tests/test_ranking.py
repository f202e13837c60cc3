import pytest
from pyspark.sql import Window, functions as F

from plans import plan_of
from wardline.operators import months, ranking
from wardline.plans import trends


def test_lag_is_the_previous_row_of_the_series(spark, rows):
    df = spark.createDataFrame(
        [("SP", "A", 2020, 12, 53, 4), ("SP", "A", 2021, 1, 1, 3), ("SP", "A", 2021, 1, 53, 6),
         ("SP", "A", 2021, 3, 9, 3), (None, "A", 2021, 1, 1, 2), (None, "A", 2021, 1, 2, 5), ("RJ", "A", 2021, 1, 1, 1)],
        "uf string, cid_principal string, ano int, mes int, semana_epidemiologica int, qtd_casos long")
    got = {(r.uf, r.ano, r.mes, r.semana_epidemiologica): r.qtd_casos_semana_anterior
           for r in trends.weekly_lag(df).collect()}
    assert got == {("SP", 2020, 12, 53): None, ("SP", 2021, 1, 1): 4, ("SP", 2021, 1, 53): 3, ("SP", 2021, 3, 9): 6,
                   (None, 2021, 1, 1): None, (None, 2021, 1, 2): 2, ("RJ", 2021, 1, 1): None}


@pytest.fixture(scope="module")
def scores(spark):
    hot = spark.range(400).select(F.lit("hot").alias("g"), "id", (F.col("id") % 7 / 2).alias("v"))
    few = spark.createDataFrame([("a", 1, 2.0), ("a", 2, 2.0), ("a", 3, 1.0), ("a", 4, None), ("a", 5, None),
                                 (None, 6, 1.0), (None, 7, 3.0), ("b", 8, None)], "g string, id long, v double")
    return hot.union(few)


def test_rank_equals_the_window(scores, rows):
    window = Window.partitionBy("g").orderBy(F.col("v").desc_nulls_last())
    expected = scores.withColumn("r", F.rank().over(window).cast("bigint"))
    assert rows(ranking.rank_desc(scores, ["g"], "v", "r")) == rows(expected)


def test_few_values_give_the_same_ranks(scores, rows):
    assert rows(ranking.rank_desc_few(scores, ["g"], "v", "r")) == rows(ranking.rank_desc(scores, ["g"], "v", "r"))
    window = plan_of(ranking.rank_desc_few(scores, ["g"], "v", "r"))
    assert "HashAggregate" in window[window.index("Window"):]


def test_a_group_of_distinct_values_is_ranked_by_ranges(spark, rows):
    many = spark.range(5000).select(F.lit("hot").alias("g"), "id", F.pmod(F.xxhash64("id"), F.lit(10 ** 9)).alias("v"))
    window = Window.partitionBy("g").orderBy(F.col("v").desc_nulls_last())
    ranked = ranking.rank_desc(many, ["g"], "v", "r")
    assert rows(ranked) == rows(many.withColumn("r", F.rank().over(window).cast("bigint")))
    # the windows over single values are within a range; the one by group alone runs on one row per range
    value_windows = [line for line in plan_of(ranked).splitlines() if "Window [" in line and "v#" in line]
    assert value_windows and all("_range" in line for line in value_windows)


def test_top_ranked_equals_rank_then_limit(scores, rows):
    everything = Window.orderBy(F.col("v").desc_nulls_last())
    expected = (scores.withColumn("r", F.rank().over(everything).cast("bigint"))
                .orderBy(F.col("v").desc_nulls_last(), F.col("id")).limit(60))
    assert rows(ranking.top_ranked(scores, "v", 60, "r", ["id"])) == rows(expected)


def test_top_ranked_gathers_only_the_top(scores):
    plan = plan_of(ranking.top_ranked(scores, "v", 3, "r", ["id"]))
    assert "TakeOrderedAndProject" in plan
    assert plan.index("Window") < plan.index("TakeOrderedAndProject")


def test_top_groups_leave_out_unknown(spark):
    df = spark.createDataFrame([("b", 2), ("a", 1), ("a", 1), (None, 9), ("c", 1)], "k string, n long")
    assert [tuple(r) for r in ranking.top_groups(df, "k", "n", 2).collect()] == [("a", 2), ("b", 2)]


def test_month_spine(spark):
    got = months.month_spine(spark, 2022, 11, 2023, 2).orderBy("ano_mes").collect()
    assert [tuple(r) for r in got] == [(2022, 11, "202211"), (2022, 12, "202212"), (2023, 1, "202301"),
                                       (2023, 2, "202302")]
    assert months.month_spine(spark, 2023, 5, 2023, 5).count() == 1
    assert months.month_spine(spark, 2020, 1, 2026, 7).count() == 79
    with pytest.raises(ValueError):
        months.month_spine(spark, 2023, 6, 2023, 5)


def test_missing_months(spark, rows):
    spine = months.month_spine(spark, 2022, 12, 2023, 2)
    df = spark.createDataFrame([("202301",), ("202301",)], "ano_mes string")
    assert rows(months.missing_months(df, spine), "ano_mes") == [("202212",), ("202302",)]


def test_spine_of_dates(spark, rows):
    df = spark.sql("SELECT explode(array(date'2022-12-31', date'2023-02-01', null)) AS d")
    assert rows(months.spine_of(df, "d"), "ano_mes") == [("202212",), ("202301",), ("202302",)]
