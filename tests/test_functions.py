import datetime as dt

import pytest

from pyspark.sql import functions as F

from wardline.functions import codes, dates, numbers


def values(df, column):
    return [row[0] for row in df.select(column).collect()]


def test_mixed_dates(spark):
    texts = ["2023-01-31", "20230131", "2023-02-30", "20230230", "31/01/2023", "2023-01-31 00:00:00", "", None,
             "20230131\n", " 2023-01-31", "2023-1-31", "202301311"]
    df = spark.createDataFrame([(t,) for t in texts], "d string")
    day = dt.date(2023, 1, 31)
    assert values(df, dates.parse_mixed_date("d")) == [day, day] + [None] * 10


def test_a_timestamp_is_no_admission_date(spark):
    df = spark.sql("SELECT timestamp'2023-01-31 00:00:00' AS d")
    assert values(df, dates.parse_mixed_date("d")) == [None]


def test_calendar_uses_iso_weeks(spark):
    df = spark.createDataFrame([(dt.date(2021, 1, 1),), (dt.date(2020, 12, 31),), (dt.date(2021, 1, 4),), (None,)],
                               "d date")
    got = dates.with_calendar(df, "d").drop("d").collect()
    assert [tuple(r) for r in got] == [(2021, 1, 53), (2020, 12, 53), (2021, 1, 1), (None, None, None)]


def test_quarters_and_month_keys(spark):
    df = spark.range(1, 13).select(F.col("id").cast("int").alias("mes"), F.lit(2023).alias("ano"))
    assert values(df, dates.quarter_of("mes")) == [1, 1, 1, 2, 2, 2, 3, 3, 3, 4, 4, 4]
    assert values(df, dates.year_month("ano", "mes"))[:2] == ["202301", "202302"]
    assert values(df, dates.month_start("ano", "mes"))[11] == dt.date(2023, 12, 1)


def test_states(spark):
    df = spark.createDataFrame([(17,), (27,), (35,), (99,), (None,)], "c int")
    assert values(df, codes.state_abbrev("c")) == ["TO", "AL", "SP", None, None]


def test_hospital_types(spark):
    df = spark.createDataFrame([(62,), (5,), (73,), (None,)], "c int")
    assert values(df, codes.is_hospital_type("c")) == [True, True, False, None]


def test_prefixes(spark):
    df = spark.createDataFrame([("A90",), ("a901",), ("N10",), (None,), ("B",)], "c string")
    assert values(df, codes.has_prefix("c", ["a90", "N"])) == [True, True, True, False, False]
    assert codes.split_code_list(" A90, A91 ,") == ["A90", "A91"]
    assert codes.split_code_list(None) == []


def test_percent_change(spark):
    df = spark.createDataFrame([(3, 2), (2, 0), (2, None), (1, 4)], "a long, b long")
    assert values(df, numbers.pct_change("a", "b")) == [50.0, None, None, -75.0]


def test_rates_without_population(spark):
    df = spark.createDataFrame([(5, 2000), (5, 0), (5, None)], "n long, p long")
    assert values(df, numbers.per_thousand("n", "p")) == [2.5, None, None]


def test_rounding_goes_to_even(spark):
    df = spark.createDataFrame([(0.25,), (0.35,), (86.25,), (None,)], "x double")
    assert values(df, numbers.round_tenth("x")) == [0.2, 0.4, 86.2, None]


def test_clip(spark):
    df = spark.createDataFrame([(-1.0,), (0.5,), (7.0,), (None,)], "x double")
    assert values(df, numbers.clip("x", 0.0, 1.0)) == [0.0, 0.5, 1.0, None]


def test_integers_from_text(spark):
    df = spark.createDataFrame([("12",), ("12.0",), ("12.5",), ("x",), ("",), (None,), ("NaN",),
                                ("9007199254740993",)], "x string")
    assert values(df, numbers.as_integer("x")) == [12, 12, None, None, None, None, None, 9007199254740993]


def test_money_is_exact_and_keeps_odd_values(spark):
    tenths = spark.range(1000).select(F.lit(0.1).alias("v"))
    assert tenths.agg(numbers.money_sum("v")).first()[0] == 100.0
    assert spark.createDataFrame([(None,)], "v double").agg(numbers.money_sum("v")).first()[0] is None
    odd = spark.createDataFrame([(1.5,), (float("nan"),)], "v double").agg(numbers.money_sum("v")).first()[0]
    assert odd != odd
    huge = spark.createDataFrame([(1e20,), (0.25,)], "v double").agg(numbers.money_sum("v")).first()[0]
    assert huge == 1e20 + 0.25


def test_display_numbers(spark):
    df = spark.createDataFrame([(1234567.0,)], "x double")
    assert values(df, numbers.format_thousands("x")) == ["1.234.567"]
    assert values(df, numbers.format_thousands("x", 1)) == ["1.234.567,0"]


def test_money_is_added_without_rounding_a_row(spark):
    def total(*amounts):
        df = spark.createDataFrame([(a,) for a in amounts], "v double")
        return df.select(numbers.money_sum("v").alias("s")).first().s

    assert total(*[0.004] * 1000) == pytest.approx(4.0, abs=1e-9)
    assert total(*[0.1] * 10, 0.005) == pytest.approx(1.005, abs=1e-12)
    assert total(*[0.1] * 10) == 1.0
    assert total(*[9.9e14] * 200) == 9.9e14 * 200
    assert total(1e300, 1.5) == 1e300 and total(float("inf"), 2.0) == float("inf")
    assert total(float("nan"), 2.0) != total(float("nan"), 2.0)
    assert total(None, None) is None and total(None, 2.25) == 2.25
