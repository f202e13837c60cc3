"""Month spines and what is missing from them."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wardline.functions.dates import year_month


def _months(df: DataFrame, first: Column | str, last: Column | str) -> DataFrame:
    steps = F.sequence(first, last, F.expr("interval 1 month"))
    start = df.select(F.explode(steps).alias("inicio"))
    year, month = F.year("inicio"), F.month("inicio")
    return start.select(year.alias("ano"), month.alias("mes"), year_month(year, month).alias("ano_mes"))


def month_spine(spark: SparkSession, first_year: int, first_month: int, last_year: int,
                last_month: int) -> DataFrame:
    """(`ano`, `mes`, `ano_mes`) of every month from first to last, both included."""
    first, last = datetime.date(first_year, first_month, 1), datetime.date(last_year, last_month, 1)
    if first > last:
        raise ValueError(f"the first month ({first:%Y-%m}) is after the last ({last:%Y-%m})")
    return _months(spark.range(1), F.lit(first), F.lit(last))


def spine_of(df: DataFrame, date_col: str) -> DataFrame:
    """The spine from the earliest to the latest month of a date column."""
    bounds = df.agg(F.trunc(F.min(date_col), "month").alias("first"), F.trunc(F.max(date_col), "month").alias("last"))
    return _months(bounds, F.col("first"), F.col("last"))


def missing_months(df: DataFrame, spine: DataFrame, key: str = "ano_mes") -> DataFrame:
    """Months of the spine that have no rows in `df`."""
    return spine.join(df.select(key).distinct(), key, "left_anti")
