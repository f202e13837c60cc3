"""Facility-level partial sums that the reports are built from.

Reports count admissions by municipality, state or name, and weigh monthly
indices by admissions. Joining the fact to facilities, municipalities and
indices row by row would carry every admission through three joins. Counts and
sums can be taken first: one row per facility and period, combined before the
shuffle, gives the same totals afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wardline.functions.numbers import cents, money_total, odd_money


def facility_rollup(fact: DataFrame, keys: list[str], stay: str = "dias_permanencia",
                    money: str | None = None) -> DataFrame:
    """Partial sums by `keys`: `_n` rows, `_days` over `_stays` known stays and, if asked for, money."""
    parts = [F.count("*").alias("_n"), F.sum(F.col(stay).cast("bigint")).alias("_days"),
             F.count(stay).alias("_stays")]
    if money:
        parts += [F.sum(cents(money)).alias("_cents"), F.sum(odd_money(money)).alias("_odd")]
    return fact.groupBy(*keys).agg(*parts)


def rows() -> Column:
    return F.sum("_n")


def total_money() -> Column:
    return money_total(F.sum("_cents"), F.sum("_odd"))


def total_days() -> Column:
    return F.sum("_days")


def mean_stay() -> Column:
    return F.try_divide(F.sum("_days").cast("double"), F.sum("_stays"))


def mean_by_rows(value: str) -> Column:
    """Mean of a per-facility value over the admissions behind it; NULL values do not count."""
    known = F.when(F.col(value).isNotNull(), F.col("_n"))
    return F.try_divide(F.sum(F.col(value) * F.col("_n")), F.sum(known))
