"""One row per key, chosen the same way on every run."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

_RANK = "_wardline_rank"


def _first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    # A row_number filtered to 1 is cut down on the map side as well: every task sends at most one row
    # per key to the shuffle, so a key that holds a third of the table does not fill one reducer.
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def _ties(df: DataFrame, used: list[str]) -> list[Column]:
    return [F.col(f"`{name}`").asc_nulls_last() for name in df.columns if name not in used]


def dedup_any(df: DataFrame, keys: list[str], order: list[str] | None = None,
              keep_null_keys: bool = False) -> DataFrame:
    """One row per key; of several copies the first by `order`, ties by all other columns.

    Rows with a NULL key are copies of each other and collapse into one, unless
    `keep_null_keys`, which leaves all of them in.
    """
    order = order or []
    ranked = [F.col(name).asc_nulls_last() for name in order] + _ties(df, [*keys, *order])
    if not keep_null_keys:
        return _first(df, keys, ranked)
    known = reduce(lambda left, right: left & right, [F.col(key).isNotNull() for key in keys])
    return _first(df.filter(known), keys, ranked).unionByName(df.filter(~known))


def latest_by(df: DataFrame, keys: list[str], version: str) -> DataFrame:
    """The newest version of every key, unknown dates last, ties by all other columns."""
    return _first(df, keys, [F.col(version).desc_nulls_last(), *_ties(df, [*keys, version])])
