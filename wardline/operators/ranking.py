"""Row-to-row comparison, ranks and top lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from wardline.session import materialize


def lag_over(df: DataFrame, partition: list[str], order: list[str], column: str, name: str) -> DataFrame:
    """Add the value of the previous existing row of the group (gaps are not filled).

    Meant for aggregated series: a group is one series and has one row per period.
    """
    return df.withColumn(name, F.lag(column).over(Window.partitionBy(*partition).orderBy(*order)))


def rank_desc(df: DataFrame, partition: list[str], value: str, name: str) -> DataFrame:
    """SQL RANK by `value` descending within `partition`: ties share, gaps follow, NULLs come last.

    A rank depends on how many rows of the group have a larger value. Counts
    per distinct value are laid out by ranges of group and value, added up
    within a range and over the ranges of a group, and joined back; so neither
    a large group nor a frequent value is one task's. `df` is read twice, and
    the counts are written once so that the ranges stay as they were drawn.
    """
    order = [*[F.col(c).asc_nulls_first() for c in partition], F.col(value).desc_nulls_last()]
    counts = df.groupBy(*partition, value).agg(F.count("*").alias("_rows"))
    ranged = materialize(counts.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranks")
    ahead = Window.partitionBy(*partition).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (ranged.groupBy(*partition, "_range").agg(F.sum("_rows").alias("_rows"))
              .select(F.col("_range").alias("_in"), *[F.col(c).alias(f"_{c}") for c in partition],
                      F.coalesce(F.sum("_rows").over(ahead), F.lit(0)).alias("_ahead")))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in partition]
    within = (Window.partitionBy("_range", *partition).orderBy(F.col(value).desc_nulls_last())
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = ranged.withColumn("_above", F.coalesce(F.sum("_rows").over(within), F.lit(0)))
    ranks = placed.join(starts, [F.col("_range") == F.col("_in"), *same]).select(
        *[F.col(c).alias(f"_{c}") for c in (*partition, value)], (F.col("_ahead") + F.col("_above") + 1).alias(name))
    return _with_ranks(df, ranks, [*partition, value])


def rank_desc_few(df: DataFrame, partition: list[str], value: str, name: str) -> DataFrame:
    """`rank_desc` for values of which a group has few, such as an index with one decimal. Runs no job by itself."""
    counts = df.groupBy(*partition, value).agg(F.count("*").alias("_rows"))
    above = (Window.partitionBy(*partition).orderBy(F.col(value).desc_nulls_last())
             .rowsBetween(Window.unboundedPreceding, -1))
    ranks = counts.select(*[F.col(c).alias(f"_{c}") for c in (*partition, value)],
                          (F.coalesce(F.sum("_rows").over(above), F.lit(0)) + 1).alias(name))
    return _with_ranks(df, ranks, [*partition, value])


def _with_ranks(df: DataFrame, ranks: DataFrame, columns: list[str]) -> DataFrame:
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns]
    return df.join(ranks, same).drop(*[f"_{c}" for c in columns])


def top_ranked(df: DataFrame, by: str, n: int, name: str, ties: list[str]) -> DataFrame:
    """The `n` rows with the largest `by`, with their RANK over the whole table.

    Every row with a larger value than one of the top n is itself among them,
    so ranking the n rows gives their global ranks, and only n rows are
    gathered. `ties` settles which rows with an equal value stay.
    """
    top = df.orderBy(F.col(by).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in ties]).limit(n)
    return top.withColumn(name, F.rank().over(Window.orderBy(F.col(by).desc_nulls_last())).cast("bigint"))


def top_groups(df: DataFrame, key: str, value: str, n: int) -> DataFrame:
    """The `n` groups with the largest total; rows without a key are left out."""
    totals = df.na.drop(subset=[key]).groupBy(key).agg(F.sum(value).alias(value))
    return totals.orderBy(F.col(value).desc_nulls_last(), F.col(key)).limit(n)
