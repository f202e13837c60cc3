"""Writers. All of them take any path Spark can write to."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def write_table(df: DataFrame, path: str) -> None:
    """Replace a Parquet table."""
    df.write.mode("overwrite").parquet(path)


def write_partitioned(df: DataFrame, path: str, columns: list[str], colocate: bool = True,
                      sort_by: list[str] | None = None) -> None:
    """Replace a Parquet table partitioned by `columns`.

    `colocate` gathers the rows of a partition first, so that a folder gets few
    large files. It is a rebalance and not a plain repartition: AQE splits a
    partition that is larger than the advisory size over several tasks (one
    state-month may hold a third of the table) and merges small ones. Without
    it rows stay where they are, which suits input already laid out this way.
    `sort_by` orders the rows within a file, so that filters on those columns
    skip row groups; the writer sorts by partition anyway, this extends that sort.
    """
    if colocate:
        df = df.hint("rebalance", *[F.col(name) for name in columns])
    if sort_by:
        df = df.sortWithinPartitions(*columns, *sort_by)
    df.write.mode("overwrite").partitionBy(*columns).parquet(path)


def land_month(df: DataFrame, root: str, keys: tuple[str, ...] = ("uf", "ano_mes")) -> None:
    """Land months idempotently: partitions present in `df` are replaced, all others stay.

    An empty `df` changes nothing.
    """
    (df.hint("rebalance", *[F.col(key) for key in keys])
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(root))


def land_registry(df: DataFrame, root: str, state: str = "uf") -> None:
    """Append one run's registry records as JSON Lines under their state."""
    df.write.mode("append").partitionBy(state).json(root)


def write_csv(df: DataFrame, path: str) -> None:
    """Replace a headered CSV table; a quote inside a quoted value is doubled."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
