"""Bring a table to a declared set of columns and types."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F, types as T

from wardline.functions.casts import lenient_cast


def _by_upper_name(df: DataFrame) -> dict[str, T.StructField]:
    return {field.name.upper(): field for field in df.schema.fields}


def harmonize(df: DataFrame, target: T.StructType, keep: Iterable[str] = ()) -> DataFrame:
    """`target` columns in order, cast leniently, missing ones as typed NULLs, then `keep` as they are.

    One projection, whatever the number of columns. Names match without regard
    to case, as in Spark SQL; columns in neither list are dropped.
    """
    present = _by_upper_name(df)
    columns = []
    for field in target.fields:
        found = present.get(field.name.upper())
        value = (F.lit(None).cast(field.dataType) if found is None
                 else lenient_cast(df[f"`{found.name}`"], found.dataType, field.dataType))
        columns.append(value.alias(field.name))
    return df.select(*columns, *[df[f"`{name}`"] for name in keep])


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """`df` itself, or an error that names every required column it lacks."""
    missing = [name for name in required if name not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {', '.join(sorted(missing))}")
    return df


def normalize_names(df: DataFrame, expected: Iterable[str]) -> DataFrame:
    """Upper-case the column names and keep the expected ones that exist.

    An error if none of them does: the table holds nothing usable.
    """
    present = _by_upper_name(df)
    usable = [name for name in expected if name.upper() in present]
    if not usable:
        raise ValueError(f"none of the expected columns is present; found: {', '.join(df.columns)}")
    return df.select(*[df[f"`{present[name.upper()].name}`"].alias(name.upper()) for name in usable])
