"""Casts that turn unusable values into NULL instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T


def lenient_cast(value: Column, source: T.DataType, target: T.DataType) -> Column:
    """`value` as `target`, NULL where it cannot be.

    Numeric text with a fraction (`3.0`) counts as an integer, cut at the point.
    A number too large for the target is NULL, never a wrapped value.
    """
    if source == target:
        return value
    cast = value.try_cast(target)
    if isinstance(source, T.StringType) and isinstance(target, T.IntegralType):
        return F.coalesce(cast, F.regexp_replace(value, r"\.\d*\s*$", "").try_cast(target))
    return cast
