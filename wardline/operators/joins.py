"""Joins of facts, facilities and municipalities.

No join here carries a broadcast hint: registry and municipality tables grow
with the country, so their sizes are left to be checked by Spark, statically
against `autoBroadcastJoinThreshold` and at run time by AQE.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

_CODE = "_wardline_code"


def with_state(fact: DataFrame, dim: DataFrame, key: str = "cnes_id", state: str = "uf") -> DataFrame:
    """Add the facility's state; NULL for a facility the dimension does not have."""
    return fact.join(dim.select(key, state), key, "left")


def with_facility(fact: DataFrame, dim: DataFrame, columns: Iterable[str], key: str = "cnes_id") -> DataFrame:
    """Add facility attributes; rows of a facility the dimension does not have are dropped."""
    return fact.join(dim.select(key, *columns), key)


def join_municipality(df: DataFrame, municipalities: DataFrame, columns: Iterable[str],
                      code: str = "codigo_municipio", reference_code: str = "codigo_municipio") -> DataFrame:
    """Left join to the municipality reference by code, with or without its check digit.

    The reference has 7-digit codes; `df` may have the same code or its first
    six digits. As a condition that is `a = b OR a = b div 10`, which Spark can
    only run as a nested loop. Listing both spellings on the reference side
    makes it a plain equality; a code equal to its own stem is listed once, so
    no pair can match twice.
    """
    full = F.col(reference_code).cast("bigint")
    stem = F.expr(f"cast(`{reference_code}` AS bigint) div 10")
    spellings = municipalities.select(F.explode(F.array_distinct(F.array(full, stem))).alias(_CODE), *columns)
    return df.join(spellings, df[code].cast("bigint") == spellings[_CODE], "left").drop(_CODE)


def missing_members(fact: DataFrame, dim: DataFrame, key: str = "cnes_id") -> DataFrame:
    """Keys the fact uses and the dimension lacks."""
    return fact.select(key).distinct().join(dim.select(key), key, "left_anti")


def restrict_to_codes(df: DataFrame, codes: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in the code list."""
    return df.join(codes.select(F.col(codes.columns[0]).alias(key)), key, "left_semi")


def with_inferred_members(dim: DataFrame, missing: DataFrame, key: str = "cnes_id",
                          flag: str = "is_inferred") -> DataFrame:
    """The dimension plus a placeholder row for every missing key.

    Placeholders keep fact joins complete; their attributes are NULL and they
    are flagged, so they can be told from real facilities.
    """
    placeholders = missing.select(F.col(missing.columns[0]).cast(dim.schema[key].dataType).alias(key),
                                  F.lit(True).alias(flag))
    return dim.withColumn(flag, F.lit(False)).unionByName(placeholders, allowMissingColumns=True)


def fill_population(municipalities: DataFrame, population: DataFrame, fallback: int | Column,
                    code: str = "codigo_municipio", value: str = "populacao",
                    flag: str = "is_estimated") -> DataFrame:
    """Set the population from `population`, else to `fallback`, and flag the latter.

    A code that `population` has more than once counts with its greatest value,
    so no municipality is multiplied; callers that know which is the latest
    reduce it themselves.
    """
    known = population.groupBy(code).agg(F.max(value).alias("_known"))
    fallback = fallback if isinstance(fallback, Column) else F.lit(fallback)
    kept = [name for name in municipalities.columns if name != value]
    return municipalities.join(known, code, "left").select(
        *kept, F.coalesce("_known", fallback.cast("bigint")).alias(value), F.col("_known").isNull().alias(flag))


def fill_coordinates(dim: DataFrame, coordinates: DataFrame, code: str = "codigo_municipio",
                     flag: str = "is_coord_estimated") -> DataFrame:
    """Give facilities without a position that of their municipality, flagged.

    A position counts only whole: with one half missing both halves are taken
    from the municipality. A facility is never multiplied: a code that the
    reference has more than once, or that is also another code without its
    check digit, has one point, that of the full code before that of a stem and
    then the least.
    """
    full = F.col("codigo_ibge").cast("bigint")
    spelled = F.array(F.struct(full.alias("code"), F.lit(0).alias("rank")),
                      F.struct(F.expr("cast(codigo_ibge AS bigint) div 10").alias("code"), F.lit(1).alias("rank")))
    points = (coordinates.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
              .select(F.explode(spelled).alias("_spelled"), "latitude", "longitude")
              .groupBy(F.col("_spelled.code").alias(_CODE))
              .agg(F.min(F.struct("_spelled.rank", "latitude", "longitude")).alias("_point")))
    joined = dim.join(points, dim[code].cast("bigint") == points[_CODE], "left").drop(_CODE)
    lacking = F.col("latitude").isNull() | F.col("longitude").isNull()
    filled = {axis: F.when(lacking & F.col("_point").isNotNull(), F.col(f"_point.{axis}")).otherwise(F.col(axis))
              for axis in ("latitude", "longitude")}
    return (joined.withColumns({flag: lacking & F.col("_point").isNotNull(), **{f"_{a}": c for a, c in filled.items()}})
            .drop("latitude", "longitude", "_point")
            .withColumnsRenamed({"_latitude": "latitude", "_longitude": "longitude"})
            .select(*dim.columns, flag))
