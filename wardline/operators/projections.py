"""Column subsets, placeholders and canonical types."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F, types as T

from wardline.functions.numbers import as_integer

# How each landed column is typed.
TEXT_FIELDS = ("N_AIH", "UF_ZI", "DIAG_PRINC", "PROC_REA", "SEXO")
DATE_FIELDS = ("DT_INTER", "DT_SAIDA")
INTEGER_FIELDS = ("MUNIC_RES", "MUNIC_MOV", "DIAS_PERM", "IDADE", "MORTE", "CNES")
DECIMAL_FIELDS = ("VAL_TOT",)


def with_typed_nulls(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add NULL columns that already have their final type (never VOID)."""
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in schema.fields})


def canonicalize(df: DataFrame, text: Iterable[str] = TEXT_FIELDS, dates: Iterable[str] = DATE_FIELDS,
                 integers: Iterable[str] = INTEGER_FIELDS, decimals: Iterable[str] = DECIMAL_FIELDS) -> DataFrame:
    """One type per landed column, whatever the source file had.

    Real dates become `yyyy-MM-dd` text (Parquet timestamps vary in unit and
    cannot all be read back); numbers that do not parse become NULL. Missing
    text stays NULL. Columns not listed, or not present, are left alone.
    """
    text, dates, integers, decimals = map(set, (text, dates, integers, decimals))
    columns = []
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if field.name in dates and isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            value = F.date_format(value, "yyyy-MM-dd")
        elif field.name in text or field.name in dates:
            value = value.cast("string")
        elif field.name in integers:
            value = as_integer(value)
        elif field.name in decimals:
            value = value.try_cast("double")
        columns.append(value.alias(field.name))
    return df.select(*columns)
