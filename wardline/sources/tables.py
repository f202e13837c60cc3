"""Flat files and tables with a declared schema. Nothing is inferred from the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from wardline import schemas
from wardline.functions.casts import lenient_cast
from wardline.sources.harmonize import harmonize, require_columns


_BROKEN = "_corrupt_record"


def _as_text(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in schema.names])


def read_registry(spark: SparkSession, path: str, schema: T.StructType = schemas.REGISTRY) -> DataFrame:
    """Facility registry from JSON Lines.

    Fields are scanned as text and then cast, so a code written as `"35"` in
    one file and `35` in another is the same code, and a bad value costs one
    NULL and not the record. A line that is no JSON object is a record of NULLs,
    which no later step keeps; `broken_registry_lines` lists them.
    """
    return harmonize(spark.read.schema(_as_text(schema)).json(path), schema)


def broken_registry_lines(spark: SparkSession, path: str, schema: T.StructType = schemas.REGISTRY) -> DataFrame:
    """`file`, `line`: the lines that are no JSON object, to be counted and looked at."""
    fields = _as_text(schema).add(_BROKEN, T.StringType())
    lines = (spark.read.schema(fields).option("columnNameOfCorruptRecord", _BROKEN).json(path)
             .withColumn("file", F.input_file_name()))
    return lines.where(F.col(_BROKEN).isNotNull() & F.col(schema.names[0]).isNull()).select("file", F.col(_BROKEN).alias("line"))


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet table; with a schema given, no footer is read to plan the query."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Headered CSV, all columns text; a quote inside a quoted value is doubled.

    The names come from the first file. A file whose header differs from them,
    in its order too, fails the read: its values would land in other columns.
    """
    reader = spark.read.option("header", True).option("escape", '"')
    names = reader.csv(path).schema
    return reader.schema(names).option("enforceSchema", False).csv(path)


def _read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return harmonize(require_columns(read_csv(spark, path), schema.names), schema)


def read_municipalities(spark: SparkSession, path: str) -> DataFrame:
    """Municipality reference, a headered CSV that must have all six columns."""
    return _read_csv(spark, path, schemas.MUNICIPALITIES)


def read_coordinates(spark: SparkSession, path: str) -> DataFrame:
    """Municipality coordinates, a headered CSV."""
    return _read_csv(spark, path, schemas.COORDINATES)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """Input of the occupancy index, a headered CSV."""
    return _read_csv(spark, path, schemas.PRESSURE_FEATURES)


def read_code_list(spark: SparkSession, path: str, column: str = "cnes_id") -> DataFrame:
    """Distinct facility codes of a headered CSV: from `column`, else from the first column."""
    table = read_csv(spark, path)
    source = column if column in table.columns else table.columns[0]
    code = lenient_cast(F.col(f"`{source}`"), T.StringType(), T.LongType())
    return table.select(code.alias(column)).dropna().distinct()
