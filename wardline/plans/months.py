"""A run for a few landed months: what they change in Silver and in the fact, and nothing else, is written anew.

Which copy of an admission stays is decided over all months, so a new month can
win or lose an id that another month has. An index beside Silver says of every
id in which landed months it has copies, and in which Silver partition the copy
that stayed is. Only the ids of the new months, and of what lay in them before,
are decided again, from the months that have copies of them.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from wardline import schemas
from wardline.plans import silver
from wardline.session import materialize
from wardline.sinks.writers import write_table
from wardline.sources.partitioned import discover_partitions, read_drifting_parquet
from wardline.sources.tables import read_table

PARTITION = ["ano", "mes", "uf"]
INDEX = T.StructType([T.StructField("N_AIH", T.StringType()), T.StructField("meses", T.ArrayType(T.StringType())),
                      *[schemas.SILVER_ADMISSIONS[name] for name in PARTITION]])
_ID = "_wardline_id"
#: Months that one whole number has bits for.
_BITS = 63


def _with_ids(df: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Rows whose id is in `ids` (`left_semi`) or is not (`left_anti`); a null id is an id."""
    ids = ids.select(F.col("N_AIH").alias(_ID))
    return df.join(ids, df["N_AIH"].eqNullSafe(ids[_ID]), how)


def _indexed(bronze: DataFrame, admissions: DataFrame, months: list[str]) -> DataFrame:
    """The index rows of all ids of `bronze`, whose months are all in `months`.

    The months of an id are gathered as bits of whole numbers, which are added up
    in place, and by the key that the join to `admissions` has, a null id as an
    id: one shuffle of each side. Lists are only made of what has been gathered.
    """
    months = sorted(months)
    words = range(-(-len(months) // _BITS))
    numbers = bronze.sparkSession.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(month).alias("ano_mes"), F.lit(at).alias("_at"), F.lit(at // _BITS).alias("_word"),
                 F.lit(1 << at % _BITS).cast("long").alias("_bit")) for at, month in enumerate(months)])))
    key = [F.coalesce("N_AIH", F.lit("")).alias(_ID), F.col("N_AIH").isNotNull().alias("_known")]
    copies = (bronze.select(*key, "ano_mes").join(F.broadcast(numbers), "ano_mes").groupBy(_ID, "_known")
              .agg(F.min("_at").alias("_first"), F.max("_at").alias("_last"),
                   *[F.bit_or(F.when(F.col("_word") == word, F.col("_bit"))).alias(f"_word{word}") for word in words]))
    names = F.array(*[F.lit(month) for month in months])
    count = reduce(add, [F.coalesce(F.bit_count(f"_word{word}"), F.lit(0)) for word in words])
    several = F.array_compact(F.array(*[
        F.when(F.col(f"_word{at // _BITS}").bitwiseAND(F.lit(1 << at % _BITS)) != 0, F.lit(month)) for at, month in enumerate(months)]))
    meses = (F.when(count == 1, F.array(F.get(names, "_first")))
             .when(count == 2, F.array(F.get(names, "_first"), F.get(names, "_last"))).otherwise(several))
    return (copies.join(admissions.select(*key, *PARTITION), [_ID, "_known"], "left")
            .select(F.when(F.col("_known"), F.col(_ID)).alias("N_AIH"), meses.alias("meses"), *PARTITION))


def _bronze(spark: SparkSession, root: str, months: list[str] | None = None) -> DataFrame:
    return read_drifting_parquet(spark, root, schemas.ADMISSIONS, schemas.ADMISSION_PARTITIONS, ("uf", "ano_mes"),
                                 only={"ano_mes": months} if months is not None else None)


def _files_of(spark: SparkSession, root: str, partitions: set[tuple[int, int, str]]) -> set[tuple[str, tuple[int, int, str]]]:
    """The files of some partitions, each with its partition. Spark lists them, none is opened."""
    if not partitions:
        return set()
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    found = files.select("path", *[F.regexp_extract("path", rf"/{name}=([^/]*)/", 1).alias(name) for name in PARTITION])
    return {(row.path, place) for row in found.where("ano != ''").collect()
            if (place := (int(row.ano), int(row.mes), row.uf)) in partitions}


def build_index(spark: SparkSession, admissions_root: str, silver_root: str) -> None:
    """The id index of the Silver admissions as they are: a narrow scan of the landed months and one shuffle by id."""
    kept = read_table(spark, f"{silver_root}/internacoes", schemas.SILVER_ADMISSIONS)
    # as many rows as there are months
    months = [row.ano_mes for row in discover_partitions(spark, admissions_root).select("ano_mes").distinct().collect()]
    write_table(_indexed(_bronze(spark, admissions_root).select("N_AIH", "ano_mes"), kept, months), f"{silver_root}/ids")


def update_silver(spark: SparkSession, admissions_root: str, silver_root: str, months: list[str]) -> list[tuple[int, int]]:
    """Bring Silver and its index up to the landed `months` (`yyyyMM`); returns the (year, month) that changed in Silver.

    The result is that of building Silver from all months. Running it again, also
    after it was ended half way, changes nothing more: what is written follows
    from the landed files and the ids alone. Only partition values, of which
    there are months times states, reach the driver.
    """
    if not months:
        return []
    index = read_table(spark, f"{silver_root}/ids", INDEX)
    nothing = spark.createDataFrame([], T.StructType([*schemas.ADMISSIONS.fields, T.StructField("uf", T.StringType()),
                                                      T.StructField("ano_mes", T.StringType())]))
    try:
        landed = _bronze(spark, admissions_root, months)
    except ValueError:  # the months hold nothing any more
        landed = nothing
    names = F.array(*[F.lit(month) for month in months])
    before = index.where(F.arrays_overlap("meses", names)).select("N_AIH")
    ids = materialize(landed.select("N_AIH").unionByName(before).distinct(), "ids")
    was = materialize(_with_ids(index, ids, "left_semi"), "was")
    # of the other months only ids that the index says have copies there
    elsewhere = was.select("N_AIH", F.array_except("meses", names).alias("meses")).where(F.size("meses") > 0)
    others = sorted(row.m for row in elsewhere.select(F.explode("meses").alias("m")).distinct().collect())
    try:
        older = _with_ids(_bronze(spark, admissions_root, others), elsewhere, "left_semi") if others else nothing
    except ValueError:
        older = nothing
    decided = materialize(silver.silver_admissions(landed.unionByName(older).drop("ano_mes")), "decided")
    touched = materialize(was.where("ano IS NOT NULL").select(*PARTITION).union(decided.select(*PARTITION)).distinct(), "touched")

    kept = read_table(spark, f"{silver_root}/internacoes", schemas.SILVER_ADMISSIONS)
    rest = _with_ids(kept.join(touched, PARTITION, "left_semi"), ids, "left_anti")
    # partitions of which every row may go: they are not replaced if none is left, and keep their files
    doubtful = {tuple(row) for row in touched.join(decided.select(*PARTITION).distinct(), PARTITION, "left_anti").collect()}
    old = _files_of(spark, f"{silver_root}/internacoes", doubtful)
    # partitions are replaced when all of them are written, so they can be read until then
    (rest.unionByName(decided).hint("rebalance", *[F.col(name) for name in PARTITION])
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITION)
     .parquet(f"{silver_root}/internacoes"))
    empty = decided.limit(0).drop(*PARTITION)
    for year, month, state in {place for _, place in old & _files_of(spark, f"{silver_root}/internacoes", doubtful)}:
        write_table(empty, f"{silver_root}/internacoes/ano={year}/mes={month}/uf={state}")

    copies = landed.select("N_AIH", "ano_mes").union(elsewhere.select("N_AIH", F.explode("meses")))
    renewed = _with_ids(index, ids, "left_anti").unionByName(_indexed(copies, decided, [*others, *set(months)]))
    write_table(materialize(renewed, "index"), f"{silver_root}/ids")
    return sorted({(row.ano, row.mes) for row in touched.select("ano", "mes").distinct().collect()})
