"""The whole run: Bronze files to Gold tables and views, in order of dependency."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wardline import schemas
from wardline.plans import gold, months as by_month, pressure, silver, trends
from wardline.sinks.catalog import publish, register_views
from wardline.sinks.writers import write_partitioned, write_table
from wardline.sources.partitioned import read_drifting_parquet
from wardline.sources.tables import read_registry, read_table


@dataclass(frozen=True)
class Paths:
    """Where a run reads and writes; any file system Spark knows."""

    admissions: str
    registry: str
    municipalities: str
    silver: str
    gold: str


def _together(*writes: Callable[[], None]) -> None:
    """Run writes that do not depend on each other as concurrent jobs; the first error is raised."""
    with ThreadPool(len(writes)) as pool:
        for done in [pool.apply_async(write) for write in writes]:
            done.get()


def _build_registry(spark: SparkSession, paths: Paths) -> None:
    registry = silver.silver_registry(read_registry(spark, paths.registry))
    write_partitioned(registry, f"{paths.silver}/estabelecimentos", ["uf"], colocate=False)


def build_silver(spark: SparkSession, paths: Paths) -> None:
    bronze = read_drifting_parquet(spark, paths.admissions, schemas.ADMISSIONS, schemas.ADMISSION_PARTITIONS)
    admissions = silver.silver_admissions(bronze)
    _together(
        lambda: write_partitioned(admissions, f"{paths.silver}/internacoes", ["ano", "mes", "uf"]),
        lambda: _build_registry(spark, paths),
    )
    # Fixed value: the name under which a look at the new Silver admissions is offered.
    read_table(spark, f"{paths.silver}/internacoes", schemas.SILVER_ADMISSIONS).createOrReplaceTempView("silver_internacoes_preview")


def _in_months(months: list[tuple[int, int]]) -> Column:
    return reduce(lambda a, b: a | b, [(F.col("ano") == year) & (F.col("mes") == month) for year, month in months], F.lit(False))


def build_gold(spark: SparkSession, paths: Paths, months: list[tuple[int, int]] | None = None,
               published: DataFrame | None = None) -> None:
    """Star schema and indicator tables.

    With `months` only those of the fact are written, the others are taken from
    `published`, the fact as it is. The indicators compare facilities and weeks
    over the whole fact, so they are always computed from all of it.

    Indicators read the fact that was just written, three columns of it, and
    not the Silver table again. Silver is laid out by month, so the fact needs
    no shuffle to be written by month; within a month it is ordered by diagnosis,
    which is what reports select by.
    """
    admissions = read_table(spark, f"{paths.silver}/internacoes", schemas.SILVER_ADMISSIONS)
    registry = read_table(spark, f"{paths.silver}/estabelecimentos", schemas.SILVER_REGISTRY)
    if months is not None:
        admissions = admissions.where(_in_months(months))
    _together(
        lambda: write_table(gold.dim_hospital(registry), f"{paths.gold}/dim_hospital"),
        lambda: write_partitioned(gold.fact(admissions), f"{paths.gold}/fato_internacoes", ["ano", "mes"],
                                  colocate=False, sort_by=["cid_principal", "cnes_id"]),
    )
    fact = read_table(spark, f"{paths.gold}/fato_internacoes", schemas.FACT)
    if months is not None:
        fact = fact.unionByName(published.where(~_in_months(months)))
    dim = read_table(spark, f"{paths.gold}/dim_hospital", schemas.DIM_HOSPITAL)
    features = pressure.pressure_features(fact)
    _together(
        lambda: write_table(gold.dim_time(fact), f"{paths.gold}/dim_tempo"),
        lambda: write_table(trends.disease_trend(fact, dim), f"{paths.gold}/kpi_tendencia_doencas"),
        lambda: write_table(pressure.pressure_levels(features), f"{paths.gold}/kpi_pressao_hospitalar"),
    )


def full_run(spark: SparkSession, paths: Paths, database: str = "gold", keep_index: bool = False) -> dict[str, DataFrame]:
    """Silver, Gold, tables and views; returns the business views by name.

    Gold is written to a folder of its own under `paths.gold` for every run, and
    the tables are pointed at it when all of it is there: until then, and if the
    run ends before, they show the run before. Folders of earlier runs stay until
    they are cleared. With `keep_index` the id index that `month_run` needs is
    written beside Silver.
    """
    build_silver(spark, paths)
    if keep_index:
        by_month.build_index(spark, paths.admissions, paths.silver)
    staged = _staged(paths)
    build_gold(spark, staged)
    publish(spark, staged.gold, paths.municipalities, database)
    return register_views(spark, database)


def month_run(spark: SparkSession, paths: Paths, landed: list[str], database: str = "gold") -> dict[str, DataFrame]:
    """What `full_run` gives after the months `landed` (`yyyyMM`) were landed, anew or for the first time.

    Silver partitions and months of the fact that these do not change are
    neither read nor written. Needs the tables and the index of a run before.
    """
    changed = by_month.update_silver(spark, paths.admissions, paths.silver, landed)
    _build_registry(spark, paths)
    staged = _staged(paths)
    build_gold(spark, staged, changed, spark.table(f"{database}.fato_internacoes"))
    publish(spark, staged.gold, paths.municipalities, database, changed)
    return register_views(spark, database)


def _staged(paths: Paths) -> Paths:
    now = datetime.datetime.now(datetime.timezone.utc)
    return replace(paths, gold=f"{paths.gold}/run-{now:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}")
