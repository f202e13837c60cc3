"""Standardising, clustering and the weighted index."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Window, functions as F

from wardline import vocabulary as V
from wardline.functions.numbers import clip, one_if_zero, round_tenth
from wardline.session import materialize

FITS_AT_ONCE = 10


def fill_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL and NaN features become 0."""
    types = dict(df.dtypes)
    known = {c: F.nanvl(F.col(c), F.lit(0.0)) if types[c] == "double" else F.col(c) for c in columns}
    return df.withColumns({c: F.coalesce(value, F.lit(0)) for c, value in known.items()})


def standardize(df: DataFrame, columns: Sequence[str], suffix: str = "_z") -> DataFrame:
    """Add every column scaled to mean 0 and (population) deviation 1; constants scale to 0."""
    filled = fill_zero(df, columns)
    moments = filled.agg(F.struct(
        *[F.avg(c).alias(f"{c}_mean") for c in columns],
        *[one_if_zero(F.stddev_pop(c)).alias(f"{c}_std") for c in columns]).alias("m")).scalar()
    scaled = filled.withColumn("_m", moments)
    return scaled.select(*df.columns, *[
        ((F.col(c) - F.col(f"_m.{c}_mean")) / F.col(f"_m.{c}_std")).alias(f"{c}{suffix}")
        for c in columns])


def cluster(df: DataFrame, columns: Sequence[str], keys: Sequence[str], k: int = V.CLUSTERS,
            restarts: int = V.RESTARTS, seed: int = V.SEED, name: str = "cluster") -> DataFrame:
    """Add a K-Means cluster number, from the best of `restarts` fits on standardised columns.

    Never more clusters than distinct points. Fits run on Spark, several at a time over one
    cached table of the distinct points, each with the number of its rows as its
    weight; counts and rounded means repeat, so it grows far less than the rows.
    Only centres and costs come to the driver. The input is written out once,
    and the points in their order, so that restarts do not recompute them and a
    rerun draws the same starting points. Runs jobs.
    """
    source = materialize(df.repartition(*keys).sortWithinPartitions(*keys), "features")
    scaled = [f"{c}_z" for c in columns]
    assembler = VectorAssembler(inputCols=scaled, outputCol="_features")
    rows = standardize(source, columns)
    distinct = rows.groupBy(*scaled).agg(F.count("*").cast("double").alias("_weight"))
    distinct = materialize(distinct.repartition(*scaled).sortWithinPartitions(*scaled), "points")
    k = len(distinct.select("_weight").take(k))
    if k < 2:
        return source.withColumn(name, F.lit(0 if k else None).cast("int"))
    points = assembler.transform(distinct).select("_features", "_weight").persist()

    def fit(offset: int) -> KMeansModel:
        return KMeans(featuresCol="_features", predictionCol=name, weightCol="_weight", k=k, seed=seed + offset,
                      maxIter=V.MAX_ITERATIONS, tol=math.sqrt(V.CENTRE_SHIFT / k)).fit(points)

    with ThreadPool(min(FITS_AT_ONCE, restarts)) as pool:
        models = pool.map(fit, range(restarts))
    points.unpersist()
    best = min(models, key=lambda model: model.summary.trainingCost)
    return best.transform(assembler.transform(rows)).drop("_features", *scaled)


def label_clusters(df: DataFrame, by: str, labels: Sequence[str] = V.RISK_LEVELS, cluster_col: str = "cluster",
                   name: str = "nivel_risco") -> DataFrame:
    """Name every row's cluster: clusters in ascending order of their mean of `by` get the labels in order."""
    means = df.groupBy(cluster_col).agg(F.avg(by).alias("_mean"))
    place = F.row_number().over(Window.orderBy("_mean", cluster_col))
    label = F.get(F.array(*[F.lit(text) for text in labels]), F.least(place, F.lit(len(labels))) - 1)
    named = means.select(cluster_col, label.alias(name))
    # One row per cluster, that is a handful by construction: the one place where a broadcast is forced.
    return df.join(F.broadcast(named), cluster_col, "left")


def weighted_index(df: DataFrame, weights: Mapping[str, float], name: str = "indice_pressao",
                   within: Sequence[str] = (), absolute: Mapping[str, float] | None = None) -> DataFrame:
    """Add an index: every signal as a share of its maximum, weighted, added up, to one decimal.

    The maximum is that of the whole table, or of the row's group with
    `within`; a maximum of 0 counts as 1. NULL signals count as 0. Signals in
    `absolute` are shares already and are only clipped to 0..1.
    """
    absolute = absolute or {}
    relative = list(weights)
    filled = fill_zero(df, [*relative, *absolute])
    tops = F.struct(*[one_if_zero(F.max(c)).alias(c) for c in relative]).alias("_top")
    if within:
        maxima = filled.groupBy(*within).agg(tops).withColumnsRenamed({c: f"_{c}" for c in within})
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in within]
        filled = filled.join(maxima, same).drop(*[f"_{c}" for c in within])
    else:
        filled = filled.withColumn("_top", filled.agg(tops).scalar())
    terms = [clip(c, 0.0, 1.0) * points for c, points in absolute.items()]
    terms += [F.col(c) / F.col(f"_top.{c}") * points for c, points in weights.items()]
    index = reduce(lambda left, right: left + right, terms)
    return filled.withColumn(name, round_tenth(index)).drop("_top")
