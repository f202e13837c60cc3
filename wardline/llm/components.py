"""Connected components of a link table, by repeated contraction."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from wardline.session import materialize

LABELS = T.StructType([T.StructField("node", T.LongType()), T.StructField("label", T.LongType())])


def components(links: DataFrame, first: str = "a", second: str = "b") -> DataFrame:
    """`node`, `label` for every node with a link; the label is the least node of its component.

    Each round lets every node point at its least neighbour, itself included,
    and contracts the links to the nodes pointed at. The number of linked nodes
    at least halves, so the rounds are logarithmic in their count; stars, which
    the callers produce, take one or two. Every round is written to the shared
    folder: a lost executor costs a task, not the rounds before. Empty links
    give an empty table; self links and repeated links do not matter.
    """
    spark = links.sparkSession
    edges = materialize(_directed(links, first, second), "links")
    levels: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        targets = materialize(
            both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
            .select("node", F.least("node", "least").alias("label")), "targets")
        levels.append(targets)
        to_a = targets.select(F.col("node").alias("a"), F.col("label").alias("new_a"))
        to_b = targets.select(F.col("node").alias("b"), F.col("label").alias("new_b"))
        moved = edges.join(to_a, "a").select("b", "new_a").join(to_b, "b").select("new_a", "new_b")
        edges = materialize(_directed(moved, "new_a", "new_b"), "links")
    if not levels:
        return spark.createDataFrame([], LABELS)
    labels = levels.pop()
    while levels:
        below = levels.pop()
        on_top = labels.select(F.col("node").alias("label"), F.col("label").alias("top"))
        labels = materialize(below.join(on_top, "label", "left").select("node", F.coalesce("top", "label").alias("label")),
                             "labels")
    return labels


def joined_groups(groups: list[DataFrame], key: str = "doc_id") -> DataFrame:
    """`key`, `component_id` (the least key) for every row of `groups` when rows that share a component in any are connected.

    Each of `groups` has a long `key` and `component_id`, itself a key, for all
    documents; rows repeat no more than in the first. Null keys are left out.
    """
    links = [g.where(F.col(key) != F.col("component_id")).select(F.col(key).alias("a"), F.col("component_id").alias("b")) for g in groups]
    labels = components(reduce(DataFrame.unionByName, links))
    keys = groups[0].where(F.col(key).isNotNull()).select(key)
    return keys.join(labels, keys[key] == labels["node"], "left").select(key, F.coalesce("label", key).alias("component_id"))


def _directed(links: DataFrame, first: str, second: str) -> DataFrame:
    """Distinct links with the greater node as `a`, without self links."""
    return (links.where(F.col(first) != F.col(second))
            .select(F.greatest(first, second).alias("a"), F.least(first, second).alias("b")).distinct())
