"""Mixing sources to target weights by a low-discrepancy schedule of equal blocks of words."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from fractions import Fraction
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from wardline.llm.common import WORD
from wardline.session import materialize

WEIGHTS = (3, 1, 2)
SHARE = Fraction(3, 2)
REPEATS = 2
BLOCK = 1024
SEED = 42
#: The golden ratio's fractional part in units of 2**-64; its multiples fill the unit interval evenly at every length.
GOLDEN = 0x9E3779B97F4A7C15
#: Slots of the schedule that are laid out in one piece, and documents of a source that are ordered in one.
SLOTS_PER_PIECE = 1 << 16
ROWS_PER_BUCKET = 200_000


def targets(sizes: dict[str | None, int], weights: tuple[int, ...] = WEIGHTS, share: Fraction = SHARE,
            repeats: int = REPEATS) -> dict[str | None, Fraction]:
    """Words to take of each source: `share` of all words by weight, at most `repeats` times the source's own.

    Sources take the weights in turn, by code point, null last. What a source
    at its limit cannot take goes to the others by weight, until none is above.
    """
    order = sorted(sizes, key=lambda name: (name is None, name or ""))
    weight = {name: weights[i % len(weights)] for i, name in enumerate(order)}
    left, below, found = share * sum(sizes.values()), set(order), {}
    while below:
        unit = left / sum(weight[name] for name in below)
        full = {name for name in below if unit * weight[name] > repeats * sizes[name]}
        for name in full or below:
            found[name] = Fraction(repeats * sizes[name]) if full else unit * weight[name]
        if not full:
            break
        left -= sum(found[name] for name in full)
        below -= full
    return found


@dataclass
class Mix:
    #: `row_id`, key, source, `size`, `source_size`, `target`, and where the row's words lie in its source's stream.
    rows: DataFrame
    #: `slot`, `source_no`, `row_id`, `pass_no`, `first`, `words`: what each slot takes, in the order of training.
    schedule: DataFrame


def sized(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(F.col(key), F.col(source).cast("string").alias("mix_source"), size.alias("mix_size"))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", *,
        weights: tuple[int, ...] = WEIGHTS, share: Fraction = SHARE, repeats: int = REPEATS, block: int = BLOCK,
        seed: int = SEED) -> Mix:
    """Which words of which rows the mix takes, slot by slot.

    The words of a source, its rows shuffled by a keyed hash, are a stream that
    is read up to `repeats` times. Slot t belongs to the source in whose part of
    the cumulated targets the t-th multiple of the golden ratio falls; the n-th
    slot of a source reads the n-th block of its stream. So any stretch of the
    schedule holds the sources near their shares. Slots past a source's target
    are left out, missing ones are added at the end: exactly the target, in
    whole words, is taken. One row per source reaches the driver, with its
    name and sums; no task handles sources beyond those of its own slots.

    Rows without words and null texts have size 0 and are never taken. A null
    source is a source. Repeated rows and keys are rows of their own; null keys
    too. An empty table gives an empty mix.
    """
    spark = docs.sparkSession
    if {"mix_source", "mix_size"} & {key}:
        raise ValueError("the key's name is used by the mix")
    all_sized = materialize(sized(docs, key, text, source), "sized")
    totals = all_sized.groupBy("mix_source").agg(F.sum("mix_size").alias("size"), F.count("*").alias("rows")).collect()
    sizes = {row["mix_source"]: row["size"] for row in totals}
    wanted = targets(sizes, weights, share, repeats)
    names = sorted(sizes, key=lambda name: (name is None, name or ""))
    buckets = max(64, -(-max((row["rows"] for row in totals), default=0) // ROWS_PER_BUCKET))
    takes = [int(wanted[name]) for name in names]
    about = spark.createDataFrame(
        [(i, name, sizes[name], float(wanted[name]), takes[i]) for i, name in enumerate(names)],
        "source_no int, mix_source string, source_size long, target double, takes long")

    # where each row starts in its source's stream: sums of whole buckets, then sums within a bucket
    hashed = F.xxhash64(F.lit(seed), F.col(key), F.col("mix_size"))
    rows = (all_sized.join(about, all_sized["mix_source"].eqNullSafe(about["mix_source"]))
            .select(F.col(key).alias("wl_key"), about["mix_source"], "mix_size", "source_no", "source_size", "target", "takes",
                    hashed.alias("h")).withColumn("bucket", F.floor((F.col("h") / 2.0 ** 64 + 0.5) * buckets)))
    before = F.sum("inside").over(W.partitionBy("source_no").orderBy("bucket")) - F.col("inside")
    ahead = (rows.groupBy("source_no", "bucket").agg(F.sum("mix_size").alias("inside"))
             .select("source_no", "bucket", before.alias("ahead")))
    inside = W.partitionBy("source_no", "bucket").orderBy("h", "wl_key", "mix_size").rowsBetween(W.unboundedPreceding, 0)
    placed = materialize(
        rows.join(ahead, ["source_no", "bucket"])
        .withColumn("row_id", F.struct("source_no", "bucket", F.row_number().over(inside).alias("number")))
        .withColumn("start", F.col("ahead") + F.sum("mix_size").over(inside) - F.col("mix_size"))
        .select("row_id", "wl_key", "mix_source", "mix_size", "source_no", "source_size", "target", "takes", "start"), "placed")

    turn = F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))
    spans = (placed.where("mix_size > 0").select("*", turn.alias("pass_no"))
             .withColumn("from", F.col("start") + F.col("pass_no") * F.col("source_size"))
             .withColumn("to", F.least(F.col("from") + F.col("mix_size"), "takes")).where("from < to"))
    number = F.explode(F.sequence(F.floor(F.col("from") / block), F.floor((F.col("to") - 1) / block)))
    parts = (spans.select("row_id", "source_no", "pass_no", "from", "to", number.alias("rank"))
             .withColumn("begin", F.greatest("from", F.col("rank") * block))
             .withColumn("words", F.least("to", (F.col("rank") + 1) * block) - F.col("begin"))
             .select("row_id", "source_no", "pass_no", "rank", (F.col("begin") - F.col("from")).alias("first"), "words"))
    schedule = (parts.join(slots(spark, takes, block), ["source_no", "rank"])
                .select("slot", "source_no", "row_id", "pass_no", "first", "words"))
    named = placed.select("row_id", F.col("wl_key").alias(key), F.col("mix_source").alias("source"),
                          F.col("mix_size").alias("size"), "source_size", "target", "source_no", "start")
    return Mix(named, schedule)


def slots(spark, takes: list[int], block: int = BLOCK, piece: int = SLOTS_PER_PIECE) -> DataFrame:
    """`slot`, `source_no`, `rank`: the block of `block` words that each slot of the schedule reads."""
    needed = [-(-words // block) for words in takes]
    total = sum(takes)
    schema = "slot long, source_no int, rank long"
    if not total:
        return spark.createDataFrame([], schema)
    count = sum(needed)
    cumulated = accumulate(takes)
    edges = np.array([min((words << 64) // total, (1 << 64) - 1) for words in cumulated][:-1], np.uint64)
    shared = spark.sparkContext.broadcast((edges, np.array(needed, np.int64)))

    def sources(first: int) -> np.ndarray:
        points = np.arange(first, min(first + piece, count), dtype=np.uint64) * np.uint64(GOLDEN)
        return np.searchsorted(shared.value[0], points, "right")

    def counted(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for number in batch["id"]:
                found, times = np.unique(sources(number * piece), return_counts=True)
                yield pd.DataFrame({"piece": number, "source_no": found.astype(np.int32), "n": times})

    def laid(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for number, ahead in zip(batch["piece"], batch["ahead"]):
                found = sources(number * piece)
                # `ahead` has the piece's sources in order, so the slots sorted by source fall into its runs
                order = np.argsort(found, kind="stable")
                runs = np.flatnonzero(np.diff(found[order], prepend=-1))
                sizes = np.diff(runs, append=len(order))
                rank = np.empty(len(found), np.int64)
                rank[order] = np.repeat(np.asarray(ahead, np.int64) - runs, sizes) + np.arange(len(order))
                at = np.flatnonzero(rank < shared.value[1][found])
                yield pd.DataFrame({"slot": number * piece + at, "source_no": found[at].astype(np.int32), "rank": rank[at]})

    pieces = spark.range(-(-count // piece))
    counts = materialize(pieces.mapInPandas(counted, "piece long, source_no int, n long"), "slot_counts")
    before = F.sum("n").over(W.partitionBy("source_no").orderBy("piece")) - F.col("n")
    ahead = (counts.select("piece", "source_no", before.alias("ahead")).groupBy("piece")
             .agg(F.transform(F.array_sort(F.collect_list(F.struct("source_no", "ahead"))), lambda x: x["ahead"]).alias("ahead")))
    drawn = {row["source_no"]: row["n"] for row in counts.groupBy("source_no").agg(F.sum("n").alias("n")).collect()}
    late = [(source, rank) for source, most in enumerate(needed) for rank in range(drawn.get(source, 0), most)]
    added = spark.createDataFrame([(count + i, source, rank) for i, (source, rank) in enumerate(late)], schema)
    return ahead.mapInPandas(laid, schema).unionByName(added)


def taken(mixed: Mix) -> DataFrame:
    """The mix's rows with `taken`, the words of each that its schedule takes, repeats counted."""
    sums = mixed.schedule.groupBy("row_id").agg(F.sum("words").alias("taken"))
    return mixed.rows.join(sums, "row_id", "left").withColumn("taken", F.coalesce("taken", F.lit(0).cast("long")))


def mixed_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
                    chars: str | None = None, **options) -> DataFrame:
    """The rows of `docs` as often as the mix takes them, with their columns.

    A row of which the mix takes one and a half times the words is returned
    whole and then cut behind its last taken word; `chars`, if given, is set to
    the cut text's length. Rows that agree in key, source and size share what
    they are given evenly. Rows of no words are never taken.
    """
    found = (taken(mix(docs, key, text, source, **options)).groupBy(key, "source", "size")
             .agg(F.floor(F.avg("taken")).cast("long").alias("taken")).where("taken > 0")
             .select(F.struct(F.col(key).alias("key"), "source", "size", "taken").alias("wl_mix")))
    found = materialize(found, "taken")
    rows = docs.select(F.struct("*").alias("wl_row"))
    size = F.coalesce(F.regexp_count(F.col(f"wl_row.{text}"), F.lit(WORD)), F.lit(0)).cast("long")
    joined = rows.join(found.hint("merge"), F.col(f"wl_row.{key}").eqNullSafe(F.col("wl_mix.key"))
                       & F.col(f"wl_row.{source}").cast("string").eqNullSafe(F.col("wl_mix.source"))
                       & (size == F.col("wl_mix.size")))
    whole = F.floor(F.col("wl_mix.taken") / F.col("wl_mix.size")).cast("int")
    passes = F.explode(F.sequence(F.lit(1), F.ceil(F.col("wl_mix.taken") / F.col("wl_mix.size")).cast("int")))
    rest = F.col("wl_mix.taken") % F.col("wl_mix.size")
    copies = joined.select("wl_row", passes.alias("wl_pass"), whole.alias("wl_whole"), rest.alias("wl_rest"))
    part = F.col("wl_pass") > F.col("wl_whole")
    cut = F.when(part, _first_words(F.col(f"wl_row.{text}"), F.when(part, F.col("wl_rest")))).otherwise(F.col(f"wl_row.{text}"))
    columns = []
    for name in docs.columns:
        value = F.col(f"wl_row.`{name}`")
        if name == text:
            value = cut
        elif name == chars:
            value = F.when(part, F.length(cut)).otherwise(value).cast(docs.schema[name].dataType)
        columns.append(value.alias(name))
    return copies.select(*columns)


@F.pandas_udf(T.StringType())
def _first_words(texts: pd.Series, counts: pd.Series) -> pd.Series:
    """Each text up to the end of its n-th word; null where no number is given."""
    import re

    out = []
    for text, count in zip(texts, counts):
        if text is None or pd.isna(count):
            out.append(None)
            continue
        for number, word in enumerate(re.finditer(WORD, text), 1):
            if number == int(count):
                break
        out.append(text[:word.end()])
    return pd.Series(out, dtype=object)
