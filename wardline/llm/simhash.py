"""SimHash near-duplicates: fingerprints of word shingles, pigeonhole blocks, Hamming check."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from wardline.llm.common import forest, free_name, pairs_in_groups, utf8, whole_groups, words
from wardline.llm.components import components
from wardline.session import materialize

BITS = 64
SHINGLE = 4
DISTANCE = 4
SEED = 42
#: A pair at most DISTANCE bits apart differs in at most that many blocks, so two of six blocks are always equal.
BLOCKS = DISTANCE + 2
#: Most fingerprints of a bucket that are compared in one piece; larger buckets are compared piece by piece.
PIECE = 1024
_LINKS = 1_000_000


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64 bits, each set when more than half of the shingle hashes have it set; 0 without words."""
    found = words(utf8(text).lower())
    if not found:
        return 0
    line = b" ".join(found)
    size = min(shingle, len(found))
    bounds = np.zeros(len(found) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1, out=bounds[1:])
    bounds = bounds.tolist()
    digest = xxhash.xxh64_intdigest
    count = len(found) - size + 1
    hashes = np.fromiter((digest(line[i:j - 1], SEED) for i, j in zip(bounds, bounds[size:])), np.uint64, count)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, count, 65536):
        piece = hashes[at:at + 65536].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(piece, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """`key` and `fp`, a signed long with the fingerprint's bits, for every row."""
    kind = docs.schema[key].dataType.simpleString()

    def mapped(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            bits = np.fromiter((fingerprint(t, shingle) for t in batch["text"]), np.uint64, len(batch))
            yield pd.DataFrame({"key": batch["key"], "fp": bits.view(np.int64)})

    named = docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"))
    return named.mapInPandas(mapped, "key string, fp long").select(F.col("key").cast(kind).alias(key), "fp")


def masks(distance: int = DISTANCE, blocks: int | None = None) -> list[int]:
    """Bits that must agree in each lookup: every choice of `blocks - distance` of the blocks."""
    blocks = blocks or distance + 2
    if not distance < blocks <= BITS:
        raise ValueError("needs more blocks than differing bits")
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    parts = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(parts, blocks - distance)]


def near_links(prints: DataFrame, distance: int = DISTANCE, blocks: int | None = None, piece: int = PIECE) -> DataFrame:
    """`a`, `b`: fingerprints that connect all that lie within `distance` bits, given distinct values in `fp`.

    Every fingerprint is listed once per lookup, keyed by the lookup's bits.
    Lookups of one fingerprint are dropped; a lookup of more than `piece` is cut
    into pieces by hash, and each two pieces are compared in a task of their
    own, so no task holds a large bucket. Links found in a piece are reduced to
    a star per component before they are sent on.
    """
    signed = [int(np.uint64(m).astype(np.int64)) for m in masks(distance, blocks)]
    keyed = prints.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("look"), F.col("fp").bitwiseAND(F.lit(m)).alias("bits")) for i, m in enumerate(signed)
    ])).alias("k")).select("k.look", "k.bits", "fp")
    shared = (keyed.groupBy("look", "bits").count().where(F.col("count") > 1)
              .select("look", "bits", F.ceil(F.col("count") / piece).cast("int").alias("n")))
    dealt = keyed.join(shared, ["look", "bits"]).withColumn("p", F.pmod(F.xxhash64("fp", "look"), F.col("n")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("n") - 1))
    dealt = (dealt.select("look", "bits", "fp", "p", other.alias("q"))
             .select("look", "bits", F.least("p", "q").alias("p"), F.greatest("p", "q").alias("q"), "fp"))
    group = ["look", "bits", "p", "q"]

    def compared(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, groups in whole_groups(batches, group):
            values = frame["fp"].to_numpy().view(np.uint64)
            first, second, held = [], [], 0
            for i, j in pairs_in_groups(groups):
                near = np.bitwise_count(values[i] ^ values[j]) <= distance
                first.append(i[near])
                second.append(j[near])
                held += len(first[-1])
                if held > _LINKS:
                    label = forest(len(values), np.concatenate(first), np.concatenate(second))
                    moved = (label != np.arange(len(values))).nonzero()[0]
                    first, second, held = [moved], [label[moved]], 0
            if first:
                label = forest(len(values), np.concatenate(first), np.concatenate(second))
                moved = (label != np.arange(len(values))).nonzero()[0]
                yield pd.DataFrame({"a": values[moved].view(np.int64), "b": values[label[moved]].view(np.int64)})

    return dealt.repartition(*group).sortWithinPartitions(*group).mapInPandas(compared, "a long, b long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", *, shingle: int = SHINGLE,
                    distance: int = DISTANCE, blocks: int | None = None, piece: int = PIECE) -> DataFrame:
    """`key`, `fingerprint`, `component_id` for every row.

    Equal fingerprints are one node, so exact copies add nothing to the search.
    Rows without words, null texts included, have fingerprint zero and are
    linked like any other. `component_id` is the least key of the component;
    null keys are ignored for it, and it is null where a component has no other.
    Rows may repeat: each is returned. Other columns of `docs` are not read.
    """
    printed = materialize(fingerprints(docs, key, text, shingle), "fingerprints")
    first = printed.groupBy("fp").agg(F.min(key).alias("first"))
    labels = components(near_links(first.select("fp"), distance, blocks, piece))
    joined = labels.select(F.col("node").alias("fp"), "label").join(first, "fp")
    joined = materialize(joined, "linked")
    least = joined.groupBy("label").agg(F.min("first").alias("component_id"))
    linked = joined.select("fp", "label").join(least, "label").select("fp", "component_id")
    roots = materialize(first.join(linked, "fp", "left")
                        .select("fp", F.coalesce("component_id", "first").alias("component_id")), "roots")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return printed.join(roots, "fp").select(key, digits.alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of `docs` whose key is their component's least; all columns are kept as they are.

    Rows that share a key are one document and stay or go together. Rows with a
    null key cannot be told apart by it and all stay.
    """
    return keep_least(docs, near_duplicates(docs, key, text, **options), key)


def keep_least(docs: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """The rows of `docs` that stay when each component in `found` (`key`, `component_id`) keeps its least key."""
    name = free_name(docs, "gone")
    gone = materialize(found.where(F.col(key) != F.col("component_id")).select(F.col(key).alias(name)).distinct(), "gone")
    # a repeated key whose rows lie in two components stays where it is the least of one
    stays = found.where(F.col(key) == F.col("component_id")).select(F.col(key).alias(name)).distinct()
    # the keys grow with the corpus: the same plan, a merge join that AQE may split, at every size
    return docs.join(gone.join(stays, name, "left_anti").hint("merge"), docs[key] == F.col(name), "left_anti")
