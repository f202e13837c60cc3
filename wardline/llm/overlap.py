"""Near-duplicates by overlap: MinHash bands find candidates, exact Jaccard of word shingles decides."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from wardline.llm.common import utf8, whole_groups, words
from wardline.llm.components import components
from wardline.llm.simhash import keep_least
from wardline.session import materialize

SHINGLE = 5
SIMILARITY = 0.8
#: A pair at similarity s shares no band with chance (1 - s ** ROWS) ** BANDS: 1.3e-7 at 0.8, less above.
BANDS, ROWS = 40, 5
SEED = 42
#: Most documents, and about the most shingles, of a piece; larger groups of candidates are compared piece by piece.
PIECE, SHINGLES = 512, 4_000_000
_MULTIPLY, _ADD = np.random.default_rng(SEED).integers(0, 2 ** 32, (2, BANDS * ROWS), np.uint32)
_MULTIPLY |= np.uint32(1)


def shingles(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of `width` words; a shorter text is one run, one without words none."""
    found = words(utf8(text).lower())
    if not found:
        return np.empty(0, np.uint64)
    line = b" ".join(found)
    size = min(width, len(found))
    bounds = np.zeros(len(found) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1, out=bounds[1:])
    bounds = bounds.tolist()
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(line[i:j - 1], SEED) for i, j in zip(bounds, bounds[size:])), np.uint64,
                                 len(found) - size + 1))


def bands(values: np.ndarray) -> np.ndarray:
    """One signed long per band of the least values of the set under all permutations."""
    short = (values >> np.uint64(32)).astype(np.uint32)
    least = np.full(BANDS * ROWS, 2 ** 32 - 1, np.uint32)
    for at in range(0, len(short), 512):
        np.minimum(least, (short[at:at + 512, None] * _MULTIPLY + _ADD).min(0), out=least)
    data, step = least.astype("<u4").tobytes(), 4 * ROWS
    hashes = [xxhash.xxh64_intdigest(data[i:i + step], SEED) for i in range(0, len(data), step)]
    return np.array(hashes, np.uint64).view(np.int64)


def jaccard(one: np.ndarray, other: np.ndarray) -> float:
    """Of two sorted sets, neither of them empty."""
    place = np.searchsorted(other, one)
    place[place == len(other)] = 0
    common = int((other[place] == one).sum())
    return common / (len(one) + len(other) - common)


def similar(sets: list[np.ndarray], marks: np.ndarray, label: np.ndarray, side: np.ndarray, band: int,
            similarity: float = SIMILARITY) -> np.ndarray:
    """The labels after joining all pairs as similar as asked whose first shared band is `band`.

    `label` has the least position connected to each so far; pairs that are
    connected already are not compared. Pairs of one `side` are compared only
    where there is one side.
    """
    label = label.copy()
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    crossed = len(np.unique(side)) > 1
    for a in range(len(sets) - 1):
        near = (label[a + 1:] != label[a]) & (np.minimum(sizes[a + 1:], sizes[a]) >= similarity * np.maximum(sizes[a + 1:], sizes[a]) - 1e-6)
        if crossed:
            near &= side[a + 1:] != side[a]
        others = near.nonzero()[0] + a + 1
        for b in others[(marks[others] == marks[a]).argmax(1) == band]:
            if label[a] != label[b] and jaccard(sets[a], sets[b]) >= similarity:
                least, most = sorted((label[a], label[b]))
                label[label == most] = least
    return label


def _stretches(numbers: np.ndarray) -> Iterator[tuple[int, int]]:
    """Start and end of each run of equal numbers."""
    starts = np.flatnonzero(np.diff(numbers, prepend=-1)).tolist()
    return zip(starts, [*starts[1:], len(numbers)])


def in_buckets(classes: DataFrame) -> DataFrame:
    """`node`, `size`, `band`, `bits` of every bucket with more than one node, `least` its least node with its size."""
    keyed = classes.select("node", "size", F.posexplode("bands").alias("band", "bits"))
    shared = keyed.groupBy("band", "bits").agg(F.min(F.struct("node", "size")).alias("least"), F.count("*").alias("n"))
    return keyed.join(shared.where("n > 1").drop("n"), ["band", "bits"])


def _pieces(piece: int) -> Column:
    """Pieces of a group, of about `piece` sets and `SHINGLES` shingles each."""
    return F.greatest(F.ceil(F.count("*") / piece), F.ceil(F.sum("size") / SHINGLES)).cast("int").alias("n")


def stars(buckets: DataFrame, similarity: float, piece: int) -> DataFrame:
    """`centre`, `p`, `node`: every node beside the least of each of its buckets, in pieces; the centre is in each piece."""
    close = F.least("size", "least.size") >= F.greatest("size", "least.size") * similarity - 1e-6
    pairs = (buckets.where((F.col("node") != F.col("least.node")) & close)
             .select("node", "size", F.col("least.node").alias("centre")).distinct())
    sizes = pairs.groupBy("centre").agg(_pieces(piece))
    members = pairs.join(sizes, "centre").select("centre", F.pmod(F.xxhash64("node"), F.col("n")).cast("int").alias("p"), "node")
    return members.unionByName(members.select("centre", "p", F.col("centre").alias("node")).distinct())


def open_buckets(buckets: DataFrame, labels: DataFrame, piece: int) -> DataFrame:
    """`band`, `bits`, `p`, `q`, `own`, `node`, `label`: buckets with nodes that are not connected, in pairs of pieces.

    The least node of a bucket is left out, as `stars` has it beside each of the others.
    """
    others = buckets.where(F.col("node") != F.col("least.node"))
    labelled = (others.select("node", "size", "band", "bits").join(labels, "node", "left")
                .withColumn("label", F.coalesce("label", "node")))
    sizes = (labelled.groupBy("band", "bits").agg(_pieces(piece), F.min("label").alias("from"), F.max("label").alias("to"))
             .where(F.col("from") != F.col("to")).select("band", "bits", "n"))
    dealt = labelled.join(sizes, ["band", "bits"]).withColumn("own", F.pmod(F.xxhash64("node"), F.col("n")).cast("int"))
    return (dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
            .select("band", "bits", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "own", "node", "label"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", *, width: int = SHINGLE,
                    similarity: float = SIMILARITY, piece: int = PIECE) -> DataFrame:
    """`key`, `component_id` for every row: the least key reachable over pairs with Jaccard of at least `similarity`.

    Equal sets of shingles are one node; texts without words, null texts
    included, are equal. Sets are sent only for texts that share a band with
    another. First each is compared with the least of its buckets, which
    connects groups of near copies. Then only buckets that hold nodes not yet
    connected are left; those are cut into pieces, each two of which are
    compared in a task of their own, a pair in the first band it shares. Chains
    of buckets are never one group. Null keys are ignored for `component_id`,
    which is null where a component has no other. An empty table gives none.
    """
    kind = docs.schema[key].dataType.simpleString()
    named = docs.select(F.col(key).cast("string").alias("key"), F.sha2(F.col(text), 256).alias("about"), F.col(text).alias("text"))

    def printed(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for content in batch["text"]:
                values = shingles(content, width)
                rows.append((xxhash.xxh128_hexdigest(values.tobytes(), SEED), len(values), bands(values) if len(values) else []))
            yield pd.concat([batch[["key", "about"]].reset_index(drop=True), pd.DataFrame(rows, columns=["digest", "size", "bands"])], axis=1)

    prints = materialize(named.mapInPandas(printed, "key string, about string, digest string, size int, bands array<long>"), "prints")
    classes = materialize(
        prints.groupBy("digest").agg(F.min(F.col("key").cast(kind)).alias("first"), F.max(F.struct("key", "about")).alias("shown"),
                                     F.first("size").alias("size"), F.first("bands").alias("bands"))
        .withColumn("node", F.monotonically_increasing_id()), "classes")
    buckets = materialize(in_buckets(classes), "buckets")
    wanted = (classes.join(buckets.select("node").distinct(), "node")
              .select("node", "bands", F.col("shown.key").alias("of"), F.col("shown.about").alias("said")))
    found = named.join(wanted, F.col("key").eqNullSafe(F.col("of")) & F.col("about").eqNullSafe(F.col("said")))

    def listed(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[["node", "bands"]].assign(data=[shingles(t, width).tobytes() for t in batch["text"]])

    # rows that repeat a null or equal key are one
    sets = materialize(found.select("node", "bands", "text").mapInPandas(listed, "node long, bands array<long>, data binary")
                       .dropDuplicates(["node"]), "sets")

    def around(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, numbers in whole_groups(batches, ["centre", "p"]):
            nodes, centres, data, links = frame["node"].to_numpy(), frame["centre"].to_numpy(), frame["data"].to_list(), []
            for start, end in _stretches(numbers):
                at = start + int((nodes[start:end] == centres[start]).argmax())
                centre = np.frombuffer(data[at], np.uint64)
                links += [i for i in range(start, end) if i != at and jaccard(np.frombuffer(data[i], np.uint64), centre) >= similarity]
            yield pd.DataFrame({"a": nodes[links], "b": centres[links]})

    def between(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, numbers in whole_groups(batches, ["band", "bits", "p", "q"]):
            nodes, known, band, own = (frame[name].to_numpy() for name in ("node", "label", "band", "own"))
            data, marks, links = frame["data"].to_list(), frame["bands"].to_list(), []
            for start, end in _stretches(numbers):
                labels, first, place = np.unique(known[start:end], return_index=True, return_inverse=True)
                if len(labels) < 2:
                    continue
                before = first[place]
                after = similar([np.frombuffer(d, np.uint64) for d in data[start:end]], np.stack(marks[start:end]), before,
                                own[start:end], int(band[start]), similarity)
                moved = ((after != before) & (before == np.arange(end - start))).nonzero()[0]
                links.append(np.stack([nodes[start + moved], nodes[start + after[moved]]], 1))
            yield pd.DataFrame(np.concatenate([np.empty((0, 2), np.int64), *links]), columns=["a", "b"])

    def compared(dealt: DataFrame, by: list[str], compare: Callable) -> DataFrame:
        return dealt.join(sets, "node").repartition(*by).sortWithinPartitions(*by).mapInPandas(compare, "a long, b long")

    near = materialize(compared(stars(buckets, similarity, piece), ["centre", "p"], around), "near")
    rest = compared(open_buckets(buckets, components(near), piece), ["band", "bits", "p", "q"], between)
    labels = components(near.unionByName(rest)).withColumnRenamed("label", "root")
    joined = materialize(classes.select("digest", "first", "node").join(labels, "node", "left")
                         .select("digest", "first", F.coalesce("root", "node").alias("root")), "joined")
    least = joined.groupBy("root").agg(F.min("first").alias("component_id"))
    roots = materialize(joined.join(least, "root").select("digest", "component_id"), "roots")
    return prints.join(roots, "digest").select(F.col("key").cast(kind).alias(key), "component_id")


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of `docs` whose key is their component's least, as in `simhash.drop_near_duplicates`; an empty table stays so."""
    return keep_least(docs, near_duplicates(docs, key, text, **options), key)
