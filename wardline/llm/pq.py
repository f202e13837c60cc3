"""Near-duplicate vectors: product quantisation over coarse inverted lists, exact cosine at the end."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from wardline.llm.common import bounded_sample, forest, whole_groups
from wardline.llm.components import components
from wardline.session import materialize

COSINE = 0.93
#: Most vectors that the centres and codes are fitted to; all vectors are indexed.
SAMPLE = 8192
PER_LIST = 1024
MOST_LISTS = 4096
SUBSPACES = 8
CODES = 256
#: How far from the border of a list a vector still looks into it, as a share of the radius of COSINE. The two ends of
#: a link lie on opposite sides of the border of their lists, so one is within half the radius: at 0.5 none is missed.
MARGIN = 0.5
PIECE = 1024


@dataclass
class Quantizer:
    """Coarse centres, and for each slice of the dimensions the codes of what is left after the centre."""

    centres: np.ndarray
    slices: list[slice]
    codes: list[np.ndarray]

    def lists(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances to all centres, and the nearest."""
        gaps = (unit * unit).sum(1)[:, None] - 2 * unit @ self.centres.T + (self.centres ** 2).sum(1)
        return gaps, gaps.argmin(1)

    def encode(self, unit: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the vectors, and the exact distance of each to what its codes say."""
        left = unit - self.centres[own]
        codes = np.zeros((len(unit), len(self.slices)), np.uint8)
        for m, (part, book) in enumerate(zip(self.slices, self.codes)):
            codes[:, m] = _gaps(left[:, part], book).argmin(1)
            left[:, part] -= book[codes[:, m]]
        return codes, np.sqrt((left * left).sum(1))

    def distances(self, unit: np.ndarray, cell: int, codes: np.ndarray) -> np.ndarray:
        """Distance of every vector to every code of a cell, summed up from a table per vector and slice."""
        left = unit - self.centres[cell]
        total = np.zeros((len(unit), len(codes)))
        for m, (part, book) in enumerate(zip(self.slices, self.codes)):
            total += _gaps(left[:, part], book)[:, codes[:, m]]
        return np.sqrt(np.maximum(total, 0))


def _gaps(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (rows * rows).sum(1)[:, None] - 2 * rows @ centres.T + (centres * centres).sum(1)


def _means(rows: np.ndarray, count: int, rng: np.random.Generator, rounds: int = 10) -> np.ndarray:
    centres = rows[rng.choice(len(rows), min(count, len(rows)), replace=False)]
    for _ in range(rounds):
        own = _gaps(rows, centres).argmin(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, rows)
        sizes = np.bincount(own, minlength=len(centres))[:, None]
        centres = np.where(sizes > 0, sums / np.maximum(sizes, 1), centres)
    return centres


def train(unit: np.ndarray, lists: int, subspaces: int = SUBSPACES, codes: int = CODES, seed: int = 5) -> Quantizer:
    """Fit to the rows of `unit`; without rows all vectors share one list and one code."""
    size = unit.shape[1]
    edges = np.linspace(0, size, min(subspaces, size) + 1).astype(int)
    slices = [slice(a, b) for a, b in zip(edges, edges[1:])]
    if not len(unit):
        return Quantizer(np.zeros((1, size)), slices, [np.zeros((1, s.stop - s.start)) for s in slices])
    rng = np.random.default_rng(seed)
    centres = _means(unit, lists, rng)
    left = unit - centres[_gaps(unit, centres).argmin(1)]
    return Quantizer(centres, slices, [_means(left[:, part], codes, rng) for part in slices])


def _unit(data: Iterable[bytes], kind: str) -> np.ndarray:
    rows = np.stack([np.frombuffer(row, kind) for row in data]).astype(np.float64)
    rows /= np.abs(rows).max(1, keepdims=True)  # so that no square overflows or vanishes
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of unit vectors, row by row: the value that decides, whatever else is compared beside it."""
    return np.einsum("ij,ij->i", a, b)


def _linked(a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray, cosine: float) -> np.ndarray:
    """Whether rows `x` of `a` and `y` of `b` reach the cosine.

    Where many pairs are asked for, one product of matrices settles all that are
    not within rounding of the limit; those are left to `_cosines`.
    """
    if len(x) * 8 > len(a) * len(b):
        rough = (a @ b.T)[x, y]
        linked = rough >= cosine
        open_ = np.flatnonzero(np.abs(rough - cosine) < 1e-9)
    else:
        linked, open_ = np.empty(len(x), bool), np.arange(len(x))
    for at in range(0, len(open_), 65536):
        some = open_[at:at + 65536]
        linked[some] = _cosines(a[x[some]], b[y[some]]) >= cosine
    return linked


def _prepared(vectors: DataFrame, key: str, vector: str, label: str) -> tuple[DataFrame, str]:
    """`key` as text, and for usable vectors label, size, bytes, and a digest that equals only where these do."""
    wide = isinstance(vectors.schema[vector].dataType.elementType, T.FloatType)
    kind = "<f4" if wide else "<f8"

    def mapped(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for name, numbers, group in zip(batch["key"], batch["vector"], batch["label"]):
                data = None
                if numbers is not None and group is not None and len(numbers):
                    values = np.array([np.nan if x is None else x for x in numbers], kind)
                    if np.isfinite(values).all() and values.any():
                        data = (values + 0).tobytes()  # + 0: minus zero is zero
                about = None if data is None else hashlib.sha256(group.encode("utf-8", "replace") + b"\0" + data).hexdigest()
                rows.append((name, group, 0 if data is None else len(numbers), data, about))
            yield pd.DataFrame(rows, columns=["key", "label", "size", "data", "digest"])

    numbers = F.col(vector) if wide else F.col(vector).cast("array<double>")
    return (vectors.select(F.col(key).cast("string").alias("key"), numbers.alias("vector"), F.col(label).cast("string").alias("label"))
            .mapInPandas(mapped, "key string, label string, size int, data binary, digest string")), kind


def links(classes: DataFrame, kind: str, cosine: float = COSINE, margin: float = MARGIN, sample: int = SAMPLE,
          per_list: int = PER_LIST, piece: int = PIECE) -> DataFrame:
    """`a`, `b`, `n` from distinct vectors (`node`, `label`, `size`, `data`, `copies`).

    Rows with `b` null add `n` links to the vectors of node `a`; the others
    connect what is linked, at most one row per vector of a piece. Each vector
    is at home in one list and looks into all others whose border with its own
    is within reach. A pair whose ends both look is taken in the later list.
    The vectors of a list are cut into pieces, and each two pieces are compared
    in a task of their own.
    """
    radius = float(np.sqrt(2 - 2 * cosine))
    count = classes.count()
    lists = int(min(max(1, -(-count // per_list)), MOST_LISTS, sample))
    fitted = bounded_sample(classes.select("size", "data", "node"), sample, "node").toPandas()
    books = {int(size): train(_unit(rows["data"], kind), lists) for size, rows in fitted.groupby("size")}
    shared = classes.sparkSession.sparkContext.broadcast(books)

    def book(size: int) -> Quantizer:
        return shared.value.get(size) or train(np.empty((0, size)), 1)

    def indexed(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for size, rows in batch.groupby("size"):
                own_book = book(int(size))
                unit = _unit(rows["data"], kind)
                gaps, own = own_book.lists(unit)
                codes, errors = own_book.encode(unit, own)
                apart = np.sqrt(np.maximum(_gaps(own_book.centres, own_book.centres), 0))[own]
                near = gaps - gaps[np.arange(len(own)), own][:, None] <= 2 * margin * radius * apart + 1e-9
                near[np.arange(len(own)), own] = False
                yield rows.assign(cell=own.astype(np.int32), codes=[c.tobytes() for c in codes], error=errors,
                                  looks=[np.flatnonzero(row).astype(np.int32).tolist() for row in near], own=own.astype(np.int32))

    schema = "node long, label string, size int, data binary, copies long"
    index = materialize(classes.select("node", "label", "size", "data", "copies").mapInPandas(
        indexed, schema + ", cell int, codes binary, error double, looks array<int>, own int"), "index")
    home = index.select("node", "label", "size", "data", "copies", "cell", "codes", "error", "looks",
                        F.col("own").alias("from"), F.lit(True).alias("home"))
    look = index.select("node", "label", "size", "data", "copies", F.explode("looks").alias("cell"),
                        F.lit(None).cast("binary").alias("codes"), F.lit(0.0).alias("error"),
                        F.lit(None).cast("array<int>").alias("looks"), F.col("own").alias("from"), F.lit(False).alias("home"))
    group = ["label", "size", "cell"]
    pieces = lambda column: F.ceil(F.sum(column.cast("long")) / piece).cast("int")
    every = home.unionByName(look)
    sizes = every.groupBy(*group).agg(pieces(F.col("home")).alias("homes"), pieces(~F.col("home")).alias("lookers")).where("homes > 0")
    own = F.pmod(F.xxhash64("node"), F.when(F.col("home"), F.col("homes")).otherwise(F.col("lookers"))).cast("int")
    tasks = F.expr("""
        CASE WHEN home THEN concat(
            transform(sequence(own, homes - 1), j -> struct(own AS i, true AS inner, j AS j, true AS listed)),
            IF(lookers > 0, transform(sequence(0, lookers - 1), j -> struct(own AS i, false AS inner, j AS j, true AS listed)), array()),
            IF(own > 0, transform(sequence(0, own - 1), i -> struct(i AS i, true AS inner, own AS j, false AS listed)), array()))
        ELSE transform(sequence(0, homes - 1), i -> struct(i AS i, false AS inner, own AS j, false AS listed)) END""")
    dealt = (every.join(sizes, group).withColumn("own", own).withColumn("task", F.explode(tasks))
             .select(*group, "task.i", "task.inner", "task.j", "task.listed", "node", "data", "copies", "codes", "error",
                     F.when(F.col("task.listed"), F.col("looks")).alias("looks"), "from"))
    keys = [*group, "i", "inner", "j"]

    def compared(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, groups in whole_groups(batches, keys):
            for _, rows in frame.groupby(groups, sort=False):
                listed = rows[rows["listed"]]
                same = bool(rows["inner"].iloc[0]) and rows["i"].iloc[0] == rows["j"].iloc[0]
                asking = listed if same else rows[~rows["listed"]]
                if not len(listed) or not len(asking):
                    continue
                first = rows.iloc[0]
                unit, other = _unit(listed["data"], kind), _unit(asking["data"], kind)
                codes = np.stack([np.frombuffer(c, np.uint8) for c in listed["codes"]])
                close = book(int(first["size"])).distances(other, int(first["cell"]), codes)
                close = close - listed["error"].to_numpy() <= radius + 1e-6
                if same:
                    close = np.triu(close, 1)
                x, y = close.nonzero()
                linked = _linked(other, unit, x, y, cosine)
                x, y = x[linked], y[linked]
                if not first["inner"]:
                    back = [np.asarray(cells, np.int64) + at * MOST_LISTS for at, cells in enumerate(listed["looks"])]
                    sought = asking["from"].to_numpy()[x]
                    taken = (sought < first["cell"]) | ~np.isin(sought + y * MOST_LISTS, np.concatenate(back))
                    x, y = x[taken], y[taken]
                if not len(x):
                    continue
                nodes = np.concatenate([asking["node"].to_numpy(), listed["node"].to_numpy()])
                copies = np.concatenate([asking["copies"].to_numpy(), listed["copies"].to_numpy()])
                shift = 0 if same else len(asking)
                if same:
                    nodes, copies = nodes[:len(asking)], copies[:len(asking)]
                y = y + shift
                found = np.bincount(x, copies[y], len(nodes)) + np.bincount(y, copies[x], len(nodes))
                label = forest(len(nodes), x, y)
                at, moved = found.nonzero()[0], (label != np.arange(len(nodes))).nonzero()[0]
                yield pd.DataFrame({
                    "a": np.concatenate([nodes[at], nodes[moved]]),
                    "b": pd.array(np.concatenate([np.zeros(len(at), np.int64), nodes[label[moved]]]), "Int64"),
                    "n": np.concatenate([found[at], np.zeros(len(moved))]).astype(np.int64),
                    "edge": np.arange(len(at) + len(moved)) >= len(at)})

    found = (dealt.repartition(*keys).sortWithinPartitions(*keys)
             .mapInPandas(compared, "a long, b long, n long, edge boolean"))
    return found.select("a", F.when(F.col("edge"), F.col("b")).alias("b"), "n")


def near_duplicates(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", *,
                    cosine: float = COSINE, margin: float = MARGIN, **options) -> DataFrame:
    """`key`, `n_links`, `component_id`, `kept` for every row.

    Linked are vectors of equal label, and equal length, whose cosine in double
    precision is at least `cosine`. Vectors that are null, empty, zero, or hold
    a null or non-finite component, and those without a label, link with
    nothing. Equal vectors are compared once and counted as often as they
    occur. `component_id` is the least key reachable; a row with a null key has
    no part in it and is kept. Other columns are not read.
    """
    kind = vectors.schema[key].dataType.simpleString()
    rows, binary = _prepared(vectors, key, vector, label)
    rows = materialize(rows, "vectors")
    classes = (rows.where("digest IS NOT NULL").groupBy("digest")
               .agg(F.count("*").alias("copies"), F.min(F.col("key").cast(kind)).alias("least"), F.first("label").alias("label"),
                    F.first("size").alias("size"), F.first("data").alias("data"))
               .withColumn("node", F.monotonically_increasing_id()))
    classes = materialize(classes, "classes")
    found = materialize(links(classes, binary, cosine, margin, **options), "found")
    degrees = found.groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("others"))
    labels = components(found.where("b IS NOT NULL").select("a", "b"))
    joined = (classes.select("node", "digest", "copies", "least").join(degrees, "node", "left")
              .join(labels.withColumnRenamed("label", "root"), "node", "left").withColumn("root", F.coalesce("root", "node")))
    joined = materialize(joined, "joined")
    least = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    by_class = materialize(joined.join(least, "root").select(
        "digest", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"), "by_class")
    own = F.col("key").cast(kind)
    component = F.when(F.col("digest").isNull(), own).otherwise(F.col("component_id"))
    return (rows.select("key", "digest").join(by_class, "digest", "left")
            .select(own.alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                    (own.isNull() | own.eqNullSafe(component)).alias("kept")))
