"""Exact top-k by inner product: distances to many pivots bound every score, and candidates are tried in the order of
their bounds until none left can enter the answer."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from wardline.llm.common import bounded_sample, whole_groups
from wardline.session import materialize

K = 5
SCALE = 256
PIVOTS = 64
#: Most vectors that the pivots are chosen from; all vectors are indexed.
SAMPLE = 4096
#: Most candidates and most queries, about, that meet in one piece of work.
CANDIDATES = 8192
QUERIES = 2048
#: Norms from which products are no longer exact in doubles; such vectors are multiplied as whole numbers, without bounds.
WIDE = 2.0 ** 26
#: Candidates tried before the first look at the bounds; each further try takes four times as many.
FIRST_TRY = 64
_LONG = 2 ** 63


@dataclass
class Cells:
    """What is known of the candidates nearest to each pivot: their number, greatest norm, and range of distances to all pivots."""

    numbers: np.ndarray
    count: np.ndarray
    norm: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def bounds(self, norm: float, distances: np.ndarray) -> np.ndarray:
        """No score of a query with a vector of a cell is above the cell's bound."""
        apart = np.maximum(np.maximum(self.low - distances, distances - self.high), 0)
        return _bound(norm, self.norm, apart.max(1) if apart.shape[1] else np.zeros(len(self.norm)))


def _bound(norm: float, norms: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """Upper bounds of inner products from the norms and lower bounds of the distances.

    The distances are single precision, so they are trusted but for a millionth of the norms.
    """
    apart = np.maximum(apart - 1e-6 * (norm + norms + 1), 0)
    return np.minimum((norm * norm + norms * norms - apart * apart) / 2, norm * norms) * (1 + 1e-9) + 1


def pivots_of(rows: np.ndarray, most: int = PIVOTS) -> np.ndarray:
    """Rows far from each other: the longest, then always the one farthest from those chosen."""
    if not len(rows) or not rows.shape[1]:
        return rows[:0]
    squares = (rows * rows).sum(1)
    chosen, gap = [int(squares.argmax())], np.full(len(rows), np.inf)
    while True:
        gap = np.minimum(gap, ((rows - rows[chosen[-1]]) ** 2).sum(1))
        if len(chosen) == most or not gap.max():
            return rows[chosen]
        chosen.append(int(gap.argmax()))


def _distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    gaps = (rows * rows).sum(1)[:, None] - 2 * rows @ pivots.T + (pivots * pivots).sum(1)
    return np.sqrt(np.maximum(gaps, 0)).astype(np.float32)


def _exact(rows: np.ndarray, query: np.ndarray, wide: bool) -> np.ndarray:
    """Inner products as longs; those beyond 64 bits count as the greatest or least long."""
    if not wide:
        return (rows @ query).astype(np.int64)
    whole = [int(x) for x in query]
    sums = (sum(int(x) * y for x, y in zip(row, whole)) for row in rows.tolist())
    return np.array([min(max(s, -_LONG), _LONG - 1) for s in sums], np.int64)


def best_of(rows: np.ndarray, keys: np.ndarray, bounds: np.ndarray, query: np.ndarray, k: int, floor: int, wide: bool,
            ) -> tuple[np.ndarray, np.ndarray, int]:
    """Positions and scores of the `k` best rows that reach `floor`, ties to the smaller key; and how many were tried.

    Rows are tried from the highest bound down. Once `k` scores are known and
    the next bound is below the least of them, no row left can enter.
    """
    open_ = np.flatnonzero(bounds >= floor)
    order = open_[np.argsort(-bounds[open_], kind="stable")]
    found, scores, at, size = np.empty(0, np.int64), np.empty(0, np.int64), 0, FIRST_TRY
    while at < len(order) and (len(found) < k or bounds[order[at]] >= scores[-1]):
        tried = order[at:at + size]
        fresh = _exact(rows[tried], query, wide)
        reach = fresh >= (max(floor, scores[-1]) if len(found) == k else floor)
        found, scores = np.concatenate([found, tried[reach]]), np.concatenate([scores, fresh[reach]])
        best = np.lexsort((keys[found], ~scores))[:k]
        found, scores = found[best], scores[best]
        at, size = at + len(tried), size * 4
    return found, scores, at


def _indexed(vectors: DataFrame, key: str, vector: str, scale: float) -> DataFrame:
    """`key`, `keyed` (false for a null key, which is 0 then), `size`, `data` of every usable vector.

    Components are whole numbers in doubles. Keys are never null, as pandas would
    make doubles of longs beside nulls.
    """

    def mapped(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            data = []
            for numbers in batch["vector"]:
                values = np.array([np.nan if x is None else x for x in numbers], np.float64)
                with np.errstate(over="ignore"):
                    values = np.floor(scale * values)
                data.append(values.tobytes() if np.isfinite(values).all() else None)
            out = batch[["key", "keyed"]].assign(size=[len(x) for x in batch["vector"]], data=data)
            yield out[out["data"].notna()]

    return (vectors.select(F.coalesce(F.col(key).cast("long"), F.lit(0)).alias("key"), F.col(key).isNotNull().alias("keyed"),
                           F.col(vector).cast("array<double>").alias("vector"))
            .where("vector IS NOT NULL").mapInPandas(mapped, "key long, keyed boolean, size int, data binary"))


def _matrix(data: Iterable[bytes], kind: type) -> np.ndarray:
    return np.stack([np.frombuffer(row, kind) for row in data])


def _pivot_table(rows: DataFrame, books: dict[int, np.ndarray]) -> DataFrame:
    """The rows with norm, cell (the nearest pivot, or -1 for a wide vector) and distances to all pivots."""
    shared = rows.sparkSession.sparkContext.broadcast(books)

    def mapped(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for size, part in batch.groupby("size"):
                values = _matrix(part["data"], np.float64)
                with np.errstate(over="ignore"):
                    norms = np.linalg.norm(values, axis=1)
                pivots = shared.value.get(int(size), np.empty((0, int(size))))
                wide = ~(norms < WIDE)
                table = _distances(np.where(wide[:, None], 0, values), pivots)
                cell = table.argmin(1) if len(pivots) else np.zeros(len(values), np.int64)
                yield part.assign(norm=norms, cell=np.where(wide, -1, cell).astype(np.int32),
                                  table=[row.tobytes() for row in table])

    return rows.mapInPandas(mapped, "key long, keyed boolean, size int, data binary, norm double, cell int, table binary")


def _ranges(index: DataFrame) -> DataFrame:
    """One row per size, cell and pivot: number of candidates, greatest norm, least and greatest distance.

    A cell without pivots, or of wide vectors, has one row with pivot -1. There
    are at most as many rows as the sample can have pivots, squared.
    """

    def mapped(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for (size, cell), part in batch.groupby(["size", "cell"]):
                table = _matrix(part["table"], np.float32)
                known = cell >= 0 and table.shape[1] > 0
                low, high = (table.min(0), table.max(0)) if known else (np.zeros(1), np.zeros(1))
                yield pd.DataFrame({"size": size, "cell": cell, "pivot": np.arange(len(low)) if known else [-1], "n": len(part),
                                    "norm": part["norm"].max(), "low": low, "high": high})

    schema = "size int, cell int, pivot int, n long, norm double, low double, high double"
    return (index.select("size", "cell", "norm", "table").mapInPandas(mapped, schema).groupBy("size", "cell", "pivot")
            .agg(F.sum("n").alias("n"), F.max("norm").alias("norm"), F.min("low").alias("low"), F.max("high").alias("high")))


def _cells(ranges: pd.DataFrame) -> dict[int, Cells]:
    found = {}
    for size, part in ranges.groupby("size"):
        part = part[part["cell"] >= 0].sort_values(["cell", "pivot"])
        heads = part.drop_duplicates("cell")
        pivots = int((part["pivot"] >= 0).sum() // max(len(heads), 1))
        shape = (len(heads), pivots)
        low, high = (part[side].to_numpy()[:shape[0] * shape[1]].reshape(shape) for side in ("low", "high"))
        found[int(size)] = Cells(heads["cell"].to_numpy(), heads["n"].to_numpy(), heads["norm"].to_numpy(), low, high)
    return found


def _looks(queries: DataFrame, cells: dict[int, Cells], first: bool) -> DataFrame:
    """The cells every query looks into: its own first, then all others whose bound reaches its `floor`."""
    shared = queries.sparkSession.sparkContext.broadcast(cells)

    def mapped(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            looks = []
            for size, own, norm, table, floor in zip(batch["size"], batch["cell"], batch["norm"], batch["table"], batch["floor"]):
                about = shared.value[int(size)]
                if first:
                    looks.append([int(own)])
                    continue
                reach = np.ones(len(about.numbers), bool)
                if own >= 0:
                    reach = about.bounds(norm, np.frombuffer(table, np.float32).astype(float)) >= floor
                # wide vectors have no bounds, so every query looks at those
                looks.append([int(c) for c in [*about.numbers[reach], -1] if c != own])
            yield batch.assign(looks=looks)

    schema = "row long, key long, keyed boolean, size int, data binary, norm double, cell int, table binary, floor long"
    return (queries.mapInPandas(mapped, schema + ", looks array<int>").withColumn("cell", F.explode("looks")).drop("looks"))


def _searched(index: DataFrame, looks: DataFrame, counts: DataFrame, k: int, candidates: int, queries: int) -> DataFrame:
    """`row`, `key`, `keyed`, `score`: the `k` best of every piece of a cell for every query that looks into it.

    A cell is cut into pieces by hash, on both sides, so that no task holds more
    than about `candidates` vectors and `queries` queries, whatever its size.
    """
    group = ["size", "cell"]
    asked = looks.groupBy(*group).agg(F.ceil(F.count("*") / queries).cast("int").alias("turns"))
    plan = counts.join(asked, group).select(*group, "turns", F.ceil(F.col("n") / candidates).cast("int").alias("pieces"))
    part = lambda column: F.explode(F.sequence(F.lit(0), F.col(column) - 1))
    salt = lambda name, column: F.pmod(F.xxhash64("key", name), F.col(column)).cast("int")
    listed = (index.join(plan, group).withColumn("piece", salt("data", "pieces")).withColumn("turn", part("turns"))
              .select(*group, "piece", "turn", F.lit(False).alias("asks"), F.lit(0).cast("long").alias("row"), "key", "keyed",
                      "data", "norm", "table", F.lit(0).cast("long").alias("floor")))
    asking = (looks.join(plan, group).withColumn("turn", F.pmod(F.xxhash64("row"), F.col("turns")).cast("int"))
              .withColumn("piece", part("pieces"))
              .select(*group, "piece", "turn", F.lit(True).alias("asks"), "row", "key", "keyed", "data", "norm", "table", "floor"))
    keys = [*group, "piece", "turn"]

    def compared(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, groups in whole_groups(batches, keys):
            for _, rows in frame.groupby(groups, sort=False):
                own, asks = rows[~rows["asks"]], rows[rows["asks"]]
                if not len(own) or not len(asks):
                    continue
                values, table = _matrix(own["data"], np.float64), _matrix(own["table"], np.float32).T
                norms, wide = own["norm"].to_numpy(), bool(own["cell"].iloc[0] < 0)
                # a null key is tried like any other and ranks last among equals
                known = own["keyed"].to_numpy(bool)
                ids = np.where(known, own["key"].to_numpy(), _LONG - 1)
                out = {"row": [], "key": [], "keyed": [], "score": []}
                for row, key, data, norm, far, floor in zip(*(asks[c] for c in ("row", "key", "data", "norm", "table", "floor"))):
                    beyond = wide or not norm < WIDE
                    far = np.frombuffer(far, np.float32)
                    if beyond:
                        bounds = np.full(len(own), np.inf)
                    else:
                        apart = np.abs(table - far[:, None]).max(0) if len(far) else np.zeros(len(own))
                        bounds = _bound(norm, norms, apart)
                    others = np.flatnonzero(~known | (ids != key))
                    at, scores, _ = best_of(values[others] if len(others) < len(own) else values, ids[others], bounds[others],
                                            np.frombuffer(data, np.float64), k, int(floor), beyond)
                    out["row"] += [row] * len(at)
                    out["key"] += ids[others[at]].tolist()
                    out["keyed"] += known[others[at]].tolist()
                    out["score"] += scores.tolist()
                yield pd.DataFrame(out).astype({"row": "int64", "key": "int64", "keyed": "bool", "score": "int64"})

    return (listed.unionByName(asking).repartition(*keys).sortWithinPartitions(*keys, "asks")
            .mapInPandas(compared, "row long, key long, keyed boolean, score long"))


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("row").orderBy(F.col("score").desc(), F.col("keyed").desc(), "key")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", *, k: int = K,
          scale: float = SCALE, pivots: int = PIVOTS, sample: int = SAMPLE, candidates: int = CANDIDATES,
          queries: int = QUERIES) -> DataFrame:
    """`query_id`, `rank`, `vec_id`, `score`: for every row that `is_query` holds for, the `k` rows of the greatest score.

    `is_query` is a condition on a column `key`, the integer key of a row.
    Components become floor(`scale` * x); the score is the integer inner
    product, ties go to the smaller key. Answers are exact: distances to
    `pivots` vectors, kept with every row, give the greatest lower bound of its
    distance to a query and, with the norms, an upper bound of the score. A
    query searches the cell of its nearest pivot, which gives a floor for its
    k-th score; then every cell whose bound reaches that, and in it candidates in
    the order of their bounds until the next is below the k-th best.

    Vectors that are null or hold a null or non-finite component (also after
    scaling) take no part; only vectors of equal length are compared, empty ones
    with score 0. A query's own row is that with its key, so rows repeated under
    one key do not answer each other; as candidates of others all of them count,
    and a repeated query is answered once per row. Rows with a null key are
    candidates, last among equals. Scores beyond 64 bits count as the greatest or
    least long. An empty table gives an empty table. Other columns are not read.
    """
    spark = vectors.sparkSession
    rows = materialize(_indexed(vectors, key, vector, scale), "vectors")
    # wide ones take no part in choosing pivots; which rows are chosen changes the work and not the answers
    chosen = bounded_sample(rows, sample, "data", "key").toPandas()
    books = {}
    for size, part in chosen.groupby("size"):
        values = _matrix(part["data"], np.float64)
        with np.errstate(over="ignore"):
            values = values[np.linalg.norm(values, axis=1) < WIDE]
        books[int(size)] = pivots_of(values, pivots)
    index = materialize(_pivot_table(rows, books), "pivot-table")
    ranges = materialize(_ranges(index), "ranges")
    cells = _cells(ranges.toPandas())
    counts = ranges.groupBy("size", "cell").agg(F.max("n").alias("n"))
    asking = materialize(index.where(F.col("keyed") & is_query).select(F.monotonically_increasing_id().alias("row"), "*",
                                                      F.lit(-_LONG).cast("long").alias("floor")), "queries")
    near = materialize(_searched(index, _looks(asking, cells, True), counts, k, candidates, queries), "near")
    full = _ranked(near, k).groupBy("row").agg(F.min("score").alias("kth"), F.count("*").alias("n")).where(F.col("n") == k)
    floors = asking.join(full, "row", "left").withColumn("floor", F.coalesce("kth", "floor")).drop("kth", "n")
    far = _searched(index, _looks(floors, cells, False), counts, k, candidates, queries)
    named = asking.select("row", F.col("key").alias("query_id"))
    kind = vectors.schema[key].dataType.simpleString()
    return (_ranked(near.unionByName(far), k).join(named, "row")
            .select(F.col("query_id").cast(kind).alias("query_id"), F.col("rank").cast("int").alias("rank"),
                    F.when(F.col("keyed"), F.col("key")).cast(kind).alias("vec_id"), "score"))
