"""Removal of repeated byte strings: sorted sample suffixes, from which the order of the others is induced.

The suffixes that begin at a sampled k-mer (the least hash of every window, so
that equal windows sample the same place) are sorted outside memory by Spark.
From their order and common prefixes those of the suffixes one byte further
left follow by a stable distribution on that byte, and so on up to the k-mer's
farthest window: induced sorting, cut off at the string length that matters.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from wardline.llm.common import utf8, whole_groups
from wardline.session import materialize

LENGTH = 100
KMER = 32
#: Contexts of one k-mer that are sorted in one piece; the windows of k-mers with more are compared one by one.
WIDE = 4096
#: Share of a sample's k-mers from which one counts as frequent, and documents in the sample; both only choose a path.
FREQUENT = 0.001
PROBED = 2000
_CHUNK = 1 << 21
_KMER_BASE, _CONTEXT_BASE = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
_LOW = np.uint64(0xFFFFFFFF)


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Hash:
    """Hashes of substrings of one array of bytes, from its prefix sums."""

    _tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, base: int, data: np.ndarray):
        size = len(data) + 1
        if base not in self._tables or len(self._tables[base][0]) < size:
            room = max(size, _CHUNK + (_CHUNK >> 2))
            self._tables[base] = _powers(base, room), _powers(pow(base, -1, 1 << 64), room)
        up, self.down = self._tables[base]
        self.sums = np.zeros(size, np.uint64)
        np.cumsum((data + np.uint64(1)) * up[:len(data)], out=self.sums[1:])

    def __call__(self, start, end) -> np.ndarray:
        return _mixed((self.sums[end] - self.sums[start]) * self.down[start])

    def all(self, size: int) -> np.ndarray:
        return _mixed((self.sums[size:] - self.sums[:-size]) * self.down[:len(self.sums) - size])


def _mixed(values: np.ndarray) -> np.ndarray:
    for _ in range(2):
        values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every `width` values in a row, from the running minima of blocks."""
    size = -(-len(values) // width) * width
    blocks = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    blocks[:len(values)] = values
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:len(values) - width + 1], ahead[width - 1:len(values)])


def _chunks(batches: Iterable[pd.DataFrame], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes of many documents in a row, with key, offset and end of each; long documents come in overlapping parts."""

    def joined(parts: list[tuple[int, int, bytes]]):
        sizes = np.array([len(p[2]) for p in parts])
        return (np.frombuffer(b"".join(p[2] for p in parts), np.uint8), np.array([p[0] for p in parts], np.int64),
                np.array([p[1] for p in parts], np.int64), np.cumsum(sizes))

    parts, held = [], 0
    for batch in batches:
        for key, text in zip(batch["key"], batch["t"]):
            data = utf8(text)
            for at in range(0, max(len(data) - length + 1, 0), _CHUNK):
                part = data[at:at + _CHUNK + length - 1]
                parts.append((key, at, part))
                held += len(part)
                if held >= _CHUNK:
                    yield joined(parts)
                    parts, held = [], 0
    if parts:
        yield joined(parts)


def _anchors(data: np.ndarray, ends: np.ndarray, length: int, k: int) -> tuple[np.ndarray, ...]:
    """Part, k-mer hash, context hash, first window, bytes from there to the anchor, and windows, of every run of
    windows with one anchor: the rightmost of the k-mers with the least hash."""
    wide = data.astype(np.uint64)
    kmers = _Hash(_KMER_BASE, wide).all(k)
    key = (kmers & ~_LOW) | (_LOW - np.arange(len(kmers), dtype=np.uint64))
    place = (_LOW - (_sliding_least(key, length - k + 1) & _LOW)).astype(np.int64)
    part = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    first = np.arange(len(place))
    inside = first + length <= ends[part[:len(place)]]
    first, place = first[inside], place[inside]
    new = np.flatnonzero(np.append(True, place[1:] != place[:-1])[:len(place)])
    count = np.diff(np.append(new, len(first)))
    first, place = first[new], place[new]
    contexts = _Hash(_CONTEXT_BASE, wide)(first, first + count - 1 + length)
    contexts ^= _mixed((count + 1000 * (place - first)).astype(np.uint64))
    return part[place], kmers[place], contexts, first, place - first, count


def _first_of(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by the columns, and which of the ordered rows is the first with its values in the first two."""
    order = np.lexsort(columns[::-1])
    a, b = columns[0][order], columns[1][order]
    return order, np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))[:len(a)]


def _spans(keys: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> pd.DataFrame:
    """Intervals joined where they touch: a row per key with its `spans`, begins and ends in turn, as bytes."""
    order = np.lexsort((begins, keys))
    keys, begins, ends = keys[order], begins[order], ends[order]
    owner = np.unique(keys, return_inverse=True)[1] if len(keys) else keys
    room = int(ends.max()) + 1 if len(keys) else 1
    far = np.maximum.accumulate(ends + owner * room)  # keys lie apart, so one running maximum serves all
    new = np.append(True, begins[1:] + owner[1:] * room > far[:-1])[:len(keys)]
    last = np.append(new[1:], True)[:len(keys)]
    keys, pairs = keys[new], np.stack([begins[new], far[last] - owner[last] * room], axis=1)
    cuts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))[:len(keys)]
    return pd.DataFrame({"key": keys[cuts], "spans": [p.astype("<i8").tobytes() for p in np.split(pairs, cuts[1:])] if len(keys) else []})


def _sampled(docs: DataFrame, length: int, k: int, frequent: frozenset[int]) -> DataFrame:
    """Sampled places (`kmer`, `context`, `key`, `place`), and repeats already known in a chunk (`spans`).

    Of equal contexts in a chunk only the first goes on; the others are repeats.
    Frequent k-mers go on as their windows, each a k-mer and context of its own.
    """
    columns = ["kmer", "context", "key", "place", "spans"]
    known = np.array(sorted(frequent), np.int64)

    def mapped(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for data, keys, offsets, ends in _chunks(batches, length):
            part, kmer, context, first, left, count = _anchors(data, ends, length, k)
            begins = ends - np.diff(ends, prepend=0)
            rows = [kmer.view(np.int64), context.view(np.int64), keys[part], first - begins[part] + offsets[part], left, count, first]
            kept, repeated = _apart(rows)
            hot = np.isin(kept[0], known)
            if hot.any():
                times = kept[5][hot]
                step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                start = np.repeat(kept[6][hot], times) + step
                wide = data.astype(np.uint64)
                one = np.ones(len(start), np.int64)
                alone = [_Hash(_KMER_BASE, wide)(start, start + length).view(np.int64),
                         _Hash(_CONTEXT_BASE, wide)(start, start + length).view(np.int64),
                         np.repeat(kept[2][hot], times), np.repeat(kept[3][hot], times) + step, 0 * one, one, start]
                alone, again = _apart(alone)
                kept = [np.concatenate([a[~hot], b]) for a, b in zip(kept, alone)]
                repeated = [np.concatenate(pair) for pair in zip(repeated, again)]
            yield pd.DataFrame({"kmer": kept[0], "context": kept[1], "key": kept[2],
                                "place": kept[3] << 16 | kept[4] << 8 | kept[5], "spans": None}, columns=columns)
            local = _spans(repeated[2], repeated[3], repeated[3] + repeated[5] - 1 + length)
            yield local.assign(kmer=local["key"] * 0x9E3779B1 ^ 0x5555, context=0, place=0)[columns]

    return docs.mapInPandas(mapped, "kmer long, context long, key long, place long, spans binary")


def _apart(rows: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    order, first = _first_of(*rows[:4])
    return [column[order[first]] for column in rows], [column[order[~first]] for column in rows]


def _frequent(docs: DataFrame, length: int, k: int) -> frozenset[int]:
    """K-mers that a sample of the documents shows to be frequent, a thousand at most."""
    every = max(1, docs.count() // PROBED)
    probe = _sampled(docs.where(F.pmod(F.xxhash64("key"), F.lit(every)) == 0), length, k, frozenset()).where("spans IS NULL")
    counts = materialize(probe.groupBy("kmer").count(), "probe")
    total = counts.agg(F.sum("count")).first()[0] or 0
    least = max(8.0, FREQUENT * total)
    return frozenset(row["kmer"] for row in counts.where(F.col("count") >= least).select("kmer").collect())


def induced_repeats(right: list[bytes], left: list[bytes], groups: np.ndarray, keys: np.ndarray, starts: np.ndarray,
                    counts: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Rows and starts of windows that occur earlier, among sample suffixes of several groups.

    The rows come in the order of group and `right`, the text from the sampled
    place on; `left` is the text before it. Step n looks at the suffixes that
    begin n bytes before the places. Tuples of row and common prefix with the
    row before are carried on: a stable distribution by the byte to the left
    orders the next step, and its common prefixes are one more than the least
    between the rows that have become neighbours. Suffixes with a common prefix
    of `length` are equal windows, of which all but the first are repeats.
    """
    lefts = np.fromiter(map(len, left), np.int64, len(left))
    rights = np.fromiter(map(len, right), np.int64, len(right))
    table = np.frombuffer(b"".join(r[:length].ljust(length, b"\0") for r in right), np.uint8).reshape(-1, length)
    before = np.frombuffer(b"".join(p[::-1].ljust(length, b"\0")[:length] for p in left), np.uint8).reshape(-1, length)
    common = np.zeros(len(right), np.int64)
    differ = table[1:] != table[:-1]
    common[1:] = np.where(differ.any(1), differ.argmax(1), length)
    common[1:] = np.minimum(common[1:], np.minimum(rights[1:], rights[:-1]))
    common[1:][groups[1:] != groups[:-1]] = 0
    order = np.arange(len(right))
    rows, places = [], []
    for step in range(length):
        valid = (lefts[order] >= step) & (lefts[order] - step < counts[order])
        run = np.cumsum(common < length)
        at = order[valid]
        where = starts[at] + lefts[at] - step
        sequence, first = _first_of(run[valid], np.zeros(len(at), np.int64), keys[at], where)
        again = sequence[~first]
        rows.append(at[again])
        places.append(where[again])
        kept = lefts[order] > step
        if not kept.any():
            break
        least = _RangeLeast(common)
        old = np.flatnonzero(kept)
        byte = before[order[old], step]
        turn = np.argsort(byte, kind="stable")
        old, byte = old[turn], byte[turn]
        common = np.zeros(len(old), np.int64)
        same = byte[1:] == byte[:-1]
        common[1:][same] = 1 + least(old[:-1][same] + 1, old[1:][same])
        order = order[old]
    return np.concatenate(rows), np.concatenate(places)


class _RangeLeast:
    """Least value between two positions, both included."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 2 << len(self.levels) - 1 <= len(values):
            step = 1 << len(self.levels) - 1
            below = self.levels[-1]
            self.levels.append(np.minimum(below[:-step], below[step:]))

    def __call__(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        level = np.frexp((last - first + 1).astype(float))[1] - 1
        out = np.empty(len(first), np.int64)
        for number in np.unique(level):
            own = level == number
            values = self.levels[number]
            out[own] = np.minimum(values[first[own]], values[last[own] - (1 << int(number)) + 1])
        return out


def _keyed(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame | None]:
    """`key`, `t` with one long per document, and where that is not the given key a table of both.

    Given keys serve where they are unique longs. Otherwise documents are
    numbered in the order of key and text digest, null keys last; rows that
    agree in both are one document.
    """
    rows = docs.select(F.col(key).alias("k"), F.coalesce(text, F.lit("")).alias("t"))
    odd = rows.groupBy("k").count().where("count > 1 OR k IS NULL")
    if docs.schema[key].dataType.simpleString() in ("bigint", "int") and odd.isEmpty():
        return rows.select(F.col("k").cast("long").alias("key"), "t"), None
    digest = F.sha2("t", 256)
    named = rows.select("k", digest.alias("d")).distinct()
    nulls_last = F.col("k").asc_nulls_last()
    numbered = materialize(named.repartitionByRange(nulls_last, "d").sortWithinPartitions(nulls_last, "d")
                           .withColumn("key", F.monotonically_increasing_id()), "numbered")
    told = rows.withColumn("d", digest)
    match = told["k"].eqNullSafe(numbered["k"]) & (told["d"] == numbered["d"])
    once = told.dropDuplicates(["k", "d"])
    match = once["k"].eqNullSafe(numbered["k"]) & (once["d"] == numbered["d"])
    return materialize(once.join(numbered, match).select("key", "t"), "keyed"), numbered


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", *, length: int = LENGTH, k: int = KMER,
                   wide: int = WIDE, texts: bool = False) -> DataFrame:
    """`key`, `n_bytes`, `n_removed`, `n_spans`, `kept_sha256` for every row, with `texts` also the `spans` removed.

    A byte goes if a string of `length` bytes that covers it also starts
    earlier: in a document with a lesser key, or earlier in the same one.
    Matches lie within documents and overlaps count. Null and empty texts and
    those shorter than `length` keep all they have. Null keys come after all
    others, in the order of the text digest; so do different texts of one key.
    Rows that agree in key and text are one document, and each gets its result.
    Other columns are not read.
    """
    keyed, numbered = _keyed(docs, key, text)
    found = _sampled(keyed, length, k, _frequent(keyed, length, k))
    by_context = W.partitionBy("kmer", "context").orderBy("key", "place")
    by_kmer = W.partitionBy("kmer")
    judged = (found.repartition("kmer").withColumn("turn", F.row_number().over(by_context))
              .withColumn("contexts", F.sum(F.when(F.col("turn") == 1, 1).otherwise(0)).over(by_kmer))
              .where("spans IS NOT NULL OR turn > 1 OR contexts > 1").drop("context"))
    judged = materialize(judged, "judged")
    repeats = judged.where("spans IS NULL AND turn > 1").select("key", "place")
    mixed = judged.where("spans IS NULL AND turn = 1 AND contexts > 1")

    def merged(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            place = batch["place"].to_numpy()
            start = place >> 16
            yield _spans(batch["key"].to_numpy(), start, start + (place & 255) - 1 + length)

    wanted = mixed.groupBy("key").agg(F.collect_list(F.struct("kmer", "place", (F.col("contexts") > wide).alias("wide"))).alias("places"))

    def cut(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, held = [], 0
            for name, content, places in zip(batch["key"], batch["t"], batch["places"]):
                data = utf8(content)
                for p in places:
                    start, left, count = p["place"] >> 16, p["place"] >> 8 & 255, p["place"] & 255
                    if p["wide"]:
                        for at in range(start, start + count):
                            digest = hashlib.blake2b(data[at:at + length], digest_size=16).digest()
                            rows.append((int.from_bytes(digest[:8], "big", signed=True), digest, b"", name, at, 1, True))
                    else:
                        rows.append((p["kmer"], data[start + left:start + count - 1 + length], data[start:start + left], name,
                                     start, count, False))
                if len(rows) > 20_000:
                    yield pd.DataFrame(rows, columns=parts)
                    rows = []
            yield pd.DataFrame(rows, columns=parts)

    parts = ["kmer", "right", "left", "key", "start", "count", "wide"]
    # both sides grow with the corpus: the same plan, a merge join that AQE may split, at every size
    contexts = materialize(keyed.join(wanted.hint("merge"), "key").mapInPandas(
        cut, "kmer long, right binary, left binary, key long, start long, count long, wide boolean"), "contexts")

    def induced(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, groups in whole_groups(batches, ["kmer"]):
            row, start = induced_repeats(frame["right"].tolist(), frame["left"].tolist(), groups, frame["key"].to_numpy(),
                                         frame["start"].to_numpy(), frame["count"].to_numpy(), length)
            yield _spans(frame["key"].to_numpy()[row], start, start + length)

    schema = "key long, spans binary"
    narrow = contexts.where("NOT wide").repartition("kmer").sortWithinPartitions("kmer", "right").mapInPandas(induced, schema)
    windows = contexts.where("wide").select("right", "key", (F.col("start") * 65536 + 1).alias("place"))
    first = windows.groupBy("right").agg(F.min(F.struct("key", "place")).alias("first"))
    later = (windows.join(first, "right").where(F.struct("key", "place") != F.col("first")).select("key", "place"))
    every = (judged.where("spans IS NOT NULL").select("key", "spans")
             .unionByName(repeats.unionByName(later).mapInPandas(merged, schema)).unionByName(narrow))
    by_doc = every.groupBy("key").agg(F.collect_list("spans").alias("spans"))

    def finished(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for name, content, lists in zip(batch["key"], batch["t"], batch["spans"]):
                data = utf8(content)
                spans = np.empty((0, 2), np.int64)
                if lists is not None:
                    pairs = np.concatenate([np.frombuffer(s, "<i8").reshape(-1, 2) for s in lists])
                    one = _spans(np.zeros(len(pairs), np.int64), pairs[:, 0], pairs[:, 1])
                    spans = np.frombuffer(one["spans"].iloc[0], "<i8").reshape(-1, 2)
                edges = [0, *spans.ravel().tolist(), len(data)]
                kept = hashlib.sha256()
                for a, b in zip(edges[::2], edges[1::2]):
                    kept.update(data[a:b])
                rows.append((name, len(data), int((spans[:, 1] - spans[:, 0]).sum()), len(spans), kept.hexdigest(),
                             spans.tolist() if texts else None))
            yield pd.DataFrame(rows, columns=["key", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    told = keyed.join(by_doc.hint("merge"), "key", "left").mapInPandas(
        finished, "key long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<array<long>>")
    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", *(["spans"] if texts else [])]
    kind = docs.schema[key].dataType
    if numbered is None:
        return told.select(F.col("key").cast(kind).alias(key), *names)
    rows = docs.select(F.col(key).alias("k"), F.sha2(F.coalesce(text, F.lit("")), 256).alias("d"))
    back = numbered.join(told, "key").select(F.col("k").alias("own"), F.col("d").alias("digest"), *names)
    return rows.join(back, rows["k"].eqNullSafe(back["own"]) & (rows["d"] == back["digest"])).select(F.col("k").alias(key), *names)
