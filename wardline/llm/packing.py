"""Best-fit packing: token counts are matched by exact complements first, what is left by best fit."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from wardline.session import materialize

CAPACITY = 2048
END = 0
TOKENIZER = "byte_bpe_50k"
#: Pieces of one length that are numbered in one group, about.
ROWS_PER_SLOT = 65_536
#: Chunks that an encoder remembers, and the longest of them in characters.
_CACHED = 200_000
_LONGEST = 32


class _Ragged(Exception):
    """The text has white space other than single spaces at a chunk's edge."""


class Encoder(dict):
    """Ids of a text by the byte-level tokenizer, remembering the chunks between single spaces.

    The tokenizer's pattern never joins what single spaces part: a space goes
    to the word behind it. So the ids of a text are those of its chunks, each
    with its space, unless a chunk starts or ends with white space itself; such
    texts are encoded whole. At most `_CACHED` chunks of at most `_LONGEST`
    characters are kept, so memory is bounded whatever the texts hold.
    """

    def __init__(self, name: str = TOKENIZER):
        import base64

        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
        self.special = "<|endoftext|>"
        self.model = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                       special_tokens={self.special: len(ranks)})

    def __missing__(self, chunk: str) -> bytes:
        if not chunk or chunk[0].isspace() or chunk[-1].isspace():
            raise _Ragged
        ids = np.array(self.model.encode_ordinary(" " + chunk), "<u4").tobytes()
        if len(chunk) <= _LONGEST:
            if len(self) >= _CACHED:
                self.clear()
            self[chunk] = ids
        return ids

    def ids(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, "<u4")
        if self.special in text:
            return np.array(self.model.encode(text, allowed_special="all"), "<u4")
        first, *rest = text.split(" ")
        if not first or first[-1].isspace():
            return np.array(self.model.encode_ordinary(text), "<u4")
        try:
            tail = b"".join(map(self.__getitem__, rest))
        except _Ragged:
            return np.array(self.model.encode_ordinary(text), "<u4")
        return np.frombuffer(np.array(self.model.encode_ordinary(first), "<u4").tobytes() + tail, "<u4")


_encoders: dict[str, Encoder] = {}


def encoder(name: str) -> Encoder:
    if name not in _encoders:
        _encoders[name] = Encoder(name)
    return _encoders[name]


def pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", *, tokenizer: str = TOKENIZER,
           capacity: int = CAPACITY) -> DataFrame:
    """`key`, `piece`, `start`, `length`, `ids_crc32`: each document's ids and an end id, cut to at most `capacity`.

    Only the first piece of a document is shorter than `capacity`. A null text is empty: its one id is the end.
    """
    kind = docs.schema[key].dataType.simpleString()

    def mapped(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer).ids
        for batch in batches:
            rows = []
            for name, content in zip(batch["key"], batch["text"]):
                ids = np.append(encode(content), np.uint32(END)).astype("<u4")
                count = -(-len(ids) // capacity)
                cut = len(ids) - capacity * (count - 1)
                start = 0
                for number in range(count):
                    end = cut + number * capacity
                    rows.append((name, number, start, end - start, zlib.crc32(ids[start:end])))
                    start = end
            yield pd.DataFrame(rows, columns=["key", "piece", "start", "length", "ids_crc32"])

    schema = "key string, piece int, start long, length long, ids_crc32 long"
    return (docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text")).mapInPandas(mapped, schema)
            .select(F.col("key").cast(kind).alias(key), "piece", "start", "length", "ids_crc32"))


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Sequences as (lengths, how many of the kind), using up `counts`, a number of pieces by length.

    From the longest on, a length's gap is filled exactly by one, two or three
    available lengths, found in an index of their sums, as often as the rarest allows. What
    no combination completes is placed by best fit, again a length at a time.
    The work depends on `capacity` alone, not on the number of pieces.
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, count in counts.items():
        left[length] = count
    sums = Sums(left, capacity)
    made: list[tuple[tuple[int, ...], int]] = []
    for longest in np.flatnonzero(left)[::-1].tolist():
        for others in sums.filling(capacity - longest):
            need = Counter((longest, *others))
            times = min(int(left[length]) // uses for length, uses in need.items())
            if times:
                made.append(((longest, *others), times))
                for length, uses in need.items():
                    left[length] -= times * uses
            if not left[longest]:
                break
    _best_fit(left, capacity, made)
    return made


class Sums:
    """Hash index from sums to the available lengths, one, two or three, that add up to them.

    A length is its own sum. `pairs` has the greater length of each pair, the
    other being the rest of the sum; `triples` the greatest length of each
    triple, the rest of whose sum is looked up in `pairs`. Counts in `left` only
    fall, so pairs that have become impossible are dropped when they are met.
    The index takes two numbers for every two lengths that occur, at most the
    square of the capacity.
    """

    def __init__(self, left: np.ndarray, capacity: int):
        self.left = left
        lengths = np.flatnonzero(left)[::-1]
        self.pairs: dict[int, np.ndarray] = {}
        self.triples: dict[int, np.ndarray] = {}
        paired = np.zeros(capacity + 1, bool)
        for total in range(2, capacity):
            self._keep(total, lengths[(2 * lengths >= total) & (lengths < total)])
            paired[total] = total in self.pairs
        for total in range(3, capacity):
            greatest = lengths[(3 * lengths >= total) & (lengths < total)]
            self.triples[total] = greatest[paired[total - greatest]]

    def _keep(self, total: int, greater: np.ndarray) -> np.ndarray:
        """Those of `greater` that still form a pair with the rest of `total`; they are the entry from now on."""
        rest = total - greater
        found = greater[(self.left[rest] > 0) & (self.left[greater] > (greater == rest))]
        if len(found):
            self.pairs[total] = found
        else:
            self.pairs.pop(total, None)
        return found

    def _two(self, total: int) -> Iterator[tuple[int, int]]:
        if total in self.pairs:
            for greater in self._keep(total, self.pairs[total]).tolist():
                yield greater, total - greater

    def filling(self, gap: int) -> Iterator[tuple[int, ...]]:
        """Combinations that add up to `gap`, fewest lengths first, then the longest; counts may fall in between."""
        if gap == 0:
            yield ()
            return
        if self.left[gap]:
            yield (gap,)
        yield from self._two(gap)
        for greatest in self.triples.get(gap, np.empty(0, np.int64)).tolist():
            if self.left[greatest]:
                for pair in self._two(gap - greatest):
                    yield greatest, *pair


def _best_fit(left: np.ndarray, capacity: int, made: list[tuple[tuple[int, ...], int]]) -> None:
    """Place `left`, longest first, each length into the fullest open sequences that can hold it."""
    open_by_gap: dict[int, list[tuple[tuple[int, ...], int]]] = {}

    def put(lengths: tuple[int, ...], times: int, gap: int) -> None:
        if times:
            open_by_gap.setdefault(gap, []).append((lengths, times))

    for length in np.flatnonzero(left)[::-1].tolist():
        count = int(left[length])
        while count:
            gap = min((g for g in open_by_gap if g >= length), default=None)
            if gap is None:
                lengths, times, gap = (), count, capacity
            else:
                lengths, times = open_by_gap[gap].pop()
                if not open_by_gap[gap]:
                    del open_by_gap[gap]
            each = min(gap // length, count)
            filled = min(times, count // each)
            put((*lengths, *[length] * each), filled, gap - each * length)
            if lengths:
                put(lengths, times - filled, gap)
            count -= filled * each
    for kinds in open_by_gap.values():
        made.extend(kinds)


def places(made: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """The plan by runs of numbered pieces: where the run of a length starts, and where its pieces go."""
    used: dict[int, int] = {}
    rows, base = [], 0
    for lengths, times in made:
        offset = 0
        for length in dict.fromkeys(lengths):
            each = lengths.count(length)
            rows.append((length, used.get(length, 0), each, base, offset))
            used[length] = used.get(length, 0) + each * times
            offset += each * length
        base += times
    rows.sort()
    names = ("length", "number", "each", "sequence", "offset")
    return {name: np.array([row[i] for row in rows], np.int64) for i, name in enumerate(names)}


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", *, tokenizer: str = TOKENIZER,
         capacity: int = CAPACITY, rows_per_slot: int = ROWS_PER_SLOT) -> DataFrame:
    """The pieces of every document with `sequence_id` and `offset`.

    Only counts reach the driver, one for each length and for every
    `rows_per_slot` pieces of it; so does the plan made from the counts by length.
    Full pieces are sequences of their own (negative ids). The others are
    numbered by length, in groups of about `rows_per_slot` pieces, so a length
    that a third of all documents have is no task's alone, and look their place
    up by number. Repeated rows and keys are packed as often as they occur; null
    keys too. Empty tables give no rows. Other columns of `docs` are not read.
    """
    cut = materialize(pieces(docs, key, text, tokenizer=tokenizer, capacity=capacity), "pieces")
    order = [key, "piece", "ids_crc32"]
    whole = (cut.where(F.col("length") == capacity)
             .withColumn("sequence_id", -1 - F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long")))
    shorter = cut.where(F.col("length") < capacity)
    totals = np.zeros(capacity + 1, np.int64)
    for length, count in shorter.groupBy("length").count().collect():
        totals[length] = count
    slots = -(-totals // rows_per_slot)
    first_slot = slots.cumsum() - slots
    # at most one row for each length below the capacity, so it may be broadcast
    widths = cut.sparkSession.createDataFrame(
        [(int(n), int(slots[n]), int(first_slot[n])) for n in totals.nonzero()[0]], "length long, slots int, first_slot long")
    hashed = F.pmod(F.xxhash64(*order, "length"), F.col("slots"))
    dealt = (shorter.join(F.broadcast(widths), "length")
             .select(*cut.columns, (F.col("first_slot") + hashed).alias("slot")))
    in_slot = np.zeros(int(slots.sum()), np.int64)
    for slot, count in dealt.groupBy("slot").count().collect():
        in_slot[slot] = count
    ahead = in_slot.cumsum() - in_slot
    ahead -= np.repeat(totals.cumsum() - totals, slots)
    runs = places(plan({int(n): int(totals[n]) for n in totals.nonzero()[0]}, capacity))
    wide = int(totals.max()) + 1
    starts = runs["length"] * wide + runs["number"]

    def placed(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            length, slot = batch["length"].to_numpy(np.int64), batch.pop("slot").to_numpy(np.int64)
            number = ahead[slot] + batch.pop("number").to_numpy(np.int64)
            run = np.searchsorted(starts, length * wide + number, "right") - 1
            turn, within = np.divmod(number - runs["number"][run], runs["each"][run])
            batch["sequence_id"] = runs["sequence"][run] + turn
            batch["offset"] = runs["offset"][run] + within * length
            yield batch

    numbered = dealt.withColumn(
        "number", F.row_number().over(W.partitionBy("slot").orderBy(*order)).cast("long") - 1)
    kind = docs.schema[key].dataType.simpleString()
    names = ["piece", "start", "length", "ids_crc32"]
    rest = (numbered.select(F.col(key).cast("string").alias("key"), *names, "slot", "number")
            .mapInPandas(placed, "key string, piece int, start long, length long, ids_crc32 long, "
                                 "sequence_id long, offset long")
            .select(F.col("key").cast(kind).alias(key), *names, "sequence_id", "offset"))
    return whole.unionByName(rest)
