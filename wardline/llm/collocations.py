"""Phrase collocations: one count of padded five-word windows, whose sums by ever shorter prefixes are all phrase counts."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from wardline.llm.common import utf8
from wardline.session import materialize

#: Most words of a phrase, and least occurrences.
WORDS = 5
LEAST = 100
#: First phrases of each language that are returned.
TOP = 2000
#: A phrase goes where a longer one has at least this percent of its occurrences.
PERCENT = 100
SCALE = 1000
UNKNOWN = "und"
#: Buckets in which words, pairs and longer prefixes are counted beforehand: a byte each in a task, a bit each in the driver
#: and when shared.
BUCKETS = 1 << 24
_PART = 1 << 16
_SALTS = 64
#: Bytes of text that are worked on in one go.
SLICE = 1 << 20

#: Most distinct windows that a task adds up before it sends them on.
HELD = 1 << 19

_TABLE = bytearray(range(256))
for _sign in range(ord("A"), ord("Z") + 1):
    _TABLE[_sign] = _sign + 32
for _sign in b".,;:!?\x0a\x0b\x0c\x0d":
    _TABLE[_sign] = 0x0A
_TABLE = bytes(_TABLE)
_GAP = np.zeros(256, bool)
_GAP[[0x20, 0x09, 0x0A]] = True


def _slices(texts: Iterable[str | None]) -> Iterator[bytes]:
    """The texts as one stream, lower case, every break between pieces a newline, cut only before a gap."""
    held, size = [], 0
    for text in texts:
        data = utf8(text).translate(_TABLE)
        at = 0
        while size + len(data) - at >= SLICE:
            stop = at + SLICE - size
            cuts = [cut for cut in (data.find(gap, stop) for gap in (b" ", b"\t", b"\n")) if cut >= 0]
            if not cuts:
                break
            yield b"".join([*held, data[at:min(cuts)]])
            held, size, at = [], 0, min(cuts)
        held += [data[at:], b"\n"]
        size += len(data) - at + 1
    if held:
        yield b"".join(held)


def _windows(texts: Iterable[str | None], words: int) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """Distinct words of a slice, and a row per word: the numbers of it and the words after it, -1 behind its piece's end.

    The last words of a slice are carried to the next, where their windows end.
    """
    carried: list[bytes] = []
    joined = np.empty(0, bool)  # whether a carried word goes on with the piece of the word before it
    broken = True  # whether the piece ended behind the last carried word
    stream = _slices(texts)
    data = next(stream, None)
    while data is not None:
        following = next(stream, None)
        signs = np.frombuffer(data, np.uint8)
        starts = ~_GAP[signs]
        starts[1:] &= _GAP[signs[:-1]]
        breaks = np.cumsum(signs == 0x0A)
        at = breaks[starts]
        found = carried + data.split()
        on = np.ones(len(at), bool)
        if len(at):
            on[1:] = at[1:] == at[:-1]
            on[0] = not broken and at[0] == 0
            broken = bool(breaks[-1] > at[-1])
        else:
            broken = broken or bool(len(breaks) and breaks[-1])
        on = np.concatenate([joined, on])
        numbers: dict[bytes, int] = {}
        ids = np.fromiter((numbers.setdefault(word, len(numbers)) for word in found), np.int64, len(found))
        own = len(ids) if following is None else max(len(ids) - words + 1, 0)
        grid = np.full((own, words), -1, np.int64)
        grid[:, 0] = ids[:own]
        going = np.ones(own, bool)
        for step in range(1, words):
            going &= np.append(on[step:step + own], np.zeros(own - len(on[step:step + own]), bool))
            grid[going, step] = ids[step:step + own][going[:len(ids) - step]]
        if own:
            yield list(numbers), grid
        carried, joined = found[own:], on[own:]
        data = following


def _hashes(lang: str, vocabulary: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(utf8(lang))
    return np.fromiter((xxhash.xxh64_intdigest(word, seed) for word in vocabulary), np.uint64, len(vocabulary))


def _followed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    mixed = left * np.uint64(0x9E3779B97F4A7C15) ^ right
    mixed = (mixed ^ mixed >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ mixed >> np.uint64(32)


def _buckets(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (hashes % np.uint64(buckets)).astype(np.int64)


def _marked(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1) > 0


def _cut_at_pairs(grid: np.ndarray, hashed: np.ndarray, bits: np.ndarray, buckets: int) -> None:
    """End windows before the first word, or pair of words, that is rare for certain; a rare first word leaves nothing."""
    frequent = _marked(bits, _buckets(hashed, buckets))
    grid[~frequent[grid[:, 0]]] = -1
    for step in range(1, grid.shape[1]):
        rows = np.flatnonzero(grid[:, step] >= 0)
        pairs = _followed(hashed[grid[rows, step - 1]], hashed[grid[rows, step]])
        grid[rows[~(_marked(bits, _buckets(pairs, buckets)) & frequent[grid[rows, step]])], step:] = -1


def _prefixes(grid: np.ndarray, hashed: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """From three words on: the size of a prefix, the windows that have it at this moment, and its hash there."""
    rows = np.flatnonzero(grid[:, 1] >= 0) if grid.shape[1] > 1 else np.empty(0, np.int64)
    own = _followed(hashed[grid[rows, 0]], hashed[grid[rows, 1]])
    for step in range(2, grid.shape[1]):
        on = grid[rows, step] >= 0
        rows, own = rows[on], own[on]
        own = _followed(own, hashed[grid[rows, step]])
        yield step + 1, rows, own


def _languages(batch: pd.DataFrame) -> Iterator[tuple[str, list[str | None]]]:
    for lang, rows in batch.groupby("lang", sort=True):
        yield lang, rows["text"].tolist()


def _add(table: np.ndarray, at: np.ndarray, times: np.ndarray | None, least: int) -> None:
    if times is None:
        at, times = np.unique(at, return_counts=True)
    else:
        at, where = np.unique(at, return_inverse=True)
        times = np.bincount(where, times, len(at)).astype(np.int64)
    table[at] = np.minimum(table[at].astype(np.int64) + times, least)


def frequent(texts: DataFrame, pairs: np.ndarray | None = None, words: int = WORDS, least: int = LEAST,
             buckets: int = BUCKETS) -> np.ndarray:
    """For every bucket whether what falls into it occurs `least` times together, as bits.

    Without `pairs` words and pairs of neighbours are counted, else the prefixes
    of three and more words of the windows that `pairs` leaves. What is in a
    bucket below `least` is rarer than that for certain; the rest may be
    frequent. Tasks add up by bucket, up to `least`, and send parts of 65,536
    buckets, so the driver gets `buckets` bits.
    """
    kind = np.min_scalar_type(least)
    shared = texts.sparkSession.sparkContext.broadcast(pairs)

    def counted(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = np.zeros(-(-buckets // _PART) * _PART, kind)
        known = shared.value
        for batch in batches:
            for lang, rows in _languages(batch):
                for vocabulary, grid in _windows(rows, 2 if known is None else words):
                    hashed = _hashes(lang, vocabulary)
                    if known is None:
                        _add(table, _buckets(hashed, buckets), np.bincount(grid[:, 0], minlength=len(hashed)), least)
                        both = grid[grid[:, 1] >= 0]
                        _add(table, _buckets(_followed(hashed[both[:, 0]], hashed[both[:, 1]]), buckets), None, least)
                    else:
                        _cut_at_pairs(grid, hashed, known, buckets)
                        for _, _, own in _prefixes(grid, hashed):
                            _add(table, _buckets(own, buckets), None, least)
        parts = table.reshape(-1, _PART)
        used = np.flatnonzero(parts.any(1))
        for at in range(0, len(used), 32):
            yield pd.DataFrame({"part": used[at:at + 32], "counts": [part.tobytes() for part in parts[used[at:at + 32]]]})

    def added(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found, part, total = [], None, np.zeros(_PART, np.int64)
        for batch in batches:
            for number, data in zip(batch["part"], batch["counts"]):
                if number != part and part is not None:
                    found.append((part, np.packbits(total >= least).tobytes()))
                    total = np.zeros(_PART, np.int64)
                part, total = number, np.minimum(total + np.frombuffer(data, kind), least)
        if part is not None:
            yield pd.DataFrame([*found, (part, np.packbits(total >= least).tobytes())], columns=["part", "bits"])

    sums = (texts.mapInPandas(counted, "part int, counts binary").repartition("part").sortWithinPartitions("part")
            .mapInPandas(added, "part int, bits binary"))
    bits = np.zeros(-(-buckets // _PART) * _PART // 8, np.uint8)
    for row in sums.toLocalIterator():
        bits[row["part"] * _PART // 8:(row["part"] + 1) * _PART // 8] = np.frombuffer(row["bits"], np.uint8)
    return bits


def _summed(rows: np.ndarray) -> np.ndarray:
    """Distinct rows, whose last column is the sum of the last columns."""
    codes = rows[:, 0]
    for column in rows.T[1:-1]:  # equal rows get equal numbers, one column after the other
        codes = np.unique(codes * (column.max(initial=0) + 2) + column + 1, return_inverse=True)[1]
    _, first, where = np.unique(codes, return_index=True, return_inverse=True)
    found = rows[first]
    found[:, -1] = np.bincount(where, rows[:, -1], len(first)).astype(np.int64)
    return found


def window_counts(texts: DataFrame, pairs: np.ndarray, longer: np.ndarray, words: int = WORDS, buckets: int = BUCKETS,
                  held_rows: int = HELD) -> DataFrame:
    """`lang`, `w1` to `w<words>`, `n`: how often a window occurs at a word, by task.

    A window ends with its piece, and before the first word with which it is
    rare for certain, since no phrase that goes on is frequent; behind its end
    it is null. Words that are rare themselves add up in the empty window.
    """
    shared = texts.sparkSession.sparkContext.broadcast((pairs, longer))
    names = [f"w{i + 1}" for i in range(words)]

    def spelled(numbers: dict[bytes, int], rows: np.ndarray) -> Iterator[pd.DataFrame]:
        words_ = np.array([*(word.decode() for word in numbers), None], object)
        for at in range(0, len(rows), 1 << 16):
            part = rows[at:at + (1 << 16)]
            yield pd.DataFrame({name: words_[part[:, i]] for i, name in enumerate(["lang", *names])}).assign(n=part[:, -1])

    def counted(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pairs, longer = shared.value
        numbers: dict[bytes, int] = {}
        held: list[np.ndarray] = []
        for batch in batches:
            for lang, rows in _languages(batch):
                for vocabulary, grid in _windows(rows, words):
                    hashed = _hashes(lang, vocabulary)
                    _cut_at_pairs(grid, hashed, pairs, buckets)
                    for size, at, own in _prefixes(grid, hashed):
                        grid[at[~_marked(longer, _buckets(own, buckets))], size - 1:] = -1
                    grid = _summed(np.column_stack([grid, np.ones(len(grid), np.int64)]))
                    # numbers of the task; the last is for no word
                    own = np.full(len(vocabulary) + 1, -1)
                    for at in np.unique(grid[:, :-1]).tolist():
                        if at >= 0:
                            own[at] = numbers.setdefault(vocabulary[at], len(numbers))
                    grid[:, :-1] = own[grid[:, :-1]]
                    named = np.full((len(grid), 1), numbers.setdefault(utf8(lang), len(numbers)))
                    held.append(np.hstack([named, grid]))
                    if sum(map(len, held)) > held_rows:
                        held = [_summed(np.concatenate(held))]
                        if len(held[0]) > held_rows // 2:
                            yield from spelled(numbers, held[0])
                            numbers, held = {}, []
        if held:
            yield from spelled(numbers, _summed(np.concatenate(held)))

    return texts.mapInPandas(counted, "lang string, " + "".join(f"{name} string, " for name in names) + "n long")


def phrase_counts(windows: DataFrame, least: int = LEAST, words: int = WORDS) -> DataFrame:
    """`lang`, `size`, `phrase`, `f`: phrases that occur `least` times, and with size 0 the number of words of a language.

    Every occurrence of a phrase is the beginning of one window, so its count
    is the sum over the windows it begins, which ROLLUP gives for all lengths.
    """
    names = [f"w{i + 1}" for i in range(words)]
    distinct = windows.groupBy("lang", *names).agg(F.sum("n").alias("n"))
    level = F.lit(words) - F.bit_count(F.grouping_id())
    rolled = (distinct.rollup("lang", *names).agg(F.sum("n").alias("f"), level.cast("int").alias("size"))
              .where(F.col("size") >= 0))
    # a window that is shorter than the prefix is padding there, not a phrase
    full = F.col("size") == sum(F.col(name).isNotNull().cast("int") for name in names)
    return (rolled.where((F.col("size") == 0) | (full & (F.col("f") >= least)))
            .select("lang", "size", F.concat_ws(" ", *names).alias("phrase"), "f"))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", *, words: int = WORDS, least: int = LEAST,
                 top: int = TOP, percent: int = PERCENT, scale: int = SCALE, buckets: int = BUCKETS) -> DataFrame:
    """`lang`, `rank`, `phrase`, `a`, `l`, `r`, `n`, `score`: the first `top` phrases of every language.

    Texts are lower-cased in A-Z and split at `[.,;:!?\\x0A-\\x0D]` into pieces and
    those into words `[^\\x20\\x09]+`. A phrase has 2 to `words` words of one piece
    and occurs `a` times, at least `least`. Of its cuts in two, that with the
    lowest score counts: floor(`scale` * a * n / (l * r)), with the counts `l` and
    `r` of the two parts and the `n` words of the language; equal scores go to the
    shorter first part. A phrase within a longer one that has at least `percent`
    percent of its occurrences is dropped. Ranks are by score, then `a`, both
    descending, then phrase in byte order.

    All texts are counted whole, in slices, so very long ones need no more memory
    than short ones. What is counted beforehand, by hash, only shortens windows
    where no phrase can be frequent; `buckets` changes the work and not the
    result: the more words a bucket gets, the fewer windows are shortened. Null
    and empty texts have no words, a null language is `und`, repeated rows count
    each. An empty table gives an empty table. Other columns are not read.
    """
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text).alias("text"))
    pairs = frequent(texts, None, words, least, buckets)
    longer = frequent(texts, pairs, words, least, buckets)
    counts = materialize(phrase_counts(window_counts(texts, pairs, longer, words, buckets), least, words), "phrases")
    # one language may have nearly all phrases, so its total is listed once per salt
    totals = counts.where("size = 0").select("lang", F.col("f").alias("n"), F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("salt"))
    phrases = counts.where("size >= 1").select("lang", "size", "phrase", "f")
    parts = F.split("phrase", " ")
    candidates = phrases.where("size >= 2").select("lang", "size", "phrase", F.col("f").alias("a"), parts.alias("words"),
                                                   F.pmod(F.hash("phrase"), F.lit(_SALTS)).alias("salt"))

    first = phrases.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    rest = phrases.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    cut = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).withColumns({
        "first": F.array_join(F.slice("words", F.lit(1), F.col("k")), " "),
        "rest": F.array_join(F.slice("words", F.col("k") + 1, F.col("size") - F.col("k")), " ")})
    # counts have at most 17 digits, so the longest product has 38
    wide = lambda name: f"CAST({name} AS DECIMAL(17, 0))"
    score = F.expr(f"CAST({scale} AS DECIMAL(4, 0)) * {wide('a')} * {wide('n')} div ({wide('l')} * {wide('r')})")
    scored = (cut.join(first, ["lang", "first"]).join(rest, ["lang", "rest"]).join(totals, ["lang", "salt"]).withColumn("score", score)
              .groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")))

    spans = F.expr("flatten(transform(sequence(2, size - 1), m -> transform(sequence(1, size - m + 1), "
                   "i -> array_join(slice(words, i, m), ' '))))")
    inside = (candidates.where("size >= 3").select("lang", F.explode(F.array_distinct(spans)).alias("phrase"), F.col("a").alias("longer"))
              .groupBy("lang", "phrase").agg(F.max("longer").alias("longer")))
    stays = F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * percent)
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    return (scored.join(inside, ["lang", "phrase"], "left").where(stays)
            .select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
