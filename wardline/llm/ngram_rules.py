"""Quality rules: simple counts of a text, then the likelihood ratio of its hashed n-grams."""

from __future__ import annotations

import string
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from wardline.llm.common import lines, slices, utf8

BUCKETS = 1 << 16
#: Pseudo-counts that every bucket has in either distribution, on the target's scale.
PRIOR = 5.0
#: Mean log ratio per n-gram from which a text is kept.
THRESHOLD = -0.25
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
_SPACE = " \t\n\v\f\r"
_SYMBOLS = "#*$%&|<>"
_CHARS = 1_000_000


def text_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words; zeros for a null or empty text."""
    if not text:
        return 0, 0, 0, 0, 0
    numbers: dict[bytes, int] = {}
    ids = [np.fromiter((numbers.setdefault(word, len(numbers)) for word in utf8(part).split()), np.int64) for part in slices(text)]
    chars = len(text) - sum(map(text.count, _SPACE))
    seen, copies = set(), 0
    for line in lines(text):
        if line.strip(_SPACE):
            copies += line in seen
            seen.add(line)
    return sum(map(len, ids)), chars, sum(map(text.count, _SYMBOLS)), copies, _repeat_words(np.concatenate(ids), len(numbers))


def _repeat_words(ids: np.ndarray, distinct: int) -> int:
    if len(ids) < 4:
        return 0
    pairs = np.unique(ids[:-1] * distinct + ids[1:], return_inverse=True)[1]
    windows = pairs[:-1] * distinct + ids[2:]
    _, where, times = np.unique(windows, return_inverse=True, return_counts=True)
    repeated = times[where] > 1
    covered = np.zeros(len(ids), bool)
    for step in range(3):
        covered[step:step + len(repeated)] |= repeated
    return int(covered.sum())


def _grams(texts: list[str | None], buckets: int, most: int = _CHARS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bucket and text number of all unigrams and bigrams of the texts, about `most` characters at a time.

    A word gives what is left of it without the punctuation at its ends, and
    that punctuation as a token behind it.
    """
    found: list[bytes] = []
    sizes: list[tuple[int, int]] = []
    before: list[int] = []
    chars = 0
    for number, text in enumerate(texts):
        last = None
        for part in slices(text, most):
            own = utf8(part).split()  # the words of the counts: no other sign of Unicode parts them
            if last is not None:  # a later slice: the word ahead of it makes pairs and is counted no second time
                before.append(len(found))
                own.insert(0, last)
            found += own
            sizes.append((number, len(own)))
            last = own[-1] if own else None
            chars += len(part)
            if chars >= most:  # so always behind a slice that its text goes on after
                yield _hashed(found, sizes, before, buckets)
                found, sizes, before, chars = [], [], [], 0
    yield _hashed(found, sizes, before, buckets)


def _hashed(found: list[bytes], sizes: list[tuple[int, int]], before: list[int], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Grams of runs of words, given as text number and length; of the words at `before` the last token is only paired."""
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    codes, vocabulary = pd.factorize(np.array(found, object))
    tokens = np.zeros((len(vocabulary), 2), np.uint64)
    vocabulary = [word.decode() for word in vocabulary.tolist()]
    cores = [word.strip(string.punctuation) for word in vocabulary]
    tails = [word[len(word.rstrip(string.punctuation)):] for word in vocabulary]
    for column, parts in enumerate((cores, tails)):
        hashed = pd.util.hash_array(np.array(parts, object), categorize=False) | np.uint64(1)
        tokens[:, column] = np.where(np.array([bool(p) for p in parts]), hashed, 0)
    line = tokens[codes]
    line[before, 0] = np.where(line[before, 1] > 0, 0, line[before, 0])
    counts = np.ones(line.shape, bool)
    counts[before] = False
    owner = np.repeat([number for number, _ in sizes], [2 * size for _, size in sizes])
    line, counts, owner = line[line > 0], counts[line > 0], owner[line.ravel() > 0]
    same = owner[1:] == owner[:-1]
    mixed = (line[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ line[1:]) * np.uint64(0xBF58476D1CE4E5B9)
    pairs = (mixed ^ mixed >> np.uint64(31))[same]
    grams = np.concatenate([line[counts], pairs]) >> np.uint64(7)
    return (grams % np.uint64(buckets)).astype(np.int64), np.concatenate([owner[counts], owner[1:][same]])


def log_ratios(docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text", buckets: int = BUCKETS,
               prior: float = PRIOR) -> np.ndarray:
    """Log ratio of each bucket's probability in the trusted texts to that in all texts.

    `trusted` holds the keys of the trusted texts. Counted are all n-grams of
    all documents: a task adds up its own and sends on one row per bucket, and
    `buckets` rows reach the driver. Without trusted texts all ratios are 0.
    """
    marks = trusted.select(F.col(key).alias("k")).where(F.col("k").isNotNull()).distinct().withColumn("own", F.lit(True))
    # the keys grow with the corpus: the same plan, a merge join that AQE may split, at every size
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).join(marks.hint("merge"), "k", "left")
    schema = "bucket long, n long, n_trusted long"

    def counted(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        every, own = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            flags = np.array([flag is True for flag in batch["own"]], bool)
            for grams, owner in _grams(batch["t"].tolist(), buckets):
                every += np.bincount(grams, minlength=buckets)
                own += np.bincount(grams[flags[owner]], minlength=buckets)
        at = every.nonzero()[0]
        yield pd.DataFrame({"bucket": at, "n": every[at], "n_trusted": own[at]})

    sums = (rows.select("t", "own").mapInPandas(counted, schema).groupBy("bucket")
            .agg(F.sum("n").alias("n"), F.sum("n_trusted").alias("n_trusted")).toPandas())
    every, own = np.zeros(buckets), np.zeros(buckets)
    every[sums["bucket"]], own[sums["bucket"]] = sums["n"], sums["n_trusted"]
    expected = every * (own.sum() / max(every.sum(), 1))
    return np.log((own + prior) / (expected + prior)) if own.any() else np.zeros(buckets)


def judge(docs: DataFrame, ratios: np.ndarray, key: str = "doc_id", text: str = "text", *, threshold: float = THRESHOLD,
          min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT) -> DataFrame:
    """The counts of every text, its `score`, `base_failed` and `kept`.

    The score is the sum of its n-grams' log ratios over their number, 0
    without any. A text is kept when it passes the base rules and its score is
    at least `threshold`: no draw is involved, so reruns agree. Null and empty
    texts have no words and fail. Repeated rows and null keys are judged each;
    an empty table gives no rows. Very long texts are judged whole, but are
    taken apart a slice at a time. Other columns of `docs` are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ratios.astype(np.float64))
    kind = docs.schema[key].dataType.simpleString()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def judged(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = shared.value
        for batch in batches:
            texts = batch["t"].tolist()
            count, total = np.zeros(len(texts), np.int64), np.zeros(len(texts))
            for grams, owner in _grams(texts, len(table)):
                count += np.bincount(owner, minlength=len(texts))
                total += np.bincount(owner, table[grams], minlength=len(texts))
            score = total / np.maximum(count, 1)
            out = pd.DataFrame([text_counts(t) for t in texts], columns=names)
            failed = (out["n_words"] < min_words) | (100 * out["n_repeat_words"] > max_repeat_percent * out["n_words"])
            yield out.assign(key=batch["key"], score=score, base_failed=failed, kept=~failed & (score >= threshold))

    schema = "key string, " + ", ".join(f"{name} long" for name in names) + ", score double, base_failed boolean, kept boolean"
    found = docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("t")).mapInPandas(judged, schema)
    return found.select(F.col("key").cast(kind).alias(key), *names, "base_failed", "kept", "score")
