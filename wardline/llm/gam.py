"""Quality classifier: an additive model of binned text features and pairs of them, fitted by cyclic boosting."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cache
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from wardline.llm.common import SLICE, bounded_sample, held_out, known_labels, lines, slices

FEATURES = ("log_words", "word_length", "symbol_rate", "upper_share", "copied_lines", "distinct_share", "same_as_last",
            "exclamation_rate", "pipe_rate", "digit_share", "mark_rate", "words_per_line", "short_words", "long_words",
            "top_word_share", "end_marks")
#: Most labelled rows that are learnt from.
ROWS = 12_000
BINS = 32
ROUNDS = 80
PAIR_ROUNDS = 30
PAIRS = 8
STEP = 0.15
THRESHOLD = 0.7
_SYMBOLS = "#*$%&|<>"
_MARKS = ".,;:!?"


def features(text: str | None) -> list[float]:
    """Numbers that describe a whole text; all zero without words. Only the text itself is looked at, a slice at a time."""
    counts: dict[str, int] = {}
    count = size = short = long = same = 0
    last = None
    for part in slices(text):
        found = part.split()
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        count, size = count + len(found), size + int(lengths.sum())
        short, long = short + int((lengths <= 2).sum()), long + int((lengths >= 12).sum())
        for word in found:
            counts[word] = counts.get(word, 0) + 1
            same += word == last
            last = word
    if not count:
        return [0.0] * len(FEATURES)
    full, different = 0, set()
    for line in lines(text):
        if not line.isspace():
            full += 1
            different.add(line)
    letters, upper = _letters(text)
    digits = sum(map(text.count, "0123456789"))
    return [
        float(np.log1p(count)), size / count, sum(map(text.count, _SYMBOLS)) / count, upper / max(letters, 1),
        1 - len(different) / max(full, 1), len(counts) / count, same / count, text.count("!") / count,
        text.count("|") / count, digits / len(text), sum(map(text.count, _MARKS)) / count, count / max(full, 1),
        short / count, long / count, max(counts.values()) / count,
        sum(text.count(mark) for mark in ".?") / max(full, 1),
    ]


@cache
def _classes() -> np.ndarray:
    """For every code point 1 if it is a letter, and 2 more if it is upper-case; made once per worker."""
    signs = list(map(chr, range(0x110000)))
    return np.array(list(map(str.isalpha, signs)), np.uint8) + 2 * np.array(list(map(str.isupper, signs)), np.uint8)


def _letters(text: str) -> tuple[int, int]:
    """Letters, and upper-case signs, of a text of any length and script."""
    found = np.zeros(4, np.int64)
    for start in range(0, len(text), SLICE):
        signs = np.frombuffer(text[start:start + SLICE].encode("utf-32-le", "replace"), np.uint32)
        found += np.bincount(_classes()[signs], minlength=4)
    return int(found[1] + found[3]), int(found[2] + found[3])


def feature_table(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key` as text, and `x`, the features of every row."""

    def mapped(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"key": batch["key"], "x": [features(t) for t in batch["t"]]})

    return docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("t")).mapInPandas(
        mapped, "key string, x array<double>")


@dataclass
class Model:
    """Log odds: `start` plus one entry of every table, chosen by the bins of its features."""

    start: float
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def bins(self, values: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(cuts, values[:, i], "right") for i, cuts in enumerate(self.cuts)], axis=1)

    def scores(self, values: np.ndarray) -> np.ndarray:
        if not len(values):
            return np.empty(0)
        bins = self.bins(values)
        total = np.full(len(values), self.start)
        for i, table in enumerate(self.tables):
            total += table[bins[:, i]]
        for (a, b), table in zip(self.pairs, self.pair_tables):
            total += table[bins[:, a], bins[:, b]]
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def _gain(gradient: np.ndarray, weight: np.ndarray) -> np.ndarray:
    return gradient * gradient / (weight + 1.0)


def _best_cut(gradient: np.ndarray, weight: np.ndarray) -> tuple[float, int]:
    """Gain of the best cut of a histogram, and the number of bins to its left; 0 bins if none gains."""
    left_g, left_w = np.cumsum(gradient)[:-1], np.cumsum(weight)[:-1]
    if not len(left_g):
        return 0.0, 0
    gains = (_gain(left_g, left_w) + _gain(gradient.sum() - left_g, weight.sum() - left_w)
             - _gain(gradient.sum(), weight.sum()))
    best = int(gains.argmax())
    return (float(gains[best]), best + 1) if gains[best] > 1e-9 else (0.0, 0)


def _tree(gradient: np.ndarray, weight: np.ndarray, depth: int) -> np.ndarray:
    """A tree of at most `depth` cuts in a row over one feature's bins, as the value of each bin."""
    _, cut = _best_cut(gradient, weight) if depth else (0.0, 0)
    if not cut:
        return np.full(len(gradient), gradient.sum() / (weight.sum() + 1.0))
    return np.concatenate([_tree(gradient[:cut], weight[:cut], depth - 1), _tree(gradient[cut:], weight[cut:], depth - 1)])


def _pair_tree(gradient: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """A tree over two features: one cut of the first or second, then one of the other on either side; and its gain."""
    best, gain = None, -1.0
    for turned in (False, True):
        g, w = (gradient.T, weight.T) if turned else (gradient, weight)
        above, heavy = np.cumsum(g, axis=0), np.cumsum(w, axis=0)
        # a feature that shows nothing by itself may still be the one to cut first, so a cut is judged by both
        for cut in sorted({max(1, g.shape[0] * part // 8) for part in range(1, 8)} & set(range(1, g.shape[0]))):
            sides = ((above[cut - 1], heavy[cut - 1]), (above[-1] - above[cut - 1], heavy[-1] - heavy[cut - 1]))
            leaves = [_tree(side_g, side_w, 1) for side_g, side_w in sides]
            total = sum(float((leaf * side_g).sum()) for leaf, (side_g, _) in zip(leaves, sides))
            if total > gain:
                value = np.concatenate([np.tile(leaves[0], (cut, 1)), np.tile(leaves[1], (g.shape[0] - cut, 1))])
                best, gain = (value.T if turned else value), total
    if best is None:
        return np.zeros(gradient.shape), 0.0
    return best, gain


def train(values: np.ndarray, labels: np.ndarray, bins: int = BINS, rounds: int = ROUNDS, pairs: int = PAIRS,
          pair_rounds: int = PAIR_ROUNDS, step: float = STEP) -> Model:
    """Boost every feature in turn, a shallow tree a turn, then in the same way the pairs that gain most.

    Bins are quantiles of the training rows. Without rows, or with labels of
    one kind, every score is the smoothed share of label 1.
    """
    values, labels = np.asarray(values, float).reshape(-1, len(FEATURES)), np.asarray(labels, float)
    share = (labels.sum() + 1) / (len(labels) + 2)
    cuts = [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) if len(column) else np.empty(0)
            for column in values.T]
    model = Model(float(np.log(share / (1 - share))), cuts, [np.zeros(len(c) + 1) for c in cuts])
    if not len(labels) or labels.min() == labels.max():
        return model
    at = model.bins(values)
    log_odds = np.full(len(labels), model.start)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        chance = 1 / (1 + np.exp(-log_odds))
        return labels - chance, chance * (1 - chance)

    for _ in range(rounds):
        for i, table in enumerate(model.tables):
            gradient, weight = slopes()
            change = step * _tree(np.bincount(at[:, i], gradient, len(table)), np.bincount(at[:, i], weight, len(table)), 2)
            table += change
            log_odds += change[at[:, i]]
    shapes = {(a, b): (len(model.tables[a]), len(model.tables[b])) for a, b in combinations(range(len(FEATURES)), 2)}

    def grid(pair: tuple[int, int], numbers: np.ndarray) -> np.ndarray:
        shape = shapes[pair]
        return np.bincount(at[:, pair[0]] * shape[1] + at[:, pair[1]], numbers, shape[0] * shape[1]).reshape(shape)

    gradient, weight = slopes()
    gains = {pair: _pair_tree(grid(pair, gradient), grid(pair, weight))[1] for pair in shapes}
    model.pairs = sorted(gains, key=lambda pair: (-gains[pair], pair))[:pairs]
    model.pair_tables = [np.zeros(shapes[pair]) for pair in model.pairs]
    for _ in range(pair_rounds):
        for pair, table in zip(model.pairs, model.pair_tables):
            gradient, weight = slopes()
            change = step * _pair_tree(grid(pair, gradient), grid(pair, weight))[0]
            table += change
            log_odds += change[at[:, pair[0]], at[:, pair[1]]]
    return model


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
        rows: int = ROWS) -> Model:
    """A model from at most `rows` labelled rows outside the held-out quarter, those with the least hashes of their keys."""
    chosen = bounded_sample(known_labels(labels, key, label), rows, "k")
    texts = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).join(F.broadcast(chosen), "k")
    found = feature_table(texts.select(F.struct("k", "y").alias("row"), "t")
                          .select(F.concat_ws(" ", "row.y", "row.k").alias("k"), "t"), "k", "t").toPandas().sort_values("key")
    values = np.array(found["x"].tolist()).reshape(-1, len(FEATURES))
    return train(values, found["key"].str.startswith("1").to_numpy(float))


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """`key`, `held_out`, `score`, `predicted` for every row; null and empty texts have the score of no words."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[key].dataType.simpleString()

    def mapped(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = np.array([features(t) for t in batch["t"]]).reshape(-1, len(FEATURES))
            found = shared.value.scores(values)
            yield pd.DataFrame({"key": batch["key"], "score": found, "predicted": (found >= threshold).astype(np.int32)})

    found = docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("t")).mapInPandas(
        mapped, "key string, score double, predicted int")
    named = F.col("key").cast(kind)
    return found.select(named.alias(key), held_out(named).alias("held_out"), "score", "predicted")
