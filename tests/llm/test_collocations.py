import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests_llm_helpers import prose
from wardline.llm import collocations as C


def plain(rows, words=5, least=100, top=2000, percent=100, scale=1000):
    counts, totals = Counter(), Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            found = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(found)
            for size in range(1, words + 1):
                counts.update((lang, *found[i:i + size]) for i in range(len(found) - size + 1))
    candidates = {p: f for p, f in counts.items() if len(p) > 2 and f >= least}
    inside = {}
    for (lang, *own), f in candidates.items():
        for size in range(2, len(own)):
            for i in range(len(own) - size + 1):
                part = (lang, *own[i:i + size])
                inside[part] = max(inside.get(part, 0), f)
    out = []
    for phrase, a in candidates.items():
        if phrase in inside and 100 * inside[phrase] >= percent * a:
            continue
        lang, *own = phrase
        n = totals[lang]
        cuts = [(scale * a * n // (counts[(lang, *own[:k])] * counts[(lang, *own[k:])]), k) for k in range(1, len(own))]
        score, k = min(cuts)
        out.append((lang, score, a, " ".join(own), counts[(lang, *own[:k])], counts[(lang, *own[k:])], n))
    answer = []
    for lang in {row[0] for row in out}:
        ranked = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[1], -r[2], r[3].encode()))[:top]
        answer += [(lang, rank, r[3], r[2], r[4], r[5], r[6], r[1]) for rank, r in enumerate(ranked, 1)]
    return sorted(answer)


def corpus(seed=1, count=120):
    rng = random.Random(seed)
    vocabulary = [prose(i, 1) for i in range(60)] + ["É", "日本", "Ab\x1cc", "\x85", "x\xa0y", "\x00"]
    phrases = [[rng.choice(vocabulary) for _ in range(rng.randint(2, 7))] for _ in range(12)] + [["a", "a", "a", "a"]]
    rows = []
    for _ in range(count):
        out = []
        for _ in range(rng.randint(0, 60)):
            out += rng.choice(phrases) if rng.random() < 0.4 else [rng.choice(vocabulary)]
            out.append(rng.choice(["", "", "", "", "", ".", ",", "\n", "\r\n", "\t", "!", ";"]))
        text = " ".join(out)
        rows.append((text.upper() if rng.random() < 0.2 and text.isascii() else text, rng.choice(["en", "en", "de", None, "und"])))
    return rows + [(None, "en"), ("", None), ("...", "xx"), (" ", "de"), rows[0], rows[0]]


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    for name in ("n", "w1", "w2", "part", "size", "phrase", "f", "score"):
        df = df.withColumn(name, F.lit("x"))
    found = C.collocations(df, **options)
    assert dict(found.dtypes) == {"lang": "string", "phrase": "string", **dict.fromkeys(("rank", "a", "l", "r", "n", "score"), "bigint")}
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("options", [{"least": 5}, {"least": 5, "buckets": 7}, {"least": 9, "buckets": 300, "top": 4},
                                     {"least": 4, "words": 3, "percent": 60, "scale": 9}, {"least": 300}])
def test_phrases_equal_brute_force(spark, options):
    rows = corpus()
    known = {k: v for k, v in options.items() if k != "buckets"}
    assert run(spark, rows, **options) == plain(rows, **known)
    assert options["least"] == 300 or len(plain(rows, **known)) > 10


def test_windows_may_be_sent_on_at_any_time(spark):
    texts = spark.createDataFrame([(lang or "und", text) for text, lang in corpus(3)], "lang string, text string").repartition(40)
    everything = np.full(C._PART // 8, 255, np.uint8)

    def counted(held):
        found = Counter()
        rows = C.window_counts(texts, everything, everything, 5, C._PART, held).collect()
        for row in rows:
            found[tuple(row[:-1])] += row["n"]
        return len(rows), found

    (many, one), (few, other) = counted(3), counted(1000)
    assert one == other and many >= few


@pytest.mark.parametrize("size", [1, 2, 5, 17, 400])
def test_slices_change_nothing(monkeypatch, size):
    texts = [text for text, _ in corpus(2, 30)]
    whole = spelled(texts)
    monkeypatch.setattr(C, "SLICE", size)
    assert spelled(texts) == whole
    assert spelled(["one two. three", None, "four"]) == Counter(
        {("one", "two", None, None, None): 1, ("two", None, None, None, None): 1, ("three", None, None, None, None): 1,
         ("four", None, None, None, None): 1})


def spelled(texts):
    found = Counter()
    for vocabulary, grid in C._windows(texts, 5):
        words = np.array([*(w.decode() for w in vocabulary), None], object)
        found.update(map(tuple, words[grid].tolist()))
    return found


@pytest.mark.parametrize("buckets", [50, 1 << 20])
def test_what_is_frequent_is_never_cut_off(spark, buckets):
    rows = corpus()
    texts = spark.createDataFrame([(lang or "und", text) for text, lang in rows], "lang string, text string").repartition(4)
    pairs = C.frequent(texts, None, 5, 6, buckets)
    longer = C.frequent(texts, pairs, 5, 6, buckets)
    windows = C.window_counts(texts, pairs, longer, 5, buckets).collect()
    every, kept = Counter(), Counter()
    for lang in ("en", "de", "und", "xx"):
        for window, n in spelled([t for t, own in rows if (own or "und") == lang]).items():
            for size in range(1, 6):
                if window[size - 1] is not None:
                    every[lang, window[:size]] += n
    for row in windows:
        for size in range(1, 6):
            if row[size] is not None:
                kept[row["lang"], tuple(row[1:size + 1])] += row["n"]
    assert all(kept[phrase] == n for phrase, n in every.items() if n >= 6)
    assert all(every[phrase] >= n for phrase, n in kept.items())
    assert sum(row["n"] for row in windows) == sum(n for (_, phrase), n in every.items() if len(phrase) == 1)
    if buckets > 50:  # hardly any collisions: little else is left
        assert len(kept) < 1.05 * sum(n >= 6 for n in every.values())


def test_products_beyond_64_bits(spark):
    phrases = [("en", 0, "", 9 * 10 ** 12), ("en", 1, "x", 10 ** 12), ("en", 1, "y", 10 ** 12), ("en", 2, "x y", 10 ** 12 - 1)]
    assert 1000 * (10 ** 12 - 1) * 9 * 10 ** 12 > 2 ** 63
    df = spark.createDataFrame(phrases, "lang string, size int, phrase string, f long")
    original, C.phrase_counts = C.phrase_counts, lambda *_: df
    try:
        found = C.collocations(spark.createDataFrame([("x", "en")], "text string, lang string")).collect()
    finally:
        C.phrase_counts = original
    assert [tuple(r) for r in found] == [("en", 1, "x y", 10 ** 12 - 1, 10 ** 12, 10 ** 12, 9 * 10 ** 12,
                                          1000 * (10 ** 12 - 1) * 9 * 10 ** 12 // 10 ** 24)]


def test_a_very_long_text_and_an_empty_table(spark):
    text = ("red green blue, " * 40 + prose(5, 300) + "\n") * 400 + "w" * 5_000_000
    assert run(spark, [(text, "en")], least=300) == plain([(text, "en")], least=300)
    assert run(spark, []) == []
    assert run(spark, [(None, None)]) == []
