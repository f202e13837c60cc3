import math
import random
import zlib

import numpy as np
import pytest

from tests_llm_helpers import prose
from wardline.llm import common, gam


def sample(key):
    text = prose(key, 20 + key % 70)
    return (text, 1) if key % 3 else (" ".join(w.upper() + "!!" for w in text.split()), 0)


def test_held_out_documents_are_told_apart(spark, documents):
    data = [(key, *sample(key)) for key in range(400)]
    docs = documents([(k, t) for k, t, _ in data], extra=True)
    model = gam.fit(docs, spark.createDataFrame([(k, y) for k, _, y in data], "doc_id long, quality int"))
    found = {r["doc_id"]: r for r in gam.score(docs, model).collect()}
    kept_back = [k for k, *_ in data if zlib.crc32(str(k).encode()) % 4 == 2]
    assert np.mean([found[k]["predicted"] == data[k][2] for k in kept_back]) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in found.values())


def test_pairs_learn_what_single_features_cannot():
    rng = np.random.default_rng(3)
    values = np.zeros((3000, len(gam.FEATURES)))
    values[:, :3] = rng.random((3000, 3))
    labels = ((values[:, 0] > 0.5) != (values[:, 1] > 0.5)).astype(float)
    model = gam.train(values[:2000], labels[:2000])
    assert (0, 1) in model.pairs
    assert ((model.scores(values[2000:]) > 0.5) == labels[2000:]).mean() > 0.95
    alone = gam.train(values[:2000], labels[:2000], pairs=0)
    assert ((alone.scores(values[2000:]) > 0.5) == labels[2000:]).mean() < 0.7


def test_scores_are_the_sums_of_the_tables():
    rng = np.random.default_rng(4)
    values = rng.random((500, len(gam.FEATURES)))
    model = gam.train(values, (values[:, 2] > 0.4).astype(float))
    bins = model.bins(values)
    for row in range(20):
        total = model.start + sum(t[bins[row, i]] for i, t in enumerate(model.tables))
        total += sum(t[bins[row, a], bins[row, b]] for (a, b), t in zip(model.pairs, model.pair_tables))
        assert abs(1 / (1 + np.exp(-total)) - model.scores(values)[row]) < 1e-9


def test_letters_and_capitals_equal_the_plain_definition_at_every_length():
    rng = random.Random(6)
    scripts = ["abcXYZ .,", "éÀß — … “”", "жЖщ ΩωΔ", "日本語。、「」", "😀🎉 ⅣⓐⒶ٣ǅ"]
    for length in range(1, 201):
        for script in (*scripts, "".join(scripts)):
            text = "".join(rng.choice(script) for _ in range(length))
            assert gam._letters(text) == (sum(map(str.isalpha, text)), sum(map(str.isupper, text)))
    short, long = "ABC — — … ", "ABC — — … " * 20
    place = gam.FEATURES.index("upper_share")
    assert gam.features(short)[place] == gam.features(long)[place] == 1.0


def plain_features(text):
    words = text.split()
    lines = [line for line in text.split("\n") if line.strip()]
    signs = lambda some: sum(text.count(sign) for sign in some)
    return [math.log1p(len(words)), sum(map(len, words)) / len(words), signs("#*$%&|<>") / len(words),
            sum(map(str.isupper, text)) / max(sum(map(str.isalpha, text)), 1), 1 - len(set(lines)) / max(len(lines), 1),
            len(set(words)) / len(words), sum(a == b for a, b in zip(words, words[1:])) / len(words), signs("!") / len(words),
            signs("|") / len(words), signs("0123456789") / len(text), signs(".,;:!?") / len(words), len(words) / max(len(lines), 1),
            sum(len(w) <= 2 for w in words) / len(words), sum(len(w) >= 12 for w in words) / len(words),
            max(map(words.count, words)) / len(words), signs(".?") / max(len(lines), 1)]


@pytest.mark.parametrize("most", [1, 9, 400_000])
def test_features_equal_the_plain_definition(monkeypatch, most):
    monkeypatch.setattr(gam, "slices", lambda text: common.slices(text, most))
    monkeypatch.setattr(gam, "SLICE", most)
    rng = random.Random(most)
    parts = ["a", "Bc ", "a a ", "\n", " \n", "Über ", "漢字。", "\u3000", "\x1c", "12|", "! ", "extraordinarily ", "x. ", "?", "\t"]
    for _ in range(60):
        text = "q" + "".join(rng.choice(parts) for _ in range(rng.randint(0, 60)))
        assert gam.features(text) == pytest.approx(plain_features(text), abs=1e-12)


def test_nulls_empty_texts_and_no_labels(spark, documents):
    assert gam.features(None) == gam.features("") == gam.features(" \n") == [0.0] * len(gam.FEATURES)
    docs = documents([(1, None), (None, ""), (2, "a word " * 30_000), (2, "x")])
    model = gam.fit(docs, spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int"))
    assert {r["score"] for r in gam.score(docs, model).collect()} == {0.5}
    assert gam.score(documents([]), model).count() == 0
