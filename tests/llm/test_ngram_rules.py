import random
import re

import numpy as np
import pytest

from tests_llm_helpers import prose
from wardline.llm import common, ngram_rules as rules

WORD = re.compile("[^\x20\x09-\x0D]+")


def plain(text):
    found = WORD.findall(text or "")
    windows = [tuple(found[i:i + 3]) for i in range(len(found) - 2)]
    covered = {at + step for at, w in enumerate(windows) if windows.count(w) > 1 for step in range(3)}
    lines, copies = [], 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            copies += line in lines
            lines.append(line)
    return len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text or "")), copies, len(covered)


@pytest.mark.parametrize("text", [None, "", " \n", "a b c", "a b c a b c", "x x x x", "é b c d|#\n\né b", "a\r\nb\r\na\r\n",
                                  "one two\none two\n one two\n", "a b " * 40, prose(1, 200), prose(2, 30) + " " + prose(2, 30), "\x1c \x85 q"])
def test_counts_equal_the_plain_definition(text):
    assert rules.text_counts(text) == plain(text)


@pytest.mark.parametrize("most", [1, 7, 50])
def test_slices_change_nothing(monkeypatch, most):
    rng = random.Random(most)
    for _ in range(40):
        text = "".join(rng.choice(["a", "bc", "é", " ", "  ", "\n", "a b c ", "x!! ", "?! ", "\x85", "\r\n"]) for _ in range(rng.randint(0, 80)))
        texts = [text, None, text[::-1], ""]
        whole = sorted(zip(*map(np.ndarray.tolist, [np.concatenate(a) for a in zip(*rules._grams(texts, 999, 10_000))])))
        parts = sorted(zip(*map(np.ndarray.tolist, [np.concatenate(a) for a in zip(*rules._grams(texts, 999, most))])))
        assert whole == parts
        with monkeypatch.context() as patched:
            patched.setattr(rules, "slices", lambda t: common.slices(t, most))
            assert rules.text_counts(text) == plain(text)


def corpus():
    rows = [(k, prose(k, 70)) for k in range(60)]
    rows += [(100 + k, " ".join(w.upper() + "!!" for w in prose(k, 70).split())) for k in range(20)]
    return [*rows, (200, "short"), (201, None), (202, ""), (203, "same again " * 60), (None, prose(5, 80)), (3, prose(3, 70))]


def test_rules_and_ratio(spark, documents):
    docs = documents(corpus(), extra=True)
    ratios = rules.log_ratios(docs, spark.createDataFrame([(k,) for k in range(40)] + [(None,)], "doc_id long"))
    found = rules.judge(docs, ratios).collect()
    assert len(found) == len(corpus())
    by_key = {r["doc_id"]: r for r in found}
    assert all(by_key[k]["kept"] for k in range(60)) and by_key[None]["kept"]
    assert not any(by_key[k]["kept"] for k in [*range(100, 120), 200, 201, 202, 203])
    assert {k for k, r in by_key.items() if r["base_failed"]} == {200, 201, 202, 203}


def test_counts_of_all_tasks_are_added(spark, documents):
    rows = corpus()
    trusted = spark.createDataFrame([(k,) for k in range(40)], "doc_id long")
    ratios = [rules.log_ratios(documents(rows).repartition(n), trusted, buckets=64) for n in (1, 7)]
    assert np.allclose(*ratios)
    texts = [t for _, t in rows]
    [(grams, owner)] = rules._grams(texts, 64)
    every = np.bincount(grams, minlength=64)
    own = np.bincount(grams[np.isin(owner, [i for i, (k, _) in enumerate(rows) if k is not None and k < 40])], minlength=64)
    assert np.allclose(ratios[0], np.log((own + 5) / (every * own.sum() / every.sum() + 5)))


def test_without_trusted_texts_the_base_rules_decide(spark, documents):
    ratios = rules.log_ratios(documents(corpus()), spark.createDataFrame([], "doc_id long"))
    assert not ratios.any()
    assert all(r["kept"] != r["base_failed"] for r in rules.judge(documents(corpus()), ratios).collect())
    assert rules.judge(documents([]), ratios).count() == 0


def test_words_are_parted_by_the_same_signs_as_in_the_counts():
    whole = ["a\xa0b\x85c\x1cd\u3000e", "\u2028"]
    for word in whole:
        assert rules.text_counts(word)[0] == 1
        [(grams, owner)] = rules._grams([word], 1 << 20)
        assert len(grams) == len(owner) == 1
    [(grams, _)] = rules._grams(["a\tb\x0bc\r\nd"], 1 << 20)
    assert len(grams) == 4 + 3
