import hashlib
import random

import numpy as np
import pytest

from tests_llm_helpers import prose
from wardline.llm import suffix


def plain(rows, length=100):
    """(id, text) in order -> per row (n_bytes, n_removed, n_spans, sha256), from a set of all strings seen."""
    seen, out = set(), {}
    for key, text in rows:
        data = (text or "").encode()
        gone = [False] * len(data)
        for at in range(len(data) - length + 1):
            window = data[at:at + length]
            if window in seen:
                gone[at:at + length] = [True] * length
            seen.add(window)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out[key] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def corpus():
    rng = random.Random(11)
    shared = [prose(i, 40) for i in range(4)]
    rows = []
    for key in range(40):
        parts = [prose(100 + key, rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            passage = rng.choice(shared)
            cut = rng.randint(0, 60)
            parts.append(passage[cut:] if rng.random() < 0.5 else passage[:len(passage) - cut])
            parts.append(prose(rng.randint(0, 10 ** 6), rng.randint(0, 8)))
        rows.append((key, " ".join(parts)))
    rows += [(50, "a" * 350), (51, "ab" * 300), (52, rows[3][1]), (53, "é" * 120 + prose(7, 50)), (54, "x" * 99), (55, None), (56, "")]
    return rows


@pytest.mark.parametrize("options", [{}, {"wide": 1}])
def test_results_equal_the_plain_definition(documents, options, monkeypatch):
    rows = corpus()
    found = suffix.remove_repeats(documents(rows, extra=True), **options).collect()
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in found}
    assert got == plain(rows)


def test_frequent_kmers_and_long_texts_take_their_paths(documents, monkeypatch):
    rows = corpus()
    keyed, _ = suffix._keyed(documents(rows), "doc_id", "text")
    every = {r["kmer"] for r in suffix._sampled(keyed, 100, 32, frozenset()).where("spans IS NULL").collect()}
    monkeypatch.setattr(suffix, "_frequent", lambda *_: frozenset(every))
    monkeypatch.setattr(suffix, "_CHUNK", 700)  # parts of documents, with overlaps
    found = suffix.remove_repeats(documents(rows)).collect()
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in found}
    assert got == plain(rows)


def test_induction_equals_sorting_all_suffixes():
    rng = np.random.default_rng(2)
    texts = [bytes(rng.integers(97, 99, rng.integers(14, 40)).astype(np.uint8)) for _ in range(60)]
    length, at = 8, 5
    order = sorted(range(60), key=lambda i: (texts[i][at:], i))
    counts = np.array([min(at + 1, len(texts[i]) - length + 1) for i in order])
    row, start = suffix.induced_repeats([texts[i][at:] for i in order], [texts[i][:at] for i in order], np.zeros(60, int),
                                        np.array(order), np.zeros(60, int), counts, length)
    got = {(order[r], int(s)) for r, s in zip(row, start)}
    # equal windows count as one only where they begin equally far from the sampled place
    expected, seen = set(), set()
    for i in range(60):
        for s in range(min(at + 1, len(texts[i]) - length + 1)):
            window = (s, texts[i][s:s + length])
            if window in seen:
                expected.add((i, s))
            seen.add(window)
    unaligned = set()
    first = {}
    for i in range(60):
        for s in range(min(at + 1, len(texts[i]) - length + 1)):
            if (i, s) not in unaligned and texts[i][s:s + length] in first:
                unaligned.add((i, s))
            first.setdefault(texts[i][s:s + length], (i, s))
    assert expected <= got | expected and got >= expected and got <= unaligned | expected


def test_repeated_and_null_keys(documents):
    text, other = prose(1, 60), prose(2, 60)
    rows = [(4, text), (4, text), (4, other), (None, text), (2, other)]
    found = suffix.remove_repeats(documents(rows)).collect()
    got = sorted(((r["doc_id"], r["n_removed"] > 0, r["n_bytes"]) for r in found), key=str)
    # (4, text) twice is one document; (4, other) repeats document 2, and the one without a key comes last
    assert got == sorted([(4, False, len(text)), (4, False, len(text)), (4, True, len(other)), (None, True, len(text)),
                          (2, False, len(other))], key=str)


def test_an_empty_table(documents):
    assert suffix.remove_repeats(documents([])).count() == 0
