import random

import numpy as np
import pytest
import xxhash
from tests_llm_helpers import prose
from wardline.llm import simhash


def plain(text):
    found = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).encode().split()
    if not found:
        return 0
    shingles = [b" ".join(found[i:i + 4]) for i in range(max(1, len(found) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [None, "", " \n\t", "One", "one two three", "Ünï ÀB c d E f", "a " * 500, prose(1, 300)])
def test_fingerprints_equal_the_plain_definition(text):
    assert simhash.fingerprint(text) == plain(text)


def test_every_close_pair_shares_a_lookup():
    masks = simhash.masks(4)
    rng = random.Random(3)
    for _ in range(500):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), 4):
            b ^= 1 << bit
        assert any(a & m == b & m for m in masks)
    with pytest.raises(ValueError):
        simhash.masks(4, 4)


@pytest.mark.parametrize("piece", [3, 1024])
def test_components_equal_brute_force(spark, piece):
    rng = random.Random(5)
    values = [rng.getrandbits(64) for _ in range(60)]
    for _ in range(140):  # chains of near values, many of them in one bucket
        value = rng.choice(values)
        for bit in rng.sample(range(64), rng.randint(1, 5)):
            value ^= 1 << bit
        values.append(value)
    values = sorted(set(values))
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    from wardline.llm.components import components
    links = simhash.near_links(spark.createDataFrame([(v,) for v in signed], "fp long"), piece=piece)
    labels = {row["node"]: row["label"] for row in components(links).collect()}
    root = {v: v for v in signed}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, a in enumerate(values):
        for j in range(i):
            if bin(a ^ values[j]).count("1") <= 4:
                x, y = find(signed[i]), find(signed[j])
                root[max(x, y)] = min(x, y)
    assert {v: labels.get(v, v) for v in signed} == {v: find(v) for v in signed}


def test_nulls_repeats_and_extra_columns(documents):
    text = prose(2, 200)
    rows = [(5, text), (3, text), (3, text), (9, prose(4, 200)), (None, text), (7, None), (2, ""), (None, prose(6, 90))]
    docs = documents(rows, extra=True)
    found = simhash.near_duplicates(docs)
    assert found.columns == ["doc_id", "fingerprint", "component_id"]
    got = sorted(((r["doc_id"], r["component_id"]) for r in found.collect()), key=str)
    assert got == sorted([(5, 3), (3, 3), (3, 3), (9, 9), (None, 3), (7, 2), (2, 2), (None, None)], key=str)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([3, 3, 9, None, 2, None], key=str)


def test_an_empty_table(documents):
    assert simhash.near_duplicates(documents([])).count() == 0
    assert simhash.drop_near_duplicates(documents([])).count() == 0
