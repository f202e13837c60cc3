import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardline.llm import exact_topk

KINDS = "vec_id long, embedding array<double>, label int"


def vectors(seed=1, count=500, size=16):
    rng = np.random.default_rng(seed)
    rows = []
    for key in range(count):
        if rows and rng.random() < 0.5:  # groups of near and of equal vectors, so that there are many ties
            values = np.array(rows[rng.integers(len(rows))][1]) + rng.choice([0, 0, 0.02]) * rng.normal(0, 1, size)
        else:
            values = rng.normal(0, 1, size) * rng.choice([0.2, 1])
        rows.append((key * 2, values.tolist(), 0))
    return rows


def plain(rows, modulus=50, k=5):
    usable = [(key, [math.floor(256 * x) for x in v]) for key, v, _ in rows
              if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    answers = []
    for key, query in usable:
        if key is None or key % modulus:
            continue
        scored = sorted((-min(max(sum(a * b for a, b in zip(query, v)), -2 ** 63), 2 ** 63 - 1), other is None, other or 0)
                        for other, v in usable if other != key and len(v) == len(query))
        answers += [(key, rank, None if null else other, -score) for rank, (score, null, other) in enumerate(scored[:k], 1)]
    return sorted(answers, key=str)


def run(spark, rows, modulus=50, **options):
    df = spark.createDataFrame(rows, KINDS).repartition(4)
    for name in ("key", "row", "size", "data", "cell", "table", "norm", "floor", "score", "rank", "turn"):
        df = df.withColumn(name, F.lit("x"))
    found = exact_topk.top_k(df, F.col("key") % modulus == 0, **options)
    assert dict(found.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"}
    return sorted((tuple(r) for r in found.collect()), key=str)


@pytest.mark.parametrize("options", [{}, {"pivots": 4, "candidates": 20, "queries": 3}, {"pivots": 1, "sample": 10},
                                     {"pivots": 200, "candidates": 64}])
def test_answers_equal_brute_force(spark, options):
    rows = vectors()
    assert run(spark, rows, **options) == plain(rows)


def test_other_numbers_of_answers_and_queries(spark):
    rows = vectors(seed=2, count=120)
    assert run(spark, rows, modulus=6, k=1) == plain(rows, 6, 1)
    assert run(spark, rows, modulus=60, k=300) == plain(rows, 60, 300)


def test_unusable_vectors_odd_lengths_and_repeats(spark):
    one = [1.0, 2.0, 3.0]
    rows = [(0, one, 0), (0, one, 0), (1, one, 0), (1, one, 0), (None, one, 0), (None, [2.0, 2.0, 2.0], 0), (50, [1.0, 2.0], 0),
            (51, [0.5, -2.0], 0), (100, None, 0), (2, None, 0), (3, [1.0, None, 2.0], 0), (4, [1.0, float("nan"), 0.0], 0),
            (150, [1.0, float("inf"), 0.0], 0), (200, [], 0), (201, [], 0), (250, [7.0], 0), (5, [0.0, 0.0, 0.0], 0),
            (6, [-1.0, -2.0, -3.0], 0), (300, [0.0, 0.0, 0.0], 0)]
    assert run(spark, rows) == plain(rows)
    assert run(spark, rows, k=3, candidates=2, queries=1) == plain(rows, k=3)


def test_numbers_too_large_for_doubles(spark):
    rng = np.random.default_rng(3)
    rows = [(key, (rng.normal(0, 1, 3) * rng.choice([1.0, 1e6, 1e9, 1e17, 1e200])).tolist(), 0) for key in range(0, 200, 2)]
    assert run(spark, rows, modulus=10) == plain(rows, 10)


def test_large_keys_beside_null_keys(spark):
    big = 2 ** 62
    rows = [(big, [1.0], 0), (big + 1, [1.0], 0), (big + 2, [1.0], 0), (None, [1.0], 0), (-big, [1.0], 0), (-big - 1, [2.0], 0)]
    assert run(spark, rows, modulus=2) == plain(rows, 2)


def test_an_empty_table_and_one_without_queries(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0], 0), (2, [1.0], 0)]) == []
    assert run(spark, [(0, [1.0], 0)]) == []


def test_bounds_hold_and_leave_candidates_untried():
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 150, (30, 16)).round()
    rows = np.concatenate([c + rng.integers(-6, 7, (60, 16)) for c in centres])
    pivots = exact_topk.pivots_of(rows, 30)
    table, norms = exact_topk._distances(rows, pivots), np.linalg.norm(rows, axis=1)
    tried = 0
    for query in rows[::97]:
        far = exact_topk._distances(query[None], pivots)[0]
        bounds = exact_topk._bound(float(np.linalg.norm(query)), norms, np.abs(table - far).max(1))
        scores = (rows @ query).astype(np.int64)
        assert (bounds >= scores).all()
        at, best, count = exact_topk.best_of(rows, np.arange(len(rows)), bounds, query, 5, -2 ** 63, False)
        assert best.tolist() == sorted(scores.tolist(), reverse=True)[:5]
        assert at.tolist() == sorted(range(len(rows)), key=lambda i: (-scores[i], i))[:5]
        tried += count
    assert tried < 0.5 * len(rows) * len(rows[::97])


def test_float_vectors_are_widened_before_scaling(spark):
    df = spark.createDataFrame([(0, [0.1, 0.7]), (1, [0.3, 0.9])], "vec_id int, embedding array<float>")
    found = exact_topk.top_k(df, F.col("key") % 50 == 0)
    assert found.schema["query_id"].dataType.simpleString() == "int"
    whole = [[math.floor(256 * float(np.float32(x))) for x in v] for v in ([0.1, 0.7], [0.3, 0.9])]
    assert [tuple(r) for r in found.collect()] == [(0, 1, 1, sum(a * b for a, b in zip(*whole)))]
