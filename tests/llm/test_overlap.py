import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from tests_llm_helpers import prose
from wardline.llm import overlap


def plain(text):
    found = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).encode().split()
    return {tuple(found[i:i + 5]) for i in range(max(1, len(found) - 4))} if found else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def texts():
    """Originals and copies with more and more words changed, so that similarities lie on both sides of 0.8."""
    rng, rows = random.Random(8), {}
    for base in range(25):
        words = prose(base, rng.randint(80, 200)).split()
        for copy in range(6):
            changed = list(words)
            for at in rng.sample(range(len(words)), len(words) * copy // 110):
                changed[at] = "other"
            rows[base * 10 + copy] = " ".join(changed)
    rows |= {900: None, 901: "", 902: "one two", 903: "One  two", 904: "one three"}
    return rows


def brute_force(rows):
    sets, root = {k: plain(t) for k, t in rows.items()}, {k: k for k in rows}
    for a in sorted(rows):
        for b in sorted(rows):
            if a < b and jaccard(sets[a], sets[b]) >= 0.8:
                least, other = sorted((root[a], root[b]))
                root = {k: least if r == other else r for k, r in root.items()}
    return root


@pytest.mark.parametrize("text", [None, "", " \n", "One", "a b c d e", "A b c d e f", "x " * 50, prose(1, 90)])
def test_shingles_are_the_distinct_runs_of_five_words(text):
    assert len(overlap.shingles(text)) == len(plain(text))
    assert set(overlap.shingles(text)) <= set(overlap.shingles((text or "").upper()))


@pytest.mark.parametrize("piece", [3, 512])
def test_components_equal_brute_force(documents, piece):
    rows = texts()
    found = overlap.near_duplicates(documents(list(rows.items()), extra=True), piece=piece)
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == brute_force(rows)


def test_the_stage_drops_all_but_the_least(spark, documents):
    rows = texts()
    docs = documents(list(rows.items()))
    kept = pipeline.without_near_duplicates(spark, docs, "")
    assert kept.dtypes == docs.dtypes
    root = brute_force(rows)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({r for r in root.values()})


def test_nulls_repeats_and_an_empty_table(documents):
    text = prose(2, 200)
    near = text.replace(text.split()[9], "other")
    docs = documents([(5, text), (3, near), (3, near), (None, text), (None, text), (7, None), (2, "")], extra=True)
    assert sorted((r["doc_id"] for r in overlap.drop_near_duplicates(docs).collect()), key=str) == [2, 3, 3, None, None]
    assert overlap.drop_near_duplicates(documents([])).count() == 0


def bands_of(documents, texts):
    """The classes of distinct texts, and their buckets."""
    rows = [(n, len(v), overlap.bands(v).tolist()) for n, v in enumerate(map(overlap.shingles, texts))]
    classes = documents([]).sparkSession.createDataFrame(rows, "node long, size int, bands array<long>")
    return overlap.in_buckets(classes)


def chain(length):
    """Each text shares 85 of 100 words with the next, which bands find, and 0.7 of their shingles, which is no link."""
    said = prose(11, length * 15 + 100).split()
    return [" ".join(said[i * 15:i * 15 + 100]) for i in range(length)]


def test_a_chain_of_shared_passages_is_not_one_group(documents):
    texts = chain(1500)
    buckets = bands_of(documents, texts)
    nothing = buckets.select("node", F.col("node").alias("label")).limit(0)
    dealt = overlap.open_buckets(buckets, nothing, 512)
    groups = dealt.groupBy("band", "bits", "p", "q").count().agg(F.max("count"), F.sum("count"), F.countDistinct("bits")).first()
    assert groups[0] <= 20 and groups[2] > 1000 and groups[1] <= 40 * len(texts)
    found = overlap.near_duplicates(documents(list(enumerate(texts))))
    assert found.where("doc_id <> component_id").isEmpty()


def test_only_buckets_with_unconnected_nodes_stay_open_and_pieces_are_bounded(documents):
    said = prose(12, 120).split()
    copies = [" ".join([*said[:100], f"copy{i}"]) for i in range(300)]
    buckets = bands_of(documents, copies)
    spark = buckets.sparkSession
    one = spark.createDataFrame([(n, 0) for n in range(300)], "node long, label long")
    assert overlap.open_buckets(buckets, one, 16).isEmpty()
    two = spark.createDataFrame([(n, 0) for n in range(299)] + [(299, 299)], "node long, label long")
    dealt = overlap.open_buckets(buckets, two, 16).groupBy("band", "bits", "p", "q").count()
    assert dealt.agg(F.max("count")).first()[0] <= 80
    around = overlap.stars(buckets, 0.8, 16)
    assert around.groupBy("centre", "p").count().agg(F.max("count")).first()[0] <= 40
    assert around.where("node <> centre").select("node").distinct().count() == 299


def test_repeated_null_and_equal_keys_with_near_texts(documents):
    base = prose(13, 150).split()
    near = [" ".join([*base[:140], f"end{i}"]) for i in range(6)]
    docs = documents([(1, near[0]), (1, near[1]), (None, near[2]), (None, near[3]), (9, near[4]), (9, near[4]), (4, prose(14, 80))])
    found = overlap.near_duplicates(docs)
    assert sorted((str(r["doc_id"]), r["component_id"]) for r in found.collect()) == [
        ("1", 1), ("1", 1), ("4", 4), ("9", 1), ("9", 1), ("None", 1), ("None", 1)]
