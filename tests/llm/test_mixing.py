from fractions import Fraction

import pytest

from tests_llm_helpers import prose
from wardline.llm import mixing


def test_targets_are_shared_out_again_above_the_limit():
    got = mixing.targets({"b": 100, "a": 100, None: 100, "c": 10})
    # weights a 3, b 1, c 2, null 3 share 465 words; c stops at 20, and 445 are shared by the others
    assert got == {"a": Fraction(1335, 7), "b": Fraction(445, 7), "c": Fraction(20), None: Fraction(1335, 7)}
    assert mixing.targets({}) == {} and mixing.targets({"a": 0}) == {"a": 0}


def rows():
    out = [(i, prose(i, 5 + i % 60), f"s{i % 3}" if i % 11 else None) for i in range(120)]
    return [*out, (7, prose(7, 12), "s1"), (None, "no key here", "s2"), (300, None, "s0"), (301, "", ""), (302, prose(8, 4000), "s0")]


@pytest.mark.parametrize("block", [7, 1024])
def test_taken_words_meet_the_targets(documents, block):
    mixed = mixing.mix(documents(rows(), extra=True), block=block)
    found = mixing.taken(mixed).toPandas()
    assert len(found) == len(rows())
    assert (found["taken"] <= 2 * found["size"]).all()
    for _, own in found.groupby(found["source"].fillna("-")):
        assert own["size"].sum() == own["source_size"].iloc[0]
        assert own["taken"].sum() == int(own["target"].iloc[0])
    plan = mixed.schedule.toPandas()
    per_slot = plan.groupby("slot").agg(words=("words", "sum"), sources=("source_no", "nunique"))
    assert per_slot["words"].max() <= block and (per_slot["sources"] == 1).all()
    again = mixing.taken(mixing.mix(documents(rows()).repartition(1), block=block)).toPandas()
    order = ["doc_id", "source", "size", "taken"]
    assert found[order].fillna(-1).astype(str).sort_values(order).values.tolist() == again[order].fillna(-1).astype(str).sort_values(order).values.tolist()


def test_any_stretch_of_the_schedule_is_near_the_shares(spark):
    takes = [300_000, 100_000, 200_000]
    slots = mixing.slots(spark, takes, 100, piece=512).toPandas().sort_values("slot")
    assert len(slots) == 6000 and slots["slot"].is_unique
    for _, own in slots.groupby("source_no"):
        assert own["rank"].tolist() == list(range(len(own)))
    for start in range(0, 5500, 500):
        stretch = slots.iloc[start:start + 500]["source_no"].value_counts(normalize=True)
        assert abs(stretch[0] - 1 / 2) < 0.02 and abs(stretch[1] - 1 / 6) < 0.02


def test_many_sources_get_what_a_plain_schedule_gives(spark):
    takes = [(i * 37) % 900 + (i % 5 == 0) * 4000 for i in range(700)]
    found = {(r["slot"], r["source_no"], r["rank"]) for r in mixing.slots(spark, takes, 50, piece=1000).collect()}
    needed, total = [-(-words // 50) for words in takes], sum(takes)
    ends = [sum(takes[:i + 1]) for i in range(len(takes))]
    expected, drawn = set(), [0] * len(takes)
    for slot in range(sum(needed)):
        point = slot * mixing.GOLDEN % (1 << 64)
        source = next(i for i, end in enumerate(ends) if point < (end << 64) // total or i == len(takes) - 1)
        if drawn[source] < needed[source]:
            expected.add((slot, source, drawn[source]))
        drawn[source] += 1
    late = [(source, rank) for source, most in enumerate(needed) for rank in range(drawn[source], most)]
    expected |= {(sum(needed) + i, *one) for i, one in enumerate(late)}
    assert found == expected


def test_a_source_of_each_document_meets_its_target(documents):
    found = mixing.taken(mixing.mix(documents([(i, prose(i, 1 + i % 9), f"host{i:04}") for i in range(600)]), block=4)).toPandas()
    assert len(found) == 600 and (found["taken"] == found["target"].astype(int)).all()


def test_mixed_documents_hold_the_taken_words(documents):
    docs = documents(rows(), extra=True)
    out = mixing.mixed_documents(docs, chars="n_chars", block=16)
    assert out.columns == docs.columns
    texts = [(r["text"], r["n_chars"], r["source"]) for r in out.collect()]
    assert all(len(text) == chars for text, chars, _ in texts)
    wanted = {r["source"]: r["target"] for r in mixing.mix(docs, block=16).rows.collect()}
    for source, target in wanted.items():
        assert abs(sum(len(t.split()) for t, _, s in texts if s == source) - target) <= 2


def test_an_empty_table(documents):
    assert mixing.taken(mixing.mix(documents([]))).count() == 0
    assert mixing.mixed_documents(documents([])).count() == 0
