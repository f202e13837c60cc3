import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests_llm_helpers import prose
from wardline.llm import fim

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
ODD = ["", " ", "a", "a ", " a", "  a\t\nb  ", "ção é", "日本語 の 文", "😀😀 x 😀", "a b c\x1cd", "\r\n\x0b\x0c", "é" * 9 + " ",
       "holds <P> a mark", "<M>", "< S>", "<S"]


def plain(key, text, seed=42, percent=50, spm=80, unit="token"):
    text = text or ""
    digits = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digits[i:i + 8], 16) for i in range(0, 32, 8)]
    units = TOKEN.findall(text) if unit == "token" else list(text)
    assert "".join(units) == text
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return n, "plain", text, None, None
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm:
        return n, "spm", f"<S>{suffix}<P>{prefix}<M>{middle}", len(prefix), len(middle)
    return n, "psm", f"<P>{prefix}<S>{suffix}<M>{middle}", len(prefix), len(middle)


def texts():
    rng = random.Random(4)
    signs = "ab cé \n\t日😀., "
    return ODD + ["".join(rng.choice(signs) for _ in range(rng.randint(1, 60))) for _ in range(300)] + [prose(1, 4000)]


@pytest.mark.parametrize("options", [{}, {"percent": 100, "spm_percent": 50}, {"percent": 100, "unit": "char", "seed": 7}])
def test_outputs_equal_the_plain_definition(spark, documents, options):
    rows = [(key, text) for key, text in enumerate(texts())] + [(None, "no key é"), (3, "repeated"), (3, "repeated"), (900, None)]
    found = fim.fill_in_middle(documents(rows, extra=True), **options)
    assert found.columns == ["doc_id", "n", "form", "output", "prefix_chars", "middle_chars"]
    found = found.withColumn("restored", fim.restored(F.col("output"), F.col("form")))
    named = {"percent": options.get("percent", 50), "spm": options.get("spm_percent", 80), "unit": options.get("unit", "token"),
             "seed": options.get("seed", 42)}
    expected = sorted(((k, *plain(k, t, **named), t or "") for k, t in rows), key=str)
    assert sorted((tuple(r) for r in found.collect()), key=str) == expected
    assert {"psm", "spm", "plain"} == {row[2] for row in expected}


@pytest.mark.parametrize("block", [1, 3, 7, 64])
def test_blocks_change_nothing(monkeypatch, block):
    monkeypatch.setattr(fim, "BLOCK", block)
    for text in texts():
        data = np.frombuffer(text.encode(), np.uint8)
        tokens, index = fim.TokenEnds(data), fim.MultibyteIndex(data)
        ends = np.cumsum([0] + [len(t.encode()) for t in TOKEN.findall(text)])
        assert [tokens.end(i) for i in range(tokens.count + 1)] == ends.tolist()
        places = np.cumsum([0] + [len(sign.encode()) for sign in text]).tolist()
        assert len(index) == len(text)
        assert [index.to_bytes(i) for i in range(len(text) + 1)] == places
        assert [index.to_chars(at) for at in places] == list(range(len(text) + 1))


def test_the_index_holds_only_what_is_not_ascii():
    assert len(fim.MultibyteIndex(np.frombuffer(b"plain text", np.uint8)).bytes) == 0
    assert fim.MultibyteIndex(np.frombuffer("aé日😀".encode(), np.uint8)).ahead.tolist() == [0, 1, 3, 6]


def test_a_very_long_text_and_an_empty_table(documents):
    text = (prose(3, 3000) + " é日😀\n") * 300
    found = fim.fill_in_middle(documents([(8, text), (9, " " * 3_000_000)]), percent=100).collect()
    for row in found:
        original = text if row["doc_id"] == 8 else " " * 3_000_000
        assert tuple(row)[1:] == plain(row["doc_id"], original, percent=100)
    assert fim.fill_in_middle(documents([])).count() == 0
    with pytest.raises(ValueError):
        fim.fill_in_middle(documents([]), unit="line")
