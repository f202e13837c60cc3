import gzip
import hashlib

import pytest

from wardline.llm import warc

PAGES = "page_id long, url string, html string, block string, segment string, record_id string"


def pages():
    long = "<p>é😀" * 4000
    rows = [(1, "http://a/1", "short"), (2, "http://a/2", "short"), (3, "http://b/", long), (7, "http://b/x y", long), (5, None, long),
            (8, "http://c/%0D", "x" * 999), (9, "http://c/\r\nX: y", "x" * 999), (10, "", None), (11, "u", ""), (4, "d", "x" * 1000),
            (6, "d", "x" * 1000), (12, "w", "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 60), (None, "n", "é" * 700), (13, "m", "é" * 700)]
    return rows


@pytest.mark.parametrize("options", [{}, {"segment_bytes": 64, "archive_records": 3, "compression": "none"}])
def test_pages_come_back_from_the_archives(spark, options):
    rows = pages()
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], PAGES).repartition(3)
    got = {r["page_id"]: tuple(r)[1:] for r in warc.round_trip(df, **options).collect()}
    expected = {}
    for key, _, html in rows:
        data = (html or "").encode()
        same = [k for k, _, h in rows if (h or "").encode() == data and k is not None]
        kept = max(same, default=None) if len(data) >= 1000 else key
        again = kept is not None and kept != key
        expected[key] = (len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", kept if again else None)
    assert got == expected


def test_payloads_and_repeated_rows(spark, tmp_path):
    rows = [(1, "u", "é" * 500), (1, "u", "é" * 500), (2, "u", "z" * 3000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = f"{tmp_path}/w"
    warc.write_archives(df, path, segment_bytes=100)
    found = warc.read_archives(spark, path).collect()
    assert sorted((r["page_id"], r["url"], bytes(r["payload"]).decode()) for r in found) == [(str(a), b, c) for a, b, c in rows]
    assert warc.round_trip(df.limit(0)).count() == 0


def test_framing_and_parsing():
    data = "añb😀".encode() * 50
    assert warc.unchunked(warc.chunked(data, 7)) == data and warc.unchunked(warc.chunked(b"", 7)) == b""
    assert warc.unchunked(b"3;x=1\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"
    with pytest.raises(ValueError):
        warc.unchunked(b"3\r\nabcd\r\n0\r\n\r\n")
    whole = "".join(r + "\r\n" for r in warc.records("1", "u", "x" * 500, "ab" * 20, None, 100)).encode()
    plain, zipped = list(warc.parsed(whole)), list(warc.parsed(gzip.compress(whole)))
    assert plain == zipped and [r[7] for r in plain] == list(range(1, len(plain) + 1)) and plain[-1][8] == sum(len(r[9]) for r in plain)
    with pytest.raises(ValueError):
        list(warc.parsed(whole[:-40]))
    assert warc._hex("sha1:" + "A" * 32) == "00" * 20


@pytest.mark.parametrize("spoil", [lambda r: r[:1] + r[2:], lambda r: r[:-1], lambda r: [r[0][:9] + (bytearray(b"HTTP/1.1 200"),), *r[1:]]])
def test_incomplete_records_fail(spark, spoil):
    digest = hashlib.sha1(b"x" * 500).hexdigest()
    rows = list(warc.parsed("".join(r + "\r\n" for r in warc.records("1", "u", "x" * 500, digest, None, 100)).encode()))
    good = spark.createDataFrame(rows[::-1], warc.RECORD)
    assert [r["payload_bytes"] for r in warc.assembled(good).collect()] == [500]
    with pytest.raises(Exception, match="missing|digest|ValueError"):
        warc.assembled(spark.createDataFrame(spoil(rows), warc.RECORD)).collect()
