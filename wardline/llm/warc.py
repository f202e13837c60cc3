"""WARC archives: pages written as chunked, segmented records with revisits, and put together again when read."""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from wardline.llm.common import utf8
from wardline.session import fresh_path, materialize

#: Payloads of this many bytes and more are written once and revisited.
REVISIT_BYTES = 1000
#: Longer blocks are cut into segments; chunks of the transfer framing are at most a quarter of that.
SEGMENT_BYTES = 16 * 1024
#: Records of one archive file, which bounds its size.
ARCHIVE_RECORDS = 2048
DATE = "2024-01-01T00:00:00Z"
_END = b"\r\n"
_BATCH = 4_000_000

RECORD = T.StructType([
    T.StructField("record_id", T.StringType()), T.StructField("record_type", T.StringType()),
    T.StructField("page_id", T.StringType()), T.StructField("url", T.StringType()),
    T.StructField("refers", T.StringType()), T.StructField("digest", T.StringType()),
    T.StructField("origin", T.StringType()), T.StructField("segment", T.LongType()),
    T.StructField("total", T.LongType()), T.StructField("block", T.BinaryType())])


def record_id(page_id: str | None, url: str | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(repr((page_id, url, digest)).encode('utf-8', 'replace')).digest())}>"


def chunked(payload: bytes, size: int) -> bytes:
    """A payload in chunked transfer framing, cut where a character begins."""
    return b"".join(b"%x\r\n%s\r\n" % (len(part), part) for part in _segments(payload, size) if part) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked body, extensions and trailers left out; ValueError where the framing is broken."""
    out, at = [], 0
    while True:
        end = body.index(_END, at)
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if size == 0:
            return b"".join(out)
        if size < 0 or body[at + size:at + size + 2] != _END:
            raise ValueError("a chunk does not end where it says")
        out.append(body[at:at + size])
        at += size + 2


def _segments(block: bytes, size: int) -> list[bytes]:
    """The block in pieces of at most `size` bytes, four at least, that begin at a character's first byte."""
    size = max(size, 4)
    parts, at = [], 0
    while len(block) - at > size:
        cut = at + size
        while block[cut] & 0xC0 == 0x80:
            cut -= 1
        parts.append(block[at:cut])
        at = cut
    return [*parts, block[at:]]


def records(page_id: str | None, url: str | None, html: str | None, digest: str, refers: str | None,
            segment_bytes: int = SEGMENT_BYTES, date: str = DATE) -> list[str]:
    """The records of a page, each but for the last line end of two."""
    payload = utf8(html)
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    own = record_id(page_id, url, digest)
    parts = [head] if refers else _segments(head + chunked(payload, segment_bytes // 4), segment_bytes)
    total, out = sum(map(len, parts)), []
    for number, part in enumerate(parts, 1):
        lines = ["WARC/1.1", f"WARC-Type: {'continuation' if number > 1 else 'revisit' if refers else 'response'}",
                 f"WARC-Record-ID: {own if number == 1 else record_id(own, str(number), digest)}", f"WARC-Date: {date}"]
        if url is not None:
            lines.append(f"WARC-Target-URI: {url.replace('%', '%25').replace(chr(13), '%0D').replace(chr(10), '%0A')}")
        if number == 1:
            if page_id is not None:
                lines.append(f"X-Page-Id: {page_id}")
            lines.append(f"WARC-Payload-Digest: sha1:{digest}")
            lines.append("Content-Type: application/http; msgtype=response")
        if refers:
            lines += [f"WARC-Refers-To: {refers}",
                      "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
        if len(parts) > 1:
            lines.append(f"WARC-Segment-Number: {number}")
            if number > 1:
                lines.append(f"WARC-Segment-Origin-ID: {own}")
            if number == len(parts):
                lines.append(f"WARC-Segment-Total-Length: {total}")
        lines.append(f"Content-Length: {len(part)}")
        out.append("\r\n".join(lines) + "\r\n\r\n" + part.decode("utf-8") + "\r\n")
    return out


def write_archives(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html", *,
                   revisit_bytes: int = REVISIT_BYTES, segment_bytes: int = SEGMENT_BYTES,
                   archive_records: int = ARCHIVE_RECORDS, compression: str = "gzip") -> None:
    """Write every page to archives in the folder `path`.

    Of pages with one payload of at least `revisit_bytes`, the one with the
    greatest key carries it and the others refer to it. A null text is an empty
    payload; null keys and addresses are left out of a record. Rows that repeat
    a key are written as often as they occur. Spark's text writer makes the
    files, so any file system will do; payloads are text, so they are UTF-8.
    """
    rows = pages.select(F.col(key).alias("page_id"), F.col(url).cast("string").alias("url"),
                        F.coalesce(F.col(html), F.lit("")).alias("html")).withColumn("digest", F.sha1("html"))
    long = F.octet_length("html") >= revisit_bytes
    first = (rows.where(long).groupBy("digest").agg(F.count("*").alias("n"), F.max(F.struct("page_id", "url")).alias("kept"))
             .where("n > 1").select("digest", F.col("kept.page_id").alias("kept_id"), F.col("kept.url").alias("kept_url")))
    # the digests grow with the pages: the same plan, a merge join that AQE may split, at every size
    judged = (rows.join(first.hint("merge"), "digest", "left")
              .withColumn("revisit", F.coalesce(long & F.col("kept_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("kept_id")),
                                                F.lit(False))))

    def written(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            columns = (batch[name] for name in ("page_id", "url", "html", "digest", "revisit", "kept_id", "kept_url"))
            lines, size = [], 0
            for page, where, text, digest, again, kept, kept_where in zip(*columns):
                refers = record_id(kept, kept_where, digest) if again else None
                lines += records(page, where, text, digest, refers, segment_bytes)
                size += len(text)
                if size > _BATCH:
                    yield pd.DataFrame({"value": lines})
                    lines, size = [], 0
            yield pd.DataFrame({"value": lines}, dtype=object)

    ids = [F.col("page_id").cast("string").alias("page_id"), F.col("kept_id").cast("string").alias("kept_id")]
    (judged.select("url", "html", "digest", "revisit", "kept_url", *ids).mapInPandas(written, "value string")
     .write.option("lineSep", "\r\n").option("maxRecordsPerFile", archive_records).option("compression", compression).text(path))


def parsed(content: bytes) -> Iterator[tuple]:
    """The records of an archive, plain or gzipped, as rows of RECORD; ValueError where it is broken."""
    if content[:2] == b"\x1f\x8b":
        content = gzip.decompress(content)
    at = 0
    while at < len(content):
        end = content.index(b"\r\n\r\n", at)
        version, *lines = content[at:end].decode("utf-8", "replace").split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        field = {}
        for line in lines:
            name, _, value = line.partition(":")
            field[name.strip().lower()] = value.strip()
        start = end + 4
        stop = start + int(field["content-length"])
        if content[stop:stop + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} is not as long as it says")
        segment, total = field.get("warc-segment-number"), field.get("warc-segment-total-length")
        where = field.get("warc-target-uri")
        yield (field.get("warc-record-id"), field.get("warc-type"), field.get("x-page-id"),
               None if where is None else where.replace("%0D", "\r").replace("%0A", "\n").replace("%25", "%"),
               field.get("warc-refers-to"), _hex(field.get("warc-payload-digest")),
               field.get("warc-segment-origin-id") or (field.get("warc-record-id") if segment else None),
               int(segment) if segment else None, int(total) if total else None, bytearray(content[start:stop]))
        at = stop + 4


def _hex(digest: str | None) -> str | None:
    if digest is None:
        return None
    value = digest.rpartition(":")[2]
    return value.lower() if len(value) == 40 else base64.b32decode(value.upper()).hex()


def payload_of(block: bytes) -> bytes:
    """The payload of an HTTP response: what follows the header, unframed if that says so."""
    head, _, body = block.partition(b"\r\n\r\n")
    for line in head.split(_END)[1:]:
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"transfer-encoding" and value.strip().lower() == b"chunked":
            return unchunked(body)
    return body


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """`record_id`, `record_type`, `page_id`, `url`, `refers`, `payload_bytes`, `payload_digest`, `payload` by page.

    Continuations are grouped by their origin and put in the order of their
    segment numbers. A record whose segments are not complete, whose length is
    not the one stated, whose chunks are broken or whose digest differs fails
    the read. Records with the same id and segment number are the repeated
    writing of one page, which is returned as often. Revisits have no payload;
    an empty folder gives no rows. A task holds one archive at a time.
    """
    try:
        files = spark.sparkContext.binaryFiles(path, spark.sparkContext.defaultParallelism)
        found = spark.createDataFrame(files.flatMap(lambda file: parsed(file[1])), RECORD, verifySchema=False)
    except Exception as error:
        if "Input path does not exist" not in str(error):
            raise
        found = spark.createDataFrame([], RECORD)
    return assembled(found, payloads)


def assembled(found: DataFrame, payloads: bool = True) -> DataFrame:
    """Whole records from rows of RECORD; see `read_archives`."""
    names = ["record_id", "record_type", "page_id", "url", "refers", "digest"]
    single = found.where("segment IS NULL").select(*names, "block", F.lit(None).cast("long").alias("total"), F.lit(1).alias("times"),
                                                   F.lit(1).cast("long").alias("first"), F.lit(1).cast("long").alias("last"))
    head = F.when(F.col("segment") == 1, F.struct(*names))
    parts = F.array_sort(F.collect_set(F.struct("segment", "block")))
    joined = (found.where("segment IS NOT NULL").groupBy("origin")
              .agg(F.first(head, ignorenulls=True).alias("head"), parts.alias("parts"), F.max("total").alias("total"),
                   F.sum(F.when(F.col("segment") == 1, 1).otherwise(0)).cast("int").alias("times"))
              .select("head.*", F.expr("aggregate(parts, cast('' AS binary), (whole, p) -> concat(whole, p.block))").alias("block"),
                      F.coalesce("total", F.lit(-1)).alias("total"), "times",
                      F.expr("parts[0].segment").alias("first"),
                      F.expr("IF(parts[size(parts) - 1].segment = size(parts), parts[0].segment, -1)").alias("last")))

    def decoded(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for row in batch.itertuples(index=False):
                block = bytes(row.block)
                if row.first != 1 or row.last != 1 or not (pd.isna(row.total) or row.total == len(block)):
                    raise ValueError(f"segments of {row.record_id} are missing or not as long as stated")
                payload, digest, size = None, row.digest, None
                if row.record_type != "revisit":
                    payload = payload_of(block)
                    digest, size = hashlib.sha1(payload).hexdigest(), len(payload)
                    if row.digest not in (None, digest):
                        raise ValueError(f"the payload of {row.record_id} has another digest")
                rows += [(*(getattr(row, n) for n in names[:5]), size, digest, payload if payloads else None)] * row.times
            yield pd.DataFrame(rows, columns=[*names[:5], "payload_bytes", "payload_digest", "payload"]).astype(
                {"payload_bytes": "Int64"})

    schema = ", ".join(f"{n} string" for n in names[:5]) + ", payload_bytes long, payload_digest string, payload binary"
    return (single.unionByName(joined).where(F.col("record_type").isin("response", "revisit")).mapInPandas(decoded, schema))


def round_trip(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", **options) -> DataFrame:
    """Write the pages and read them back: `key`, `payload_bytes`, `payload_digest`, `record_type`, `refers_to`.

    What is told of a page comes from the archives: of a revisit its own
    record, and through the record it refers to the payload's length.
    """
    spark = pages.sparkSession
    kind = pages.schema[key].dataType.simpleString()
    path = fresh_path(spark, "archives")
    write_archives(pages, path, key, url, html, **options)
    found = materialize(read_archives(spark, path, payloads=False).drop("payload"), "records")
    carried = (found.where("record_type = 'response'").groupBy(F.col("record_id").alias("refers"))
               .agg(F.first("page_id").alias("refers_to"), F.first("payload_bytes").alias("known_bytes")))
    revisits = found.where("record_type = 'revisit'").drop("payload_bytes").join(carried, "refers", "left")
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    every = (found.where("record_type = 'response'").withColumn("refers_to", F.lit(None).cast("string")).select(*names)
             .unionByName(revisits.withColumnRenamed("known_bytes", "payload_bytes").select(*names)))
    return every.select(F.col("page_id").cast(kind).alias(key), "payload_bytes", "payload_digest", "record_type",
                        F.col("refers_to").cast(kind).alias("refers_to"))
