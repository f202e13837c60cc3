"""Fill-in-middle: a text is cut in three by tokens or code points, and the middle goes last.

Texts stay the UTF-8 bytes they are. A sparse index of the characters of more
than one byte converts between places in bytes and in code points; the ASCII
between them is arithmetic.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

SEED = 42
#: Percent of the texts that are rearranged, and of those the percent in suffix-prefix-middle order.
PERCENT = 50
SPM_PERCENT = 80
#: The marks that go before the parts.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Bytes looked at in one go, so that a very long text needs no more than its own size and its exceptions.
BLOCK = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


class MultibyteIndex:
    """Byte places of the characters of two to four bytes, and by how much bytes are ahead of code points there."""

    def __init__(self, data: np.ndarray):
        starts, excess = [], []
        for low in range(0, len(data), BLOCK):
            piece = data[low:low + BLOCK]
            at = np.flatnonzero(piece >= 0xC0)
            if len(at):
                lead = piece[at]
                starts.append(at + low)
                excess.append(1 + (lead >= 0xE0) + (lead >= 0xF0))
        self.bytes = np.concatenate(starts) if starts else np.empty(0, np.int64)
        self.ahead = np.zeros(len(self.bytes) + 1, np.int64)
        if starts:
            np.cumsum(np.concatenate(excess), out=self.ahead[1:])
        self.chars = self.bytes - self.ahead[:-1]
        self.size = len(data)

    def to_chars(self, at: int) -> int:
        """Code points before byte `at`, a character's start or the end."""
        return int(at - self.ahead[np.searchsorted(self.bytes, at)])

    def to_bytes(self, at: int) -> int:
        """Bytes before code point `at`."""
        return int(at + self.ahead[np.searchsorted(self.chars, at)])

    def __len__(self) -> int:
        return int(self.size - self.ahead[-1])


class TokenEnds:
    """Where the tokens `[space]*[other]+|[space]+` of a text end: counted by blocks, looked up in one block."""

    def __init__(self, data: np.ndarray):
        self.data = data
        self.before = np.zeros(-(-len(data) // BLOCK) + 1, np.int64)
        self._first = self._ends(0)
        for i in range(len(self.before) - 1):
            self.before[i + 1] = self.before[i] + len(self._first if i == 0 else self._ends(i))
        self.words = int(self.before[-1])
        # spaces behind the last word are a token of their own
        self.count = self.words + int(len(data) > 0 and bool(_SPACE[data[-1]]))

    def _ends(self, block: int) -> np.ndarray:
        low = block * BLOCK
        space = _SPACE[self.data[low:low + BLOCK + 1]]
        if low + BLOCK >= len(self.data):
            space = np.append(space, True)
        return np.flatnonzero(~space[:-1] & space[1:]) + low + 1

    def end(self, number: int) -> int:
        """Bytes up to the end of the first `number` tokens."""
        if not number:
            return 0
        if number > self.words:
            return len(self.data)
        block = int(np.searchsorted(self.before, number)) - 1
        return int((self._first if block == 0 else self._ends(block))[number - self.before[block] - 1])


def _rearranged(data: np.ndarray, draws: tuple[int, int, int, int], unit: str, percent: int, spm_percent: int,
                ) -> tuple[int, str, bytes | None, int | None, int | None]:
    """`n`, `form`, output (None: the text as it is), code points of prefix and middle."""
    index = None
    if unit == "token":
        ends = TokenEnds(data)
        count = ends.count
    else:
        index = MultibyteIndex(data)
        count = len(index)
    text = data.tobytes()
    if not text or draws[2] % 100 >= percent or any(mark.encode() in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return count, "plain", None, None, None
    low, high = sorted((draws[0] % (count + 1), draws[1] % (count + 1)))
    a, b = (ends.end(low), ends.end(high)) if unit == "token" else (index.to_bytes(low), index.to_bytes(high))
    index = index or MultibyteIndex(data)
    first, second = index.to_chars(a), index.to_chars(b)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if draws[3] % 100 < spm_percent:
        parts = (SUFFIX.encode(), suffix, PREFIX.encode(), prefix, MIDDLE.encode(), middle)
        return count, "spm", b"".join(parts), first, second - first
    parts = (PREFIX.encode(), prefix, SUFFIX.encode(), suffix, MIDDLE.encode(), middle)
    return count, "psm", b"".join(parts), first, second - first


def _texts(column: pa.Array) -> Iterator[np.ndarray]:
    """The bytes of every text of an Arrow column, without a copy; null is empty."""
    wide = pa.types.is_large_string(column.type)
    _, places, content = column.buffers()
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1] if len(column) else []
    data = np.frombuffer(content, np.uint8) if content is not None else np.empty(0, np.uint8)
    for i, known in enumerate(column.is_valid().to_pylist()):
        yield data[offsets[i]:offsets[i + 1]] if known else data[:0]


def fill_in_middle(docs: DataFrame, key: str = "doc_id", text: str = "text", *, seed: int = SEED, percent: int = PERCENT,
                   spm_percent: int = SPM_PERCENT, unit: str = "token") -> DataFrame:
    """`key`, `n`, `form`, `output`, `prefix_chars`, `middle_chars` for every row, in one pass and without a shuffle.

    `n` counts the units a text is cut at: tokens (a word with the spaces before
    it; spaces at the end are one more) or, with `unit="char"`, code points. The
    draws are the first four groups of 8 hex digits of the SHA-256 of
    `<seed>:<key>`: two cuts of 0 to `n` units, whether to rearrange, and the
    order. A text that is empty or holds a mark itself stays `plain`, with null
    `prefix_chars` and `middle_chars`.

    Null texts are empty. A null key draws as an empty one. Rows that repeat are
    each returned and draw alike. Very long texts are looked at by blocks; on
    top of the text and its output they need the index, 24 bytes for each
    character that is not ASCII. An empty table gives an empty table. Other
    columns of `docs` are not read, whatever their names.
    """
    if unit not in ("token", "char"):
        raise ValueError("unit must be token or char")
    kind = docs.schema[key].dataType.simpleString()
    named = F.col(key).cast("string")
    digits = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(named, F.lit(""))), 256)
    draws = [F.conv(F.substring(digits, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]
    schema = "key string, n long, form string, output string, prefix_chars long, middle_chars long"

    def mapped(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = zip(*(batch.column(f"h{i}").to_pylist() for i in range(1, 5)))
            texts = list(_texts(batch.column("text")))
            rows = [_rearranged(data, draw, unit, percent, spm_percent) for data, draw in zip(texts, own)]
            output = [data.tobytes() if row[2] is None else row[2] for data, row in zip(texts, rows)]
            columns = list(zip(*rows)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").cast(pa.string()), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string()),
                 pa.array(output, pa.binary()).cast(pa.string()), pa.array(columns[3], pa.int64()), pa.array(columns[4], pa.int64())],
                names=["key", "n", "form", "output", "prefix_chars", "middle_chars"])

    found = docs.select(named.alias("key"), F.col(text).alias("text"), *draws).mapInArrow(mapped, schema)
    return found.select(F.col("key").cast(kind).alias(key), "n", "form", "output", "prefix_chars", "middle_chars")


def restored(output: Column, form: Column) -> Column:
    """The text an output was made from.

    The parts hold no mark, and no mark can begin inside another or across a
    part's end, so each is found exactly once.
    """

    def behind(mark: str) -> Column:
        return F.substring_index(output, mark, -1)

    def between(mark: str, stop: str) -> Column:
        return F.substring_index(behind(mark), stop, 1)

    psm = F.concat(between(PREFIX, SUFFIX), behind(MIDDLE), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), behind(MIDDLE), between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
