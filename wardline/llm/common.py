"""Helpers shared by the corpus operators: words, batches of whole groups, reproducible samples."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

WORD = r"[^\x20\x09-\x0D]+"
#: Characters of a text that are taken apart at a time.
SLICE = 400_000
_BREAK = re.compile(r"[\x20\x09-\x0D]")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """`name`, made longer until `df` has no column of that name, in any case of its letters."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def utf8(text: str | None) -> bytes:
    """Whole text as bytes; null is empty. Lone surrogates, which UTF-8 has no bytes for, become `?`."""
    return b"" if text is None else text.encode("utf-8", "replace")


def words(data: bytes) -> list[bytes]:
    """Runs of anything but space and \\x09 to \\x0D, which is what `bytes.split` cuts at."""
    return data.split()


def slices(text: str | None, most: int = SLICE) -> Iterator[str]:
    """The whole text in parts that end behind the first white space from `most` characters on, so no word is cut.

    A word longer than `most` is in one part; a null or empty text has no parts.
    """
    start, size = 0, len(text or "")
    while start < size:
        found = _BREAK.search(text, start + most - 1) if size - start > most else None
        end = found.end() if found else size
        yield text if end - start == size else text[start:end]
        start = end


def lines(text: str | None) -> Iterator[str]:
    """The lines of a text that are not empty, one at a time."""
    return (found.group() for found in re.finditer(r"[^\n]+", text or ""))


def held_out(doc_id: Column) -> Column:
    """A fixed quarter of the documents whose labels are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def bounded_sample(df: DataFrame, limit: int, *key: str) -> DataFrame:
    """At most `limit` rows, the ones with the least hash of `key`, whatever the partitioning."""
    return df.orderBy(F.xxhash64(*key), *key).limit(limit)


def known_labels(labels: DataFrame, key: str, label: str) -> DataFrame:
    """`k`, `y`: keys that may be learnt from and their label, 0 or 1; the greater where rows disagree."""
    return (labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull() & ~held_out(F.col(key)))
            .groupBy(F.col(key).alias("k")).agg(F.max(label).cast("int").alias("y")))


def whole_groups(batches: Iterable[pd.DataFrame], keys: list[str]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Frames that end at a group's end, with the group number of each row.

    The input must be sorted by `keys`. Only the last, unfinished group is
    carried from batch to batch, so groups have to be bounded by the caller.
    """
    rest: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        frame = pd.concat([*rest, batch], ignore_index=True) if rest else batch.reset_index(drop=True)
        starts = _changes(frame, keys)
        last = starts.nonzero()[0][-1]
        if last:
            yield frame.iloc[:last], starts[:last].cumsum() - 1
        rest = [frame.iloc[last:]]
    if rest:
        frame = pd.concat(rest, ignore_index=True)
        yield frame, _changes(frame, keys).cumsum() - 1


def _changes(frame: pd.DataFrame, keys: list[str]) -> np.ndarray:
    new = np.zeros(len(frame), bool)
    new[0] = True
    for key in keys:
        values = frame[key].to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return new


def pairs_in_groups(groups: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (i, j), i < j, of every two rows of one group, a distance at a time; groups must be contiguous."""
    sizes = np.bincount(groups)
    ends = np.cumsum(sizes)[groups]
    at = np.arange(len(groups))
    step = 1
    while True:
        at = at[at + step < ends[at]]
        if not len(at):
            return
        yield at, at + step
        step += 1


def forest(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least position reachable from each of `size` positions over the links (a, b)."""
    label = np.arange(size)
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        np.minimum.at(new, label[a], least)
        np.minimum.at(new, label[b], least)
        new = new[new]
        if (new == label).all():
            return label
        label = new
