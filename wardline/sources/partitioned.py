"""Hive-style Parquet folders whose column types differ from folder to folder."""

from __future__ import annotations

import io
from collections.abc import Iterable, Iterator
from functools import reduce
from urllib.parse import urlsplit

import pandas as pd
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from wardline.sources.harmonize import harmonize

#: Schemes whose files a task opens itself, reading the footer and nothing else, and what they are called there.
DIRECT = {"": "file", "file": "file", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "hdfs": "hdfs", "viewfs": "viewfs"}


def _files(spark: SparkSession, root: str, keys: tuple[str, ...], since: dict[str, str],
           only: dict[str, list[str]] | None = None) -> DataFrame:
    """`path`, `folder` and the key values of every file of a folder that has every key in its path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    values = {key: F.regexp_extract("path", rf"/{key}=([^/]*)/", 1) for key in keys}
    wanted: list[Column] = [F.col(key) >= since.get(key, "") for key in keys]
    wanted += [F.col(key).isin(values_) for key, values_ in (only or {}).items()]
    return (files.withColumns({"folder": F.regexp_extract("path", r"^(.*)/[^/]*$", 1), **values})
            .filter(reduce(lambda left, right: left & right, [F.col(key) != "" for key in keys] + wanted)))


def discover_partitions(spark: SparkSession, root: str, keys: tuple[str, ...] = ("uf", "ano_mes"),
                        since: dict[str, str] | None = None) -> DataFrame:
    """One row per folder that has every key in its path: `path` and the key values.

    `since` gives keys a least value, in text order. Spark lists the files;
    `content` is never selected, so no file is opened.
    """
    found = _files(spark, root, keys, since or {})
    return found.select(F.col("folder").alias("path"), *keys).distinct().orderBy("path")


def _schema_of(path: str, content: bytes | None):
    if content is not None:
        return pq.read_schema(io.BytesIO(content))
    parts = urlsplit(path)
    if DIRECT[parts.scheme] == "file":
        return pq.read_schema(path.removeprefix(f"{parts.scheme}:").replace("//", "/") if parts.scheme else path)
    system, place = fs.FileSystem.from_uri(DIRECT[parts.scheme] + path[len(parts.scheme):])
    with system.open_input_file(place) as file:
        return pq.read_schema(file)


def footer_index(files: DataFrame, names: Iterable[str], direct: bool = True) -> DataFrame:
    """`path`, `folder`, `kind`: every file and the types its footer gives the columns in `names`, whatever their case.

    Files of one `kind` can be read by one scan. Tasks open the files, reading
    the footer only; with `direct=False`, for a file system that only Spark can
    open, they get the whole files from Spark.
    """
    wanted = {name.upper() for name in names}

    def read(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            contents = [None] * len(batch) if direct else batch["content"]
            kinds = []
            for path, content in zip(batch["path"], contents):
                types = {field.name.upper(): str(field.type) for field in _schema_of(path, content) if field.name.upper() in wanted}
                kinds.append(", ".join(f"{name} {types[name]}" for name in sorted(types)))
            yield batch[["path", "folder"]].assign(kind=kinds)

    if direct:  # only paths are moved: many small tasks, whatever the sizes of the files
        spark = files.sparkSession
        files = files.select("path", "folder").repartition(max(spark.sparkContext.defaultParallelism, 1) * 4)
        return files.mapInPandas(read, "path string, folder string, kind string")
    return files.select("path", "folder", "content").mapInPandas(read, "path string, folder string, kind string")


def read_drifting_parquet(spark: SparkSession, root: str, target: T.StructType,
                          keys: tuple[str, ...] = ("uf", "ano_mes"), keep: tuple[str, ...] = ("uf",),
                          since: dict[str, str] | None = None, only: dict[str, list[str]] | None = None) -> DataFrame:
    """All partitions of `root` in the `target` schema, with the partition keys in `keep`.

    A column may be text in one month and a number in the next, which no single
    Parquet read accepts. Folders are therefore grouped by the types their
    footers give the target columns, and every group is one scan: the plan has
    as many branches as there are conflicting types, not as there are months.

    One job reads the footers of all files, so a column, or a type, that a
    single file has is never lost. A folder whose files differ is read file by
    file. Spark gives the types of one file of each kind; only paths and kinds
    reach the driver. `since` gives keys a least value, in text order, `only` the
    values wanted.
    """
    files = _files(spark, root, keys, since or {}, only)
    direct = urlsplit(root).scheme in DIRECT
    found = (footer_index(files, target.names, direct).groupBy("folder")
             .agg(F.collect_set("kind").alias("kinds"), F.collect_list(F.struct("path", "kind")).alias("files"))
             .select("folder", F.element_at("kinds", 1).alias("kind"), F.element_at("files", 1).getField("path").alias("file"),
                     F.when(F.size("kinds") > 1, F.col("files")).alias("files")).collect())
    if not found:
        raise ValueError(f"no partition folders with {', '.join(keys)} under {root}")
    members: dict[str, list[str]] = {}
    samples: dict[str, str] = {}
    for row in sorted(found, key=lambda row: row.folder):
        for kind, member, file in ([(f.kind, f.path, f.path) for f in sorted(row.files)] if row.files else
                                   [(row.kind, row.folder, row.file)]):
            members.setdefault(kind, []).append(member)
            samples.setdefault(kind, file)
    wanted = {name.upper() for name in target.names}

    def columns_of(file: str) -> dict[str, T.StructField]:
        return {f.name.upper(): f for f in spark.read.parquet(file).schema.fields if f.name.upper() in wanted}

    groups = _compatible_groups((path, columns) for kind, columns in ((k, columns_of(f)) for k, f in samples.items())
                                for path in members[kind])
    scans = []
    for columns, paths in groups:
        # Partition values are declared as text, so that "01" stays "01".
        schema = T.StructType([*columns.values(), *[T.StructField(key, T.StringType()) for key in keys]])
        scan = spark.read.schema(schema).option("basePath", root).parquet(*paths)
        scans.append(harmonize(scan, target, keep))
    return union_all(scans)


def _compatible_groups(footers: Iterable[tuple[str, dict[str, T.StructField]]],
                       ) -> list[tuple[dict[str, T.StructField], list[str]]]:
    """Folders that one schema can read: the same type wherever they share a column.

    A column that only some folders of a group have is read as NULL from the others.
    """
    groups: list[tuple[dict[str, T.StructField], list[str]]] = []
    for folder, found in footers:
        for columns, members in groups:
            if all(columns[name].dataType == field.dataType for name, field in found.items() if name in columns):
                columns.update({name: field for name, field in found.items() if name not in columns})
                members.append(folder)
                break
        else:
            groups.append((dict(found), [folder]))
    return groups


def union_all(tables: list[DataFrame]) -> DataFrame:
    """UNION ALL by column name; columns a table lacks are NULL in its rows."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), tables)
