"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_scratch: dict[str, str] = {}


def build_session(name: str = "wardline", master: str | None = None, **overrides: str) -> SparkSession:
    """A session with the settings the jobs are tuned for; `overrides` win.

    Nothing is broadcast by hint except results of a proven constant size, so
    `autoBroadcastJoinThreshold` (static sizes) and AQE (runtime sizes) decide:
    registry and municipality tables are broadcast while they are small, and
    are joined by sort-merge with skew splitting when they are not.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.files.maxPartitionBytes": "128m",
    }
    settings.update(overrides)
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate tables: the cluster's `spark.checkpoint.dir`.

    Only a local session may fall back to a temporary folder of this machine;
    executors of a cluster could not see it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="wardline-")
    return _local_scratch[app]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the scratch root that no earlier run has used."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Cuts the lineage before iterative work, and unlike a cache it survives the
    loss of executors.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
