"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
_local_roots: dict[str, str] = {}


def build_session(app: str = "pricetrail", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings the library is tuned for.

    ``shuffle.partitions`` is a ceiling that AQE coalesces from; on a cluster
    pass a value of two to three times the core count.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Bounds what a Python task holds when pages are large.
        "spark.sql.execution.arrow.maxBytesPerBatch": "67108864",
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    Only a local session may fall back to a folder of its own.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF)
    if root:
        return root.rstrip("/")
    # Executors of local-cluster are processes of their own.
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return _local_roots[app]


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; never reused between runs."""
    return f"{shared_root(spark)}/pricetrail/{name}-{os.getpid()}-{uuid.uuid4().hex[:12]}"


def checkpointed(df, name: str = "cut"):
    """Cut lineage by writing ``df`` to the shared folder and reading it back."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
