"""Session settings the operators count on, and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def session(master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName("tidemark")
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    A machine-local folder is made only where the setting is absent and the master
    is local, as in tests; on a cluster a missing setting is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        current = spark.sparkContext.getCheckpointDir()
        if current:
            return current
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="tidemark-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named


def work_dir(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder, for a written table or a stream."""
    return f"{checkpoint_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def kept(df: DataFrame) -> DataFrame:
    """``df`` written once as a table in the shared folder and read back.

    For results that several steps read and that are small next to their input, such as
    distinct keys. The table outlives lost executors, so nothing before it is run again,
    and its size on disk tells Spark how to join it.
    """
    path = work_dir(df.sparkSession, "kept")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(side: DataFrame, max_rows: int = 500_000) -> DataFrame:
    """Mark ``side`` for broadcast after counting it; leave it alone if it is large.

    The side is kept first, so the pass that builds it runs once and the count reads only
    file footers. Beyond ``max_rows`` the plain join is left to adaptive execution, which
    sorts, merges and splits skewed partitions.
    """
    side = kept(side)
    if side.count() <= max_rows:
        return F.broadcast(side)
    return side
