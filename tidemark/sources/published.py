"""Tables whose files count once a manifest entry names them.

An append writes its files into a folder of its own. Only then one entry, a single small file,
names the folder under ``(query, batch)``. What a killed append leaves is named by nothing and
read by nobody, and a batch that is tried again after its entry stands writes nothing. Folders
that are replaced stay for readers that have begun; the cluster may expire them.

One writer at a time may hold a ``query`` name; writers of different names do not meet.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

ENTRY = "query string, batch bigint, folder string, rows bigint, replaces array<string>"
COMPACTION = "compaction"


class Written(NamedTuple):
    """What an append did; ``fresh`` is false if its batch had been published before."""

    rows: int
    seconds: float
    fresh: bool

    @property
    def rate(self) -> float:
        """Rows a second."""
        return self.rows / self.seconds if self.seconds else 0.0


def observed(df: DataFrame, write: Callable[[DataFrame], None]) -> Written:
    """Run ``write`` on ``df`` and count its rows in the same pass."""
    seen, start = Observation(), time.monotonic()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return Written(seen.get.get("rows", 0), time.monotonic() - start, True)


def _entry(spark: SparkSession, query: str, batch: int, folder: str, rows: int, replaces: Sequence[str]) -> DataFrame:
    texts = F.array(*[F.lit(f) for f in replaces]).cast("array<string>")
    return spark.range(1, numPartitions=1).select(
        F.lit(query).alias("query"), F.lit(batch).cast("bigint").alias("batch"), F.lit(folder).alias("folder"),
        F.lit(rows).cast("bigint").alias("rows"), texts.alias("replaces"))


def create(spark: SparkSession, path: str) -> None:
    """Make an empty table where there is none."""
    entry = _entry(spark, "", 0, "", 0, ()).where("false")
    entry.write.mode("ignore").parquet(f"{path}/manifest/none")


def entries(spark: SparkSession, path: str) -> DataFrame:
    """The manifest, one row per ``(query, batch)``; a batch is a few dozen bytes, so one task reads it."""
    found = spark.read.schema(ENTRY).option("recursiveFileLookup", "true").parquet(f"{path}/manifest")
    return found.coalesce(1).groupBy("query", "batch").agg(
        F.min(F.struct("folder", "rows", "replaces")).alias("_e")).select("query", "batch", "_e.*")


def live_folders(spark: SparkSession, path: str) -> list[str]:
    """The folders that make up the table now: named, not empty and not replaced.

    They are the roots that Spark has to list, one a batch since the last ``compact``.
    """
    named = entries(spark, path).agg(
        F.collect_list(F.when(F.col("rows") > 0, F.col("folder"))).alias("full"),
        F.flatten(F.collect_list("replaces")).alias("gone"))
    rows = named.select(F.explode(F.array_except("full", "gone")).alias("folder")).collect()
    return sorted(r["folder"] for r in rows)


def _read(spark: SparkSession, base: str, folders: Sequence[str], schema: StructType | str) -> DataFrame:
    wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if not folders:
        return spark.createDataFrame([], wanted)
    found = spark.read.schema(StructType([*wanted.fields, StructField("part", StringType())])).option("basePath", base).parquet(
        *[f"{base}/part={f}" for f in folders])
    return found.drop("part")


def read(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The rows of all published batches; ``schema`` includes the columns of the folders."""
    return _read(spark, f"{path}/data", live_folders(spark, path), schema)


def read_batch(spark: SparkSession, path: str, schema: StructType | str, query: str, batch: int) -> DataFrame:
    """The rows that one batch of ``query`` has published; none if it has not."""
    wanted = (F.col("query") == query) & (F.col("batch") == batch) & (F.col("rows") > 0)
    found = entries(spark, path).where(wanted).head()
    return _read(spark, f"{path}/data", [found["folder"]] if found else [], schema)


def read_index(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The index rows of all published batches."""
    return _read(spark, f"{path}/index", live_folders(spark, path), schema)


def _publish(df: DataFrame, path: str, query: str, batch: int, partition_by: Sequence[str],
             index: Callable[[DataFrame], DataFrame] | None, replaces: Sequence[str]) -> Written:
    spark, folder = df.sparkSession, uuid.uuid4().hex
    data = f"{path}/data/part={folder}"
    done = observed(df, lambda rows: rows.write.partitionBy(*partition_by).parquet(data))
    if index is not None and done.rows:
        index(spark.read.schema(df.schema).parquet(data)).write.parquet(f"{path}/index/part={folder}")
    _entry(spark, query, batch, folder, done.rows, replaces).write.parquet(f"{path}/manifest/{folder}")
    return done


def publish(df: DataFrame, path: str, query: str, batch: int, partition_by: Sequence[str] = (),
            index: Callable[[DataFrame], DataFrame] | None = None) -> Written:
    """Append ``df`` as the batch ``batch`` of ``query``, once however often it is called.

    ``index`` makes index rows from the written ones; they are published by the same entry.
    How rows lie in files is the caller's: bring rows of one folder together before.
    """
    create(df.sparkSession, path)
    known = entries(df.sparkSession, path).where((F.col("query") == query) & (F.col("batch") == batch)).head()
    if known is not None:
        return Written(known["rows"], 0.0, False)
    return _publish(df, path, query, batch, partition_by, index, ())


def compact(spark: SparkSession, path: str, schema: StructType | str, partition_by: Sequence[str] = (),
            arrange: Callable[[DataFrame], DataFrame] | None = None,
            index: Callable[[DataFrame], DataFrame] | None = None) -> Written | None:
    """Write the table's folders as one and swap them by a single entry.

    Batches published meanwhile stay as they are. ``arrange`` decides how rows lie in files;
    without it those of one folder are brought together, and adaptive execution cuts large ones.
    """
    old = live_folders(spark, path)
    if len(old) < 2:
        return None
    rows = _read(spark, f"{path}/data", old, schema)
    if arrange is not None:
        rows = arrange(rows)
    else:
        rows = rows.hint("rebalance", *partition_by)
    last = entries(spark, path).where(F.col("query") == COMPACTION).agg(F.max("batch").alias("b")).head()["b"]
    return _publish(rows, path, COMPACTION, 0 if last is None else last + 1, partition_by, index, old)


def append_table_once(df: DataFrame, path: str, columns: Sequence[str], query: str, batch: int,
                      date_from: str | None = "timebin") -> Written:
    """Append the named columns to a published table, in folders by the date of ``date_from``.

    Rows of one day are brought together, so a day's files grow with its rows, not with tasks.
    """
    out = df.select(*columns)
    if date_from is None:
        return publish(out, path, query, batch)
    dated = out.withColumn("date", F.to_date(date_from)).hint("rebalance", "date")
    return publish(dated, path, query, batch, ["date"])
