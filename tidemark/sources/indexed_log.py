"""A published log with an index of its files, for reads from either end.

The index has a row per file and log partition: the least and largest offset and time, and the
count. Reads of the ends open only the files that the index names; offsets come from the
index alone. Files hold neighbouring offsets, so few of them overlap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import DateType, StructField, StructType

from tidemark.operators import log as logs
from tidemark.sources import published

ZONES = ("file string, topic string, partition int, low bigint, high bigint, first timestamp, last timestamp, "
         "messages bigint")
ORDER = ["topic", "date", "partition", "offset"]


def _file() -> Column:
    """A file's place below the table, the same wherever the table lies."""
    return F.regexp_extract("_metadata.file_path", r"/data/(part=.+)$", 1)


def zones_of(written: DataFrame) -> DataFrame:
    """The index rows of some files; only partition, offset and time are read."""
    return written.groupBy(_file().alias("file"), "topic", "partition").agg(
        F.min("offset").alias("low"), F.max("offset").alias("high"), F.min("timestamp").alias("first"),
        F.max("timestamp").alias("last"), F.count(F.lit(1)).alias("messages"))


def _arranged(log: DataFrame) -> DataFrame:
    """Ranges of topic, day, partition and offset: a hot partition is cut over many tasks."""
    return log.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)


def _schema(schema: StructType) -> StructType:
    return schema if "date" in schema.names else StructType([*schema.fields, StructField("date", DateType())])


def append(log: DataFrame, path: str, query: str, batch: int) -> published.Written:
    """Append messages once per ``(query, batch)``, with their index."""
    dated = log.withColumn("date", F.to_date("timestamp"))
    return published.publish(_arranged(dated), path, query, batch, ["topic", "date"], zones_of)


def compact(spark: SparkSession, path: str, schema: StructType) -> published.Written | None:
    """Write small batches as one, and their index."""
    return published.compact(spark, path, _schema(schema), ["topic", "date"], _arranged, zones_of)


def read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All messages; ``topic`` and ``date`` prune folders, so ranges of time are read this way."""
    return published.read(spark, path, _schema(schema))


def zones(spark: SparkSession, path: str) -> DataFrame:
    return published.read_index(spark, path, ZONES)


def holding(zones: DataFrame, n: int, last: bool) -> DataFrame:
    """The index rows of files that may hold the first or last ``n`` messages of a log partition.

    Zones whose largest offsets are least are added up until they count ``n``. No later message
    is among the first ``n``, so a file is left out if it starts after them. The other end is
    the same with signs turned.
    """
    if n <= 0:
        raise ValueError("n must be positive")
    near, far = (-F.col("high"), -F.col("low")) if last else (F.col("low"), F.col("high"))
    group = Window.partitionBy("topic", "partition")
    upto = group.orderBy("_far").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    counted = zones.withColumn("_near", near).withColumn("_far", far).withColumn("_sum", F.sum("messages").over(upto))
    limit = F.coalesce(F.min(F.when(F.col("_sum") >= n, F.col("_far"))).over(group), F.max("_far").over(group))
    return counted.withColumn("_limit", limit).where("_near <= _limit").select(*zones.columns)


def _end(spark: SparkSession, path: str, schema: StructType, n: int, last: bool, partition: int | None) -> DataFrame:
    known = zones(spark, path)
    if partition is not None:
        known = known.where(F.col("partition") == partition)
    # About one or two files per log partition where n is small next to a file.
    names = [r["file"] for r in holding(known, n, last).select("file").distinct().collect()]
    found = read(spark, path, schema)
    found = found.where(_file().isin(names)) if names else found.where(F.lit(False))
    found = found.drop("date")
    return logs.tail(found, n, partition) if last else logs.head(
        found if partition is None else found.where(F.col("partition") == partition), n)


def tail(spark: SparkSession, path: str, schema: StructType, n: int = 1, partition: int | None = 0) -> DataFrame:
    """The last ``n`` messages of one partition of each topic, or of all with ``None``."""
    return _end(spark, path, schema, n, True, partition)


def head(spark: SparkSession, path: str, schema: StructType, n: int = 1, partition: int | None = None) -> DataFrame:
    """The first ``n`` messages of every log partition, or of one."""
    return _end(spark, path, schema, n, False, partition)


def latest(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The last message of every log partition."""
    return tail(spark, path, schema, 1, None)


def offsets(spark: SparkSession, path: str) -> DataFrame:
    """Low and high watermark per log partition; no message is read."""
    return zones(spark, path).groupBy("topic", "partition").agg(
        F.min("low").alias("low"), (F.max("high") + 1).alias("high"))


def seek(spark: SparkSession, path: str, at) -> DataFrame:
    """Per log partition an offset with no message at or after ``at`` before it.

    It is the least offset of the zones that reach to ``at``, or one past the end.
    """
    when = F.lit(at).cast("timestamp")
    low = F.min(F.when(F.col("last") >= when, F.col("low")))
    return zones(spark, path).groupBy("topic", "partition").agg(
        F.coalesce(low, F.max("high") + 1).alias("offset"))
