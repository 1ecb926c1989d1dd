"""Kafka as a source and sink, for clusters that have Spark's connector.

The columns are those of a log, so what reads a written log reads a topic. Values are
JSON text and are parsed with the topic's schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.log import LOG_COLUMNS


def _parsed(df: DataFrame, schema: str | None) -> DataFrame:
    if schema:
        df = df.withColumn("value", F.from_json(F.col("value").cast("string"), schema))
    return df.select(*LOG_COLUMNS)


def read_topic(spark: SparkSession, servers: str, topics: str, schema: str | None = None,
               start_ms: int | None = None, end_ms: int | None = None) -> DataFrame:
    """All messages that exist now, or those from ``start_ms`` to before ``end_ms``.

    Kafka finds the offsets of the bounds, so messages outside are not fetched.
    """
    reader = (spark.read.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("subscribe", topics).option("includeHeaders", "true"))
    reader = (reader.option("startingOffsets", "earliest") if start_ms is None
              else reader.option("startingTimestamp", start_ms))
    reader = (reader.option("endingOffsets", "latest") if end_ms is None
              else reader.option("endingTimestamp", end_ms))
    return _parsed(reader.load(), schema)


def stream_topic(spark: SparkSession, servers: str, topics: str, schema: str | None = None,
                 per_trigger: int = 5_000_000) -> DataFrame:
    reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("subscribe", topics).option("includeHeaders", "true")
              .option("startingOffsets", "earliest").option("maxOffsetsPerTrigger", per_trigger))
    return _parsed(reader.load(), schema)


def write_topic(log: DataFrame, servers: str) -> None:
    """Produce messages with their keys and topics; values become JSON text."""
    (log.select("topic", "key", F.to_json("value").alias("value"))
     .write.format("kafka").option("kafka.bootstrap.servers", servers).save())
