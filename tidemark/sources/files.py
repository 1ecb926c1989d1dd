"""Logs, dumps and result tables as Parquet."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators import log as logs
from tidemark.sources.published import Written, observed


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """A log written by ``write_log``; ``topic`` and ``date`` prune folders."""
    return spark.read.parquet(path)


def write_log(log: DataFrame, path: str, mode: str = "append") -> Written:
    """Write messages in folders by topic and date; returns their count and rate, of the same pass.

    Rows of one topic and day are brought together, and adaptive execution cuts those that
    are large over many tasks, so files have a moderate size however a log is spread.
    """
    dated = log.withColumn("date", F.to_date("timestamp"))
    # Counted after the exchange: tasks before it may run again when an executor is lost.
    return observed(dated.hint("rebalance", "topic", "date"),
                    lambda rows: rows.write.mode(mode).partitionBy("topic", "date").parquet(path))


def append_table(df: DataFrame, path: str, columns: Sequence[str], date_from: str | None = "timebin",
                 mode: str = "append") -> None:
    """Append the named columns to a table, in folders by the date of ``date_from``."""
    out = df.select(*columns)
    if date_from is None:
        out.write.mode(mode).parquet(path)
    else:
        out.withColumn("date", F.to_date(date_from)).write.mode(mode).partitionBy("date").parquet(path)


def append_jdbc(df: DataFrame, url: str, table: str, columns: Sequence[str], batch_rows: int = 10_000,
                connections: int = 16, **options: str) -> None:
    """Append to a database table over at most ``connections`` connections."""
    (df.select(*columns).coalesce(connections).write.format("jdbc").mode("append")
     .option("url", url).option("dbtable", table).option("batchsize", batch_rows).options(**options).save())


def dump_log(log: DataFrame, path: str, name: str, start=None, end=None, at=None,
             config: Mapping[str, str] | None = None, replication_factor: int = 1) -> DataFrame:
    """Write the messages and the one-row manifest of a dump; returns the manifest."""
    picked = logs.create_time_only(logs.scan_log(log, start=start, end=end, at=at))
    picked.select(*logs.LOG_COLUMNS).write.mode("errorifexists").parquet(f"{path}/messages")
    spark = log.sparkSession
    written = spark.read.parquet(f"{path}/messages")
    logs.manifest(written, name, start, end, at, config, replication_factor).coalesce(1).write.parquet(
        f"{path}/manifest")
    return spark.read.parquet(f"{path}/manifest")


def restore_log(spark: SparkSession, path: str, topic: str | None = None, start=None, end=None,
                partitions: int | None = None) -> DataFrame:
    """The messages of a dump, with topic name and partition count as asked for."""
    return logs.restored(spark.read.parquet(f"{path}/messages"), topic, start, end, partitions)


def restored_config(manifest: DataFrame, overrides: Mapping[str, str] | None = None, use_default: bool = False
                    ) -> DataFrame:
    """The manifest with its topic settings: the dump's (or none), then the user's."""
    user = F.map_from_arrays(
        F.array(*[F.lit(k) for k in (overrides or {})]).cast("array<string>"),
        F.array(*[F.lit(str(v)) for v in (overrides or {}).values()]).cast("array<string>"))
    base = F.create_map().cast("map<string,string>") if use_default else F.col("config")
    kept = F.map_filter(base, lambda k, v: ~F.map_contains_key(user, k))
    return manifest.withColumn("config", F.map_concat(kept, user))


def publish_snapshot(new: DataFrame, old: DataFrame, path: str, tolerance: int = 4000) -> None:
    """Write the accepted snapshot to a new version path; the old one is left in place."""
    logs.replace_if_not_shrunk(new, old, tolerance).write.mode("errorifexists").parquet(path)


def read_extract(spark: SparkSession, path: str, fmt: str = "json", schema: str | None = None) -> DataFrame:
    """An extract table with only the rows whose status is ok."""
    from tidemark.operators.exchange import read_ok

    reader = spark.read.format(fmt)
    return read_ok((reader.schema(schema) if schema else reader).load(path))
