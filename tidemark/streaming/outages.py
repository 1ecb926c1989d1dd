"""Outage events from two streams, bursts and reconnects, followed event by event.

Each event has its own state: its burst, its last long reconnection and whether a short one
came. Whatever order messages come in, a batch gives out the events it touches, as an upsert
or a delete. A reconnection that comes before its burst waits in the state. Batches own their
folder, so a retried batch leaves the same changes once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.clock import from_epoch_s
from tidemark.operators import outages
from tidemark.streaming.runs import append_once, start, use_rocksdb

KEY = ["streamtype", "streamname", "starttime"]


def _messages(stream: DataFrame, keep: str | None, burst: Column | None = None, short: Column | None = None,
              end: Column | None = None, at: Column | None = None) -> DataFrame:
    named = {"burst": (burst, "struct<level: double, totalprobes: bigint, probes: array<bigint>, starts: array<bigint>>"),
             "short": (short, "boolean"),
             "end": (end, "struct<endtime: bigint, probes: array<bigint>, ends: array<bigint>>"), "at": (at, "bigint")}
    found = stream.select(
        F.lower("streamtype").alias("streamtype"), F.col("streamname").cast("string").alias("streamname"),
        from_epoch_s(F.col("starttime")).alias("starttime"),
        *[(F.lit(None) if c is None else c).cast(t).alias(n) for n, (c, t) in named.items()])
    found = found.where(F.col("starttime").isNotNull())
    return found.withWatermark("starttime", keep) if keep else found


def changes(bursts: DataFrame, reconnects: DataFrame, min_s: int = outages.MIN_OUTAGE_S,
            keep: str | None = None) -> DataFrame:
    """``op`` (upsert, delete) and the event as it is now, for each event that a batch touches.

    A short reconnection ends an event for good; of long ones the one with the largest offset
    counts, and of several bursts of one key the smallest. Messages whose start is out of range
    are left out. With ``keep`` an event's state goes, and later messages for it are dropped,
    once all events are that much younger; without it state is kept for good.
    """
    use_rocksdb(bursts.sparkSession)
    lasted = F.try_subtract("endtime", "starttime")
    long = lasted >= min_s
    opened = _messages(bursts, keep, burst=F.struct(
        F.col("level"), F.col("totalprobes"), F.map_keys("probelist"), F.map_values("probelist")))
    closed = _messages(reconnects, keep, short=lasted < min_s, end=F.when(long, F.struct(
        F.col("endtime"), F.map_keys("reconnectedprobes"), F.map_values("reconnectedprobes"))),
        at=F.when(long, F.coalesce("offset", F.lit(-1))))
    state = opened.unionByName(closed).groupBy(*KEY).agg(
        F.min("burst").alias("burst"), F.coalesce(F.max("short"), F.lit(False)).alias("short"), F.max_by("end", "at").alias("end"))
    return state.where(F.col("burst").isNotNull()).select(
        *KEY, F.when(F.col("short"), "delete").otherwise("upsert").alias("op"), "burst", "end")


def follow(bursts: DataFrame, reconnects: DataFrame, path: str, every: str | None = None,
           min_s: int = outages.MIN_OUTAGE_S, keep: str | None = None) -> StreamingQuery:
    """Start writing ``changes`` under ``path``, a folder per batch."""
    return start(changes(bursts, reconnects, min_s, keep), f"{path}/changes", checkpoint=f"{path}/checkpoint",
                 mode="update", every=every, writer=append_once(f"{path}/changes"))


def latest(spark: SparkSession, path: str) -> DataFrame:
    """Each event as its last change left it, unless that was a delete."""
    found = spark.read.parquet(f"{path}/changes")
    newest = found.groupBy(*KEY).agg(F.max_by(F.struct("op", "burst", "end"), "batch").alias("_e"))
    return newest.select(*KEY, "_e.*").where("op = 'upsert'").drop("op")


def current_events(spark: SparkSession, path: str) -> DataFrame:
    """The event table as of the last batch."""
    return latest(spark, path).select(
        *KEY, F.coalesce(from_epoch_s(F.col("end.endtime")), "starttime").alias("endtime"),
        F.col("burst.level").alias("avglevel"), F.col("burst.totalprobes").alias("totalprobes"),
        F.size("burst.probes").alias("nbdiscoprobes"), F.col("end").isNull().alias("ongoing"))


def current_probes(spark: SparkSession, path: str, probes: DataFrame) -> DataFrame:
    """The known probes of the events of the last batch, with the end of their own outage."""
    own = F.map_from_arrays("end.probes", "end.ends")
    each = latest(spark, path).select(
        *KEY, F.col("burst.level").alias("level"), F.explode(F.arrays_zip("burst.probes", "burst.starts")).alias("p"), own.alias("own"))
    known = probes.select(
        F.col("id").alias("probe_id"), F.col("address_v4").alias("ipv4"), F.col("prefix_v4").alias("prefixv4"),
        F.get("coordinates", F.lit(1)).alias("lat"), F.get("coordinates", F.lit(0)).alias("lon"))
    end = F.coalesce(F.try_element_at("own", F.col("p.probes")), F.col("p.starts"))
    return each.join(known, F.col("p.probes") == F.col("probe_id")).select(
        "streamtype", "streamname", F.col("starttime").alias("event_starttime"), "probe_id",
        from_epoch_s(F.col("p.starts")).alias("starttime"), from_epoch_s(end).alias("endtime"), "level", "ipv4", "prefixv4",
        "lat", "lon")
