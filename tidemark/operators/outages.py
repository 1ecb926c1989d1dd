"""Outage events: bursts of disconnected probes and their reconnections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.clock import from_epoch_s

MIN_OUTAGE_S = 300  # Fixed value: shorter outages are removed.
EVENT = ["streamtype", "streamname", "starttime"]


def _event_key() -> list[Column]:
    return [F.lower("streamtype").alias("streamtype"), F.col("streamname").cast("string").alias("streamname"),
            from_epoch_s(F.col("starttime")).alias("starttime")]


def burst_events(bursts: DataFrame) -> DataFrame:
    """An open event per burst; its end is its start until it is known."""
    return bursts.select(
        *_event_key(), from_epoch_s(F.col("starttime")).alias("endtime"),
        F.col("level").alias("avglevel"), "totalprobes",
        F.size("probelist").alias("nbdiscoprobes"), F.lit(True).alias("ongoing"))


def event_reconnects(reconnects: DataFrame, min_s: int = MIN_OUTAGE_S) -> DataFrame:
    """One row per event key: whether any reconnect is short, and the last long one."""
    short = F.try_subtract("endtime", "starttime") < min_s
    long_end = F.when(~short, F.struct(from_epoch_s(F.col("endtime")).alias("endtime"), "reconnectedprobes"))
    rows = reconnects.select(*_event_key(), short.alias("_short"), long_end.alias("_long"),
                             F.when(~short, F.col("offset")).alias("_at"))
    return rows.groupBy(*EVENT).agg(
        F.max("_short").alias("short"), F.max_by("_long", "_at").alias("last"))


def outage_events(bursts: DataFrame, reconnects: DataFrame, min_s: int = MIN_OUTAGE_S) -> DataFrame:
    """Events after reconnection: short ones are gone, long ones closed, others open."""
    ends = event_reconnects(reconnects, min_s)
    joined = burst_events(bursts).join(ends, EVENT, "left").where(~F.coalesce("short", F.lit(False)))
    return joined.select(
        *EVENT, F.coalesce("last.endtime", "endtime").alias("endtime"), "avglevel", "totalprobes",
        "nbdiscoprobes", F.col("last").isNull().alias("ongoing"))


def outage_probes(bursts: DataFrame, reconnects: DataFrame, probes: DataFrame,
                  min_s: int = MIN_OUTAGE_S) -> DataFrame:
    """The known probes of each remaining event, with the end of their own outage."""
    started = bursts.select(*_event_key(), "level", F.explode("probelist").alias("probe_id", "_start"))
    ends = event_reconnects(reconnects, min_s)
    short = ends.where(F.col("short")).select(*EVENT)
    back = ends.where(~F.col("short")).select(
        *EVENT, F.explode("last.reconnectedprobes").alias("probe_id", "_end"))
    known = probes.select(
        F.col("id").alias("probe_id"), F.col("address_v4").alias("ipv4"), F.col("prefix_v4").alias("prefixv4"),
        F.get("coordinates", F.lit(1)).alias("lat"), F.get("coordinates", F.lit(0)).alias("lon"))
    return (
        started.join(short, EVENT, "left_anti")
        .join(known, "probe_id")
        .join(back, [*EVENT, "probe_id"], "left")
        .select(
            *[F.col(c) if c != "starttime" else F.col(c).alias("event_starttime") for c in EVENT], "probe_id",
            from_epoch_s(F.col("_start")).alias("starttime"),
            from_epoch_s(F.coalesce("_end", "_start")).alias("endtime"),
            "level", "ipv4", "prefixv4", "lat", "lon")
    )


def unmatched_reconnects(bursts: DataFrame, reconnects: DataFrame, min_s: int = MIN_OUTAGE_S) -> DataFrame:
    """Long reconnects that have no event. A short one without an event is no error."""
    long = reconnects.where(F.try_subtract("endtime", "starttime") >= min_s)
    keyed = long.select(*_event_key(), from_epoch_s(F.col("endtime")).alias("endtime"), "offset")
    return keyed.join(bursts.select(*_event_key()), EVENT, "left_anti")


def outages(bursts: DataFrame, reconnects: DataFrame, probes: DataFrame, min_s: int = MIN_OUTAGE_S
            ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(events, probes, unmatched)``."""
    return (outage_events(bursts, reconnects, min_s), outage_probes(bursts, reconnects, probes, min_s),
            unmatched_reconnects(bursts, reconnects, min_s))
