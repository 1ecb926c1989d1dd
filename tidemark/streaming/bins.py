"""Aggregates per time bin, given out once the watermark has passed the bin.

A bin is closed for all partitions together when the newest time seen is ``delay`` past
it. Rows that come later are dropped and counted by the query's progress.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.operators.hegemony import counts_for_cone, peer_max, visibility
from tidemark.session import kept
from tidemark.streaming import carried


def cone_stream(rows: DataFrame, af: int, delay: str) -> DataFrame:
    """Cone sizes of the bins that are complete; ``rows`` as ``score_rows`` makes them."""
    inside = counts_for_cone(F.col("originasn_id"), F.col("asn_id"), F.col("hege"))
    sizes = (
        rows.where(F.col("originasn_id").isNotNull())
        .withWatermark("timebin", delay)
        .groupBy("timebin", "asn_id")
        .agg(F.sum(F.when(inside, 1).otherwise(0)).cast("bigint").alias("conesize"))
    )
    return sizes.select("timebin", "conesize", F.lit(af).alias("af"), "asn_id")


def moas_stream(rows: DataFrame, delay: str) -> DataFrame:
    """Whether a prefix has several origins, per complete bin."""
    return (
        rows.withWatermark("timebin", delay).groupBy("timebin", "prefix")
        .agg((F.min("originasn_id") != F.max("originasn_id")).alias("moas"))
    )


KEYS = ["timebin", "prefix", "originasn_id"]
MOST = "nb_peers int"
#: Rows of open bins, and one row without a time: the most peers of all closed bins and the newest time.
OPEN = "timebin timestamp, prefix string, originasn_id bigint, nb_peers int, newest bigint"
VISIBLE = "timebin timestamp, prefix string, originasn_id bigint, nb_peers int, peer_max int, visibility double"


def _seen_from(closed: DataFrame, handed: DataFrame) -> tuple[dict[str, DataFrame], DataFrame]:
    """Visibility in the bins that have just closed, by the most peers of these and all bins before."""
    return _seen(kept(closed), handed)


def _seen(closed: DataFrame, handed: DataFrame) -> tuple[dict[str, DataFrame], DataFrame]:
    before = handed.select(F.lit(None).cast("timestamp").alias("timebin"), "nb_peers")  # a null bin comes first
    peers = kept(peer_max(closed.select("timebin", "nb_peers").unionByName(before)))
    rows = closed.join(peers, "timebin").withColumn("visibility", visibility(F.col("nb_peers"), F.col("peer_max")))
    most = peers.groupBy().agg(F.max("peer_max").alias("nb_peers")).where("nb_peers IS NOT NULL")
    return {"visibility": rows}, most


def closing(delay: str) -> carried.Plan:
    """``_seen_from`` for the bins that a batch closes; the rows of open bins are handed on."""
    def plan(batch: DataFrame, handed: DataFrame) -> tuple[dict[str, DataFrame], DataFrame]:
        sums = handed.where("timebin IS NULL")
        late = F.coalesce(F.col("timebin") <= closed_until(sums.select("newest"), delay), F.lit(False))
        both = batch.where(~late).select(*KEYS, "nb_peers").unionByName(
            handed.where("timebin IS NOT NULL").select(*KEYS, "nb_peers"))
        rows = kept(both.groupBy(*KEYS).agg(F.max("nb_peers").cast("int").alias("nb_peers")))
        newest = kept(rows.select(F.unix_micros("timebin").alias("newest")).unionByName(sums.select("newest")).groupBy().agg(
            F.max("newest").alias("newest")).where("newest IS NOT NULL"))
        is_closed = F.col("timebin") <= closed_until(newest, delay)
        found, most = _seen(rows.where(is_closed), sums.where("nb_peers IS NOT NULL").select("nb_peers"))
        still = rows.where(~is_closed).unionByName(newest.join(most, F.lit(True), "left"), allowMissingColumns=True)
        return found, still.select(*KEYS, "nb_peers", "newest")
    return plan


def visibility_stream(rows: DataFrame, path: str, delay: str, every: str | None = None) -> StreamingQuery:
    """Start writing, for complete bins, how much of the peers sees each prefix and origin.

    ``rows`` has ``timebin, prefix, originasn_id, nb_peers``; of several counts of one bin the largest
    holds. A bin is closed by the batch that brings a time ``delay`` past it, and later rows of it are left
    out. Only the rows of open bins, the most peers of all closed bins, which is never reset, and the newest
    time go from batch to batch; what a batch closes is in no state. Rows without a time are left out.
    """
    return carried.carry_stream(rows.where(F.col("timebin").isNotNull()), closing(delay), OPEN, path, every=every)


def visible(spark: SparkSession, path: str) -> DataFrame:
    """The visibility in all bins that are closed."""
    return carried.result(spark, path, "visibility", VISIBLE)


NEWEST = "newest bigint"  # in microseconds


def closed_until(newest: DataFrame, delay: str) -> Column:
    """The last time that is closed, from the newest one seen: one value. Null if none was."""
    row = newest.head()
    return F.timestamp_micros(F.lit(row["newest"] if row else None).cast("bigint")) - F.expr(f"INTERVAL {delay}")


def by_lateness(time: str, delay: str) -> carried.Plan:
    """``on_time`` and ``late`` rows: late ones lie ``delay`` or more behind a row of an earlier batch.

    Every row is in one of the two; one without a time is on time.
    """
    def plan(batch: DataFrame, handed: DataFrame) -> tuple[dict[str, DataFrame], DataFrame]:
        late = F.coalesce(F.col(time) <= closed_until(handed, delay), F.lit(False))
        seen = batch.select(F.unix_micros(time).alias("newest")).unionByName(handed).groupBy().agg(F.max("newest").alias("newest"))
        return {"on_time": batch.where(~late), "late": batch.where(late)}, seen.where("newest IS NOT NULL")
    return plan


def lateness_stream(rows: DataFrame, path: str, delay: str, time: str = "timebin", every: str | None = None) -> StreamingQuery:
    """Start sorting a stream's rows into ``on_time`` and ``late`` tables under ``path``.

    Rows that a watermark would drop and only count are kept as an output.
    """
    return carried.carry_stream(rows, by_lateness(time, delay), NEWEST, path, every=every)


def complete(spark: SparkSession, path: str, schema: StructType, delay: str, time: str = "timebin") -> DataFrame:
    """The rows that were on time, of the bins that are closed. No later batch adds to these bins,
    so any aggregate of them is final."""
    closed = closed_until(carried.left(spark, path, NEWEST), delay)
    return carried.result(spark, path, "on_time", schema).where(F.col(time) <= closed)
