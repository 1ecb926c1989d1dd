"""Score rows per time bin: cones, multiple origins, peers and bin statistics.

Rows of AS scores have ``timestamp`` (epoch seconds), ``scope``, ``asn`` and ``hege``. A
bin is all rows of one timestamp.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.clock import from_epoch_s
from tidemark.functions.identifiers import as_set_members, asn as asn_number, global_scope

MIN_SAMPLES = 10  # Fixed value: least number of peers behind a traceroute score.


def payload_range(df: DataFrame, column: str, start: int | None = None, end: int | None = None) -> DataFrame:
    """Rows whose payload time, in epoch seconds, lies in ``[start, end)``."""
    if start is not None:
        df = df.where(F.col(column) >= F.lit(start))
    if end is not None:
        df = df.where(F.col(column) < F.lit(end))
    return df


def expand_as_set(df: DataFrame, column: str, out: str | None = None) -> DataFrame:
    """One row per valid AS number of a column that may hold sets such as ``{1,2}``."""
    out = out or column
    return (
        df.withColumn("_member", F.explode(as_set_members(F.col(column))))
        .withColumn(out, asn_number(F.col("_member")))
        .where(F.col(out).isNotNull())
        .drop("_member")
    )


def score_rows(df: DataFrame, time_col: str = "timestamp", start: int | None = None,
               end: int | None = None) -> DataFrame:
    """Typed rows ``timebin, originasn_id, asn_id, hege``; AS sets become one row each."""
    typed = payload_range(df, time_col, start, end).select(
        from_epoch_s(F.col(time_col)).alias("timebin"),
        global_scope(F.col("scope")).alias("originasn_id"),
        F.col("asn").alias("_asn"),
        F.col("hege").cast("double").alias("hege"))
    return expand_as_set(typed, "_asn", "asn_id").select("timebin", "originasn_id", "asn_id", "hege")


def counts_for_cone(origin: Column, asn: Column, hege: Column) -> Column:
    return ~origin.isin(0, -1) & (asn != origin) & (hege != 0)


def cone(rows: DataFrame, af: int, distinct: bool = False) -> DataFrame:
    """Cone size per bin and AS: the rows in which it carries another origin's traffic.

    ASes with an empty cone get a row with 0. With ``distinct`` origins are counted once
    and empty cones are left out.
    """
    rows = rows.where(F.col("originasn_id").isNotNull())
    inside = counts_for_cone(F.col("originasn_id"), F.col("asn_id"), F.col("hege"))
    if distinct:
        rows = rows.where(inside).groupBy("timebin", "asn_id")
        sizes = rows.agg(F.count_distinct("originasn_id").alias("conesize"))
    else:
        sizes = rows.groupBy("timebin", "asn_id").agg(
            F.sum(F.when(inside, 1).otherwise(0)).cast("bigint").alias("conesize"))
    return sizes.select("timebin", "conesize", F.lit(af).alias("af"), "asn_id")


def moas(rows: DataFrame) -> DataFrame:
    """Per bin and prefix whether it has several origins, over all rows.

    The smallest and largest origin differ exactly if there are several, so no distinct
    sets are gathered or shuffled.
    """
    return rows.groupBy("timebin", "prefix").agg(
        (F.min("originasn_id") != F.max("originasn_id")).alias("moas"))


def peer_max(rows: DataFrame) -> DataFrame:
    """Per bin the most peers seen so far, at least 1. One row per bin is windowed."""
    so_far = Window.orderBy("timebin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bins = rows.groupBy("timebin").agg(F.max("nb_peers").alias("_most"))
    return bins.select("timebin", F.greatest(F.max("_most").over(so_far), F.lit(1)).cast("int").alias("peer_max"))


def visibility(nb_peers: Column, most: Column) -> Column:
    return F.lit(100.0) * nb_peers / most


def _at_bin(messages: DataFrame, bin_start) -> DataFrame:
    return messages.where(F.col("timestamp") == F.lit(bin_start).cast("timestamp"))


def bin_stats(messages: DataFrame, bin_start) -> DataFrame:
    """Counts for one exact bin of messages ``(scope, scope_hegemony)``.

    Messages, scopes, ASes, pairs of both, and the size of the global graph (scope -1).
    """
    picked = _at_bin(messages, bin_start)
    pairs = picked.select(
        "partition", "offset", "scope", F.explode_outer(F.map_keys("scope_hegemony")).alias("asn"))
    return pairs.agg(
        F.count_distinct("partition", "offset").alias("nb_messages"),
        F.count_distinct("scope").alias("nb_scopes"),
        F.count_distinct("asn").alias("nb_asns"),
        F.count_distinct("scope", "asn").alias("nb_pairs"),
        F.count_if((F.col("scope") == "-1") & F.col("asn").isNotNull()).alias("global_graph_size"))


def bin_scopes_by_partition(messages: DataFrame, bin_start) -> DataFrame:
    return _at_bin(messages, bin_start).groupBy("partition").agg(F.count_distinct("scope").alias("nb_scopes"))

