"""Routing records: elements, batches, grouping, flattening and topics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.operators.numbering import earlier_buckets

ELEMENTS_PER_RECORD = 20  # Fixed value: elements in one batched record.
POSITIONS_PER_BUCKET = 100_000


def element(df: DataFrame) -> Column:
    """The element struct of a row; missing communities are an empty list."""
    no_list = F.array().cast("array<string>")
    return F.struct(
        F.when(F.col("record_type") == "ribs", F.lit("R")).otherwise(F.col("elem_type")).alias("type"),
        F.col("time").alias("time"),
        F.col("peer_asn").alias("peer_asn"),
        F.col("peer_address").alias("peer_address"),
        F.struct(
            F.col("next_hop").alias("next-hop"), F.col("as_path").alias("as-path"),
            F.coalesce("communities", no_list).alias("communities"), F.col("prefix").alias("prefix"),
        ).alias("fields"))


def bgp_elements(df: DataFrame) -> DataFrame:
    """Normalised elements with their project, collector, record type and position.

    ``dump_time``, ``status`` and ``dump_position`` of the record are carried along if given.
    """
    return df.select(
        *[c for c in ("dump_time", "status", "dump_position") if c in df.columns],
        F.when(F.col("collector").contains("rrc"), "ris").otherwise("routeviews").alias("project"),
        "collector",
        F.when(F.col("record_type") == "updates", "update").otherwise("rib").alias("type"),
        F.col("record_type"), "pos", "time", element(df).alias("element"))


def batch_records(elements: DataFrame, size: int = ELEMENTS_PER_RECORD,
                  bucket: int = POSITIONS_PER_BUCKET) -> DataFrame:
    """Records of at most ``size`` consecutive elements of one time.

    Elements are taken per collector and record type in the order of ``pos``, and a record
    ends when the time changes or it is full. A stream is cut into buckets of ``bucket``
    positions; what a bucket must know of those before it (rows so far, last time, start
    of the open run) is one row per bucket.
    """
    stream = ["collector", "record_type"]
    cut = elements.withColumn("_bucket", F.floor(F.col("pos") / F.lit(bucket)))
    in_stream = Window.partitionBy(*stream).orderBy("_bucket")
    facts = cut.groupBy(*stream, "_bucket").agg(
        F.count(F.lit(1)).alias("_count"), F.max_by("time", "pos").alias("_last"))
    carried = facts.select(*stream, "_bucket", F.lag("_last").over(in_stream).alias("_last")).join(
        earlier_buckets(facts, stream), [*stream, "_bucket"])

    inside = Window.partitionBy(*stream, "_bucket").orderBy("pos")
    before = F.coalesce(F.lag("time").over(inside), F.col("_last"))
    at = F.col("_before") + F.row_number().over(inside) - 1
    placed = (
        cut.join(carried, [*stream, "_bucket"])
        .withColumn("_at", at)
        .withColumn("_start", F.when(before.isNull() | (before != F.col("time")), F.col("_at")))
    )
    starts = placed.groupBy(*stream, "_bucket").agg(F.max("_start").alias("_open"))
    open_run = starts.select(
        *stream, "_bucket",
        F.max("_open").over(in_stream.rowsBetween(Window.unboundedPreceding, -1)).alias("_open"))
    run = F.coalesce(F.max("_start").over(inside.rowsBetween(Window.unboundedPreceding, 0)), F.col("_open"))
    chunked = (
        placed.join(open_run, [*stream, "_bucket"])
        .withColumn("_run", run)
        .withColumn("_chunk", F.floor((F.col("_at") - F.col("_run")) / F.lit(size)))
    )
    return (
        chunked.groupBy("project", "collector", "type", "record_type", "time", "_run", "_chunk")
        .agg(F.min("pos").alias("pos"), F.sort_array(F.collect_list(F.struct("pos", "element"))).alias("_e"))
        .select(
            "pos", "record_type",
            F.struct("project", "collector", "type", F.col("time").alias("dump_time"), "time").alias("rec"),
            F.transform("_e", lambda e: e.getField("element")).alias("elements"))
    )


def bgp_records(elements: DataFrame, record: tuple[str, ...]) -> DataFrame:
    """Records as they were delivered, each one row with all of its elements.

    ``record`` names the columns that identify a record. ``batch_records`` makes records of
    bounded size where the delivered ones may be too large for a row.
    """
    return (
        elements.groupBy(*record)
        .agg(F.sort_array(F.collect_list(F.struct("pos", "element"))).alias("_e"))
        .select(F.struct(*record).alias("rec"), F.transform("_e", lambda e: e.getField("element")).alias("elements"))
    )


def flatten_records(records: DataFrame) -> DataFrame:
    return records.select("rec", F.explode("elements").alias("element"))


def route_topic(df: DataFrame, prefix: str = "bgp") -> DataFrame:
    """Add the topic of a record: ``<prefix>_<collector>_<record type>``."""
    return df.withColumn("topic", F.concat_ws("_", F.lit(prefix), "collector", "record_type"))


def valid_records(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(valid, rejects)`` by record status; an unset status is a reject."""
    good = F.coalesce(F.col("status") == "valid", F.lit(False))
    return df.where(good), df.where(~good)


def nonempty(records: DataFrame) -> DataFrame:
    return records.where(F.size("elements") > 0)
