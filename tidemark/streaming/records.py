"""Routing records in streams: batches that go on from file to file, and rejects apart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.bgp import ELEMENTS_PER_RECORD, POSITIONS_PER_BUCKET, batch_records, valid_records
from tidemark.session import kept
from tidemark.streaming import carried

FEED = ["collector", "record_type"]


def closing_records(size: int = ELEMENTS_PER_RECORD, bucket: int = POSITIONS_PER_BUCKET) -> carried.Plan:
    """Records that are complete, and the elements of those that are not.

    Per collector and record type only the last record can go on, and only if it is not full,
    so fewer than ``size`` elements a feed are handed on. As that record begins where a full
    one may begin, what follows is cut as if nothing had come in between. Positions are
    unique in a feed and ascend from batch to batch.
    """
    def plan(batch: DataFrame, handed: DataFrame) -> tuple[dict[str, DataFrame], DataFrame]:
        elements = batch.unionByName(handed)
        records = kept(batch_records(elements, size, bucket).withColumn("collector", F.col("rec.collector")))
        last = records.groupBy(*FEED).agg(F.max("pos").alias("pos"), F.max_by(F.size("elements"), "pos").alias("n"))
        going_on = kept(last.where(F.col("n") < size).drop("n"))
        begins = going_on.withColumnRenamed("pos", "_from")
        still = elements.join(begins, FEED).where(F.col("pos") >= F.col("_from")).select(*batch.columns)
        return {"records": records.join(going_on, [*FEED, "pos"], "left_anti").drop("collector")}, still
    return plan


def batch_stream(elements: DataFrame, path: str, size: int = ELEMENTS_PER_RECORD, every: str | None = None,
                 bucket: int = POSITIONS_PER_BUCKET) -> StreamingQuery:
    """Start ``batch_records`` over a stream of ``bgp_elements``, written under ``path``."""
    return carried.carry_stream(elements, closing_records(size, bucket), elements.schema, path, every=every)


def batched(spark: SparkSession, path: str, elements: DataFrame, size: int = ELEMENTS_PER_RECORD,
            ended: bool = False) -> DataFrame:
    """The records written so far; with ``ended`` also those that no more elements will come for.

    ``elements`` gives the columns that the stream has.
    """
    done = carried.result(spark, path, "records", batch_records(elements.limit(0), size).schema)
    if not ended:
        return done
    return done.unionByName(batch_records(carried.left(spark, path, elements.schema), size))


def sorted_out(split: Callable[[DataFrame], tuple[DataFrame, DataFrame]] = valid_records) -> carried.Plan:
    """What ``split`` accepts as ``valid`` and the rest as ``rejects``; nothing is handed on but a count."""
    def plan(batch: DataFrame, handed: DataFrame) -> tuple[dict[str, DataFrame], DataFrame]:
        good, bad = split(batch)
        seen = batch.groupBy().agg(F.count(F.lit(1)).alias("seen")).unionByName(handed)
        return {"valid": good, "rejects": bad}, seen.groupBy().agg(F.sum("seen").alias("seen"))
    return plan


def valid_stream(records: DataFrame, path: str, every: str | None = None) -> StreamingQuery:
    """Start sorting a stream of records into ``valid`` and ``rejects`` under ``path``.

    Both are published under the batch's id; a batch that fails between the two leaves each once.
    """
    return carried.carry_stream(records, sorted_out(), "seen bigint", path, every=every)
