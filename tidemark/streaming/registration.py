"""Streams that register the natural keys they meet.

A batch first publishes the dimension rows it adds, then its result rows, each under its batch
id. If it dies before the first, nothing was seen of it and its keys are numbered again. If it
dies between the two, the retry finds the ids that were published and uses them. So an id
always means one key, and rows only name ids that are published.

One query writes a dimension; several streams that share one are to be united before.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.sources import published
from tidemark.streaming.runs import start

Plan = Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]]


def registered(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The dimension as of the last batch: the first rows and those that batches have added."""
    first = published.read(spark, f"{path}/base", schema)
    return first.unionByName(published.read(spark, f"{path}/added", schema))


def registering(plan: Plan, schema: StructType, path: str, key: Sequence[str], query: str = "registering"
                ) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer for ``plan(batch, dimension) -> (rows, whole dimension)``.

    ``key`` are the columns that tell dimension rows apart. A batch meets the dimension that
    the batches before it have published, and writes only what it adds.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        known = registered(batch.sparkSession, path, schema)
        rows, full = plan(batch, known)
        added = full.join(known.select(*key), list(key), "left_anti").select(*schema.names)
        published.publish(added, f"{path}/added", query, batch_id)
        published.publish(rows, f"{path}/rows", query, batch_id)
    return write


def register_stream(stream: DataFrame, plan: Plan, base: DataFrame, path: str, key: Sequence[str],
                    every: str | None = None) -> StreamingQuery:
    """Start writing under ``path``; starting again with the same path goes on where it ended.

    ``base`` is written once, at the first start, so that later batches meet the same ids.
    """
    published.publish(base, f"{path}/base", "base", 0)
    for part in ("added", "rows"):
        published.create(stream.sparkSession, f"{path}/{part}")
    return start(stream, path, checkpoint=f"{path}/checkpoint", every=every,
                 writer=registering(plan, base.schema, path, key))


def result(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of all published batches."""
    return published.read(spark, f"{path}/rows", schema)
