"""Streams in which a batch hands something small on to the next one.

What is handed on is a DataFrame, published under the batch's id like the rows are. A batch reads
what the batch just before it has left and never its own, so one that dies at any point and is
tried again sees the same and leaves the same, once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.sources import published
from tidemark.streaming.runs import start

#: ``plan(batch, carried) -> (named results, what the next batch is given)``
Plan = Callable[[DataFrame, DataFrame], tuple[dict[str, DataFrame], DataFrame]]
QUERY = "carrying"


def carrying(plan: Plan, schema: StructType | str, path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer for ``plan``; ``schema`` is that of what is handed on.

    Each named result is a published table under ``path``. What is handed on should not grow
    with the stream. It is published last, so that the next batch finds it only when all
    results of this one are there.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark, carried = batch.sparkSession, f"{path}/carried"
        published.create(spark, carried)
        results, handed = plan(batch, published.read_batch(spark, carried, schema, QUERY, batch_id - 1))
        for name, rows in results.items():
            published.publish(rows, f"{path}/{name}", QUERY, batch_id)
        published.publish(handed, carried, QUERY, batch_id)
    return write


def carry_stream(stream: DataFrame, plan: Plan, schema: StructType | str, path: str, mode: str = "append",
                 every: str | None = None) -> StreamingQuery:
    """Start ``plan`` over ``stream``; starting again with the same path goes on where it ended."""
    return start(stream, path, checkpoint=f"{path}/checkpoint", mode=mode, every=every, writer=carrying(plan, schema, path))


def result(spark: SparkSession, path: str, name: str, schema: StructType | str) -> DataFrame:
    """The rows of one named result, of all published batches."""
    published.create(spark, f"{path}/{name}")
    return published.read(spark, f"{path}/{name}", schema)


def left(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """What the last batch has handed on."""
    published.create(spark, f"{path}/carried")
    last = published.entries(spark, f"{path}/carried").where(f"query = '{QUERY}'").agg({"batch": "max"}).head()[0]
    return published.read_batch(spark, f"{path}/carried", schema, QUERY, -1 if last is None else last)
