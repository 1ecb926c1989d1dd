"""The latest record per key, kept up by a stream that tells observers what has changed.

Each key's newest record is its state. A batch publishes the records of the keys it has touched,
in buckets by key, under its id; ``current`` takes the last one of each key, and ``tidy`` leaves
one row a key in place of the changes gathered so far.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, LongType, StructType

from tidemark.operators.probes import latest_snapshot
from tidemark.sources import published
from tidemark.streaming.runs import start, use_rocksdb

Observer = Callable[[DataFrame, int], None]
BUCKETS = 16
ORDER = ("timestamp", "partition", "offset")


def _stored(schema: StructType) -> StructType:
    """``schema`` is that of the stream, ``batch`` and ``bucket`` say when and where a row was written."""
    return StructType([*schema.fields]).add("batch", LongType()).add("bucket", IntegerType())


def snapshot_stream(stream: DataFrame, path: str, ids: str, order: Sequence[str] = ORDER, buckets: int = BUCKETS,
                    observers: Sequence[Observer] = (), every: str | None = None) -> StreamingQuery:
    """Start keeping the last record of each id, by those columns of ``order`` that there are, under ``path``.

    An observer gets the changed records and the batch id once they are published. A batch that
    dies after that is tried again, so an observer may be given a batch twice.
    """
    use_rocksdb(stream.sparkSession)
    table = f"{path}/changes"
    schema = _stored(stream.schema)
    names = stream.columns

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(*names, F.lit(batch_id).cast("long").alias("batch"),
                            F.pmod(F.xxhash64(ids), F.lit(buckets)).cast("int").alias("bucket"))
        published.publish(rows.hint("rebalance", "bucket"), table, "snapshot", batch_id, ["bucket"])
        changed = published.read_batch(batch.sparkSession, table, schema, "snapshot", batch_id).select(*names)
        for observer in observers:
            observer(changed, batch_id)

    published.create(stream.sparkSession, table)
    return start(latest_snapshot(stream, ids, order), path, checkpoint=f"{path}/checkpoint", mode="update", every=every,
                 writer=write)


def _last(ids: str) -> Callable[[DataFrame], DataFrame]:
    def arrange(rows: DataFrame) -> DataFrame:
        return latest_snapshot(rows, ids, ["batch"]).select(*rows.columns).hint("rebalance", "bucket")
    return arrange


def current(spark: SparkSession, path: str, schema: StructType, ids: str) -> DataFrame:
    """The last record of each id as of the last batch; ``schema`` is that of the stream."""
    rows = published.read(spark, f"{path}/changes", _stored(schema))
    return latest_snapshot(rows, ids, ["batch"]).select(*schema.names)


def tidy(spark: SparkSession, path: str, schema: StructType, ids: str) -> published.Written | None:
    """Leave one row a key in place of the changes published so far."""
    return published.compact(spark, f"{path}/changes", _stored(schema), ["bucket"], _last(ids))
