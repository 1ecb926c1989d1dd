"""Starting streams: checkpoints in the shared folder, stop conditions and sinks."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.session import ROCKSDB, work_dir


def read_files(spark: SparkSession, path: str, schema, files_per_trigger: int | None = None,
               glob: str | None = None) -> DataFrame:
    """A folder of Parquet files as a stream, oldest file first."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def use_rocksdb(spark: SparkSession) -> None:
    """State on local disk with changelogs in the checkpoint, as large state needs."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def append_once(path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer that leaves one copy of a batch, also when it is retried.

    Each batch owns the folder named by its id and overwrites it.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
    return write


def start(stream: DataFrame, path: str, checkpoint: str | None = None, mode: str = "append",
          every: str | None = None, writer: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Start a stream into Parquet files, or into ``writer``.

    Without ``every`` it stops after what is there now; with it, it runs until stopped.
    Use ``awaitTermination(seconds)`` for a time limit.
    """
    checkpoint = checkpoint or work_dir(stream.sparkSession, "stream")
    out = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    out = out.trigger(processingTime=every) if every else out.trigger(availableNow=True)
    if writer is not None:
        return out.foreachBatch(writer).start()
    return out.format("parquet").option("path", path).start()


def drain(stream: DataFrame, label: str = "drained", mode: str = "append") -> DataFrame:
    """Run a stream over what is there now and read back what it wrote."""
    spark = stream.sparkSession
    path = work_dir(spark, label)
    start(stream, path, mode=mode).awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def dated(stream: DataFrame, column: str = "timebin") -> DataFrame:
    return stream.withColumn("date", F.to_date(column))


def with_restarts(begin: Callable[[], StreamingQuery], restarts: int | None = None, first_s: float = 1.0,
                  most_s: float = 300.0, wait: Callable[[float], None] = time.sleep) -> int:
    """Run a stream to its end and start it again when it fails; returns how often it was.

    Pauses double from ``first_s`` to ``most_s``, and begin anew once a run has finished a batch.
    After ``restarts`` failures without one the last error is raised; without it, never. ``begin``
    names the same checkpoint each time.
    """
    again = failed = 0
    while True:
        query = begin()
        try:
            query.awaitTermination()
            return again
        except StreamingQueryException:
            failed = 1 if query.recentProgress else failed + 1
            if restarts is not None and failed > restarts:
                raise
        again += 1
        wait(min(first_s * 2 ** (failed - 1), most_s))


def until_idle(query: StreamingQuery, idle_s: float, poll_s: float = 1.0) -> bool:
    """Stop a running stream once ``idle_s`` seconds have passed without input; whether it was stopped.

    False means that it ended by itself.
    """
    busy, seen = time.monotonic(), None
    while not query.awaitTermination(poll_s):
        last = next((p for p in reversed(query.recentProgress) if p.numInputRows), None)
        if query.status["isTriggerActive"] and query.status["isDataAvailable"] or (last and last.batchId != seen):
            busy, seen = time.monotonic(), last and last.batchId
        elif time.monotonic() - busy >= idle_s:
            query.stop()
            return True
    return False
