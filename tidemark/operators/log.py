"""Partitioned, time-stamped message logs.

A log is a DataFrame with the columns of Spark's Kafka source: topic, partition, offset,
key, value, timestamp, timestampType and headers. ``value`` may be a struct.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DataType, StringType, StructType

from tidemark.functions.clock import file_stamp
from tidemark.operators.numbering import numbered

CREATE_TIME = 0  # Fixed value: the timestamp type of messages stamped by their producer.
LOG_COLUMNS = ["topic", "partition", "offset", "key", "value", "timestamp", "timestampType", "headers"]
TIES_PER_SLICE = 1_000_000
OFFSETS_PER_SLICE = 1_000_000
HEADERS = "array<struct<key:string,value:binary>>"


def _time(value) -> Column:
    """A bound given as a Column, epoch milliseconds, or anything Spark reads as a timestamp."""
    if isinstance(value, Column):
        return value
    if isinstance(value, int):
        return F.timestamp_millis(F.lit(value))
    return F.lit(value).cast("timestamp")


def in_range(df: DataFrame, ts: str, start=None, end=None) -> DataFrame:
    """Rows with ``start <= ts < end``; either bound may be absent.

    A ``date`` column, which written logs are partitioned by, is bounded as well so that
    whole folders are skipped.
    """
    if start is not None:
        df = df.where(F.col(ts) >= _time(start))
    if end is not None:
        df = df.where(F.col(ts) < _time(end))
    if "date" in df.columns and ts == "timestamp":
        if start is not None:
            df = df.where(F.col("date") >= F.to_date(_time(start)))
        if end is not None:
            df = df.where(F.col("date") <= F.to_date(_time(end)))
    return df


def scan_log(log: DataFrame, topic: str | Sequence[str] | None = None, start=None, end=None, at=None) -> DataFrame:
    """All messages, those of some topics, a time range, or one exact timestamp."""
    if at is not None and (start is not None or end is not None):
        raise ValueError("an exact time excludes a time range")
    if topic is not None:
        log = log.where(F.col("topic").isin([topic] if isinstance(topic, str) else list(topic)))
    if at is not None:
        log = log.where(F.col("timestamp") == _time(at))
        return log.where(F.col("date") == F.to_date(_time(at))) if "date" in log.columns else log
    return in_range(log, "timestamp", start, end)


def create_time_only(log: DataFrame) -> DataFrame:
    return log.where(F.col("timestampType") == CREATE_TIME)


def latest(log: DataFrame) -> DataFrame:
    """The last message of every log partition."""
    rest = [c for c in log.columns if c not in ("topic", "partition")]
    return (
        log.groupBy("topic", "partition")
        .agg(F.max_by(F.struct(*rest), "offset").alias("_last"))
        .select("topic", "partition", "_last.*")
    )


def offsets(log: DataFrame) -> DataFrame:
    """Low and high watermark per log partition; high is the next offset to be written."""
    return log.groupBy("topic", "partition").agg(
        F.min("offset").alias("low"), (F.max("offset") + 1).alias("high"))


def describe(log: DataFrame) -> DataFrame:
    return log.groupBy("topic").agg(F.count_distinct("partition").alias("partitions"))


def _first(log: DataFrame, n: int, order: Column) -> DataFrame:
    """The first ``n`` messages of every log partition; each task passes on its own first ``n``."""
    if n <= 0:
        raise ValueError("n must be positive")
    place = F.row_number().over(Window.partitionBy("topic", "partition").orderBy(order))
    return log.withColumn("_place", place).where(F.col("_place") <= n).select(*log.columns)


def head(log: DataFrame, n: int = 1) -> DataFrame:
    """The first ``n`` messages of every log partition, whatever gaps its offsets have."""
    return _first(log, n, F.col("offset").asc())


def tail(log: DataFrame, n: int = 1, partition: int | None = 0) -> DataFrame:
    """The last ``n`` messages of one partition of each topic, or of all with ``None``."""
    if partition is not None:
        log = log.where(F.col("partition") == partition)
    return _first(log, n, F.col("offset").desc())


def _equals(field: Column, kind: DataType, wanted: object) -> Column:
    """Whether a field equals a value in the field's own type; text is compared as text."""
    if isinstance(kind, StringType):
        return field == F.lit(str(wanted))
    return F.coalesce(field == F.lit(wanted).try_cast(kind), F.lit(False))


def grep(log: DataFrame, key: Column | None = None, filters: Mapping[str, object] | None = None,
         start=None, end=None, at=None, partition: int | None = None, n: int | None = None,
         meta: bool = False) -> DataFrame:
    """Messages by partition, key, time and field values.

    A field filter compares in the field's type, and a message without the field passes;
    so do all where values are plain text. With ``n`` the first messages by time are kept,
    ties broken by topic, partition and offset.
    """
    found = create_time_only(scan_log(log, start=start, end=end, at=at))
    if partition is not None:
        found = found.where(F.col("partition") == partition)
    if key is not None:
        found = found.where(F.col("key") == key)
    kind = log.schema["value"].dataType
    fields = {f.name: f.dataType for f in kind} if isinstance(kind, StructType) else {}
    for name, wanted in (filters or {}).items():
        if name in fields:
            field = F.col("value").getField(name)
            found = found.where(field.isNull() | _equals(field, fields[name], wanted))
    values = "value.*" if fields else "value"
    if n is not None:
        found = found.orderBy("timestamp", "topic", "partition", "offset").limit(n)
    if not meta:
        return found.select(values)
    return found.select("key", "timestamp", "topic", "partition", "offset", "headers", values)


def to_log(df: DataFrame, topic: Column | str, key: Column | None, ts: Column, value: Column, n: int,
           ties: Sequence[Column] = (), partition: Column | None = None, slice_seconds: int = 60,
           few_times: bool = False) -> DataFrame:
    """Messages with a partition and offsets by event time.

    The partition is the CRC of the key, or where there is no key a hash of the value, so
    that unkeyed topics spread. ``ties`` orders messages of one timestamp, then their hash
    does, so that offsets come out the same when a task is run again. Offsets are counted
    in slices of time: a partition that holds much of the log is spread over as many tasks
    as it has slices.

    ``few_times`` is for topics such as table dumps, where very many messages share a
    timestamp: slices are then single timestamps, cut further by ranges of the first tie
    (a number) or of the hash.
    """
    topic = F.lit(topic) if isinstance(topic, str) else topic
    tie_names = [f"_tie{i}" for i in range(len(ties))]
    rows = df.select(
        topic.alias("topic"),
        (partition if partition is not None else F.lit(None)).cast("int").alias("partition"),
        (key if key is not None else F.lit(None)).cast("binary").alias("key"),
        value.alias("value"),
        ts.cast("timestamp").alias("timestamp"),
        *[t.alias(name) for t, name in zip(ties, tie_names)],
    )
    # Spark does not hash maps, so values with one are hashed as text.
    whole = F.to_json("value") if "map<" in rows.schema["value"].dataType.simpleString() else F.col("value")
    rows = rows.withColumn("_hash", F.xxhash64("key", whole))
    if partition is None:
        rows = rows.withColumn("partition", F.pmod(
            F.when(F.col("key").isNull(), F.col("_hash")).otherwise(F.crc32("key")), F.lit(n)).cast("int"))
    slice_of = F.floor(F.unix_seconds("timestamp") / F.lit(slice_seconds))
    if few_times:
        inner = F.floor(F.col(tie_names[0]) / F.lit(TIES_PER_SLICE)) if ties else F.shiftright("_hash", 52)
        slice_of = F.struct(F.unix_micros("timestamp").alias("us"), inner.cast("bigint").alias("part"))
    order = ["timestamp", *tie_names, "_hash"]
    return numbered(rows, ["topic", "partition"], slice_of, order, "offset").select(
        "topic", "partition", "offset", "key", "value", "timestamp",
        F.lit(CREATE_TIME).alias("timestampType"), F.lit(None).cast(HEADERS).alias("headers"))


def _rebased(log: DataFrame) -> DataFrame:
    """Offsets from 0 on in every log partition, in the order of the old ones and ``_source``."""
    place = numbered(log, ["topic", "partition"], F.floor(F.col("offset") / F.lit(OFFSETS_PER_SLICE)),
                     ["offset", "_source"], "_at")
    return place.withColumn("offset", F.col("_at")).drop("_at")


def copy_log(log: DataFrame, topic: str, start=None, end=None, partitions: int | None = None) -> DataFrame:
    """Messages under another topic name, with keys, values and timestamps kept.

    The copy is a fresh log, so offsets start at 0 and have no gaps. Without a new partition
    count a message keeps its partition and its place there; of several topics that are
    copied into one, messages stand by their old offset. With one, partitions are assigned
    afresh as well; messages of one timestamp keep the order of their old partition and offset.
    """
    moved = create_time_only(scan_log(log, start=start, end=end))
    if partitions is None:
        return _rebased(moved.withColumn("_source", F.col("topic")).withColumn("topic", F.lit(topic))).drop("_source")
    return to_log(moved, topic, F.col("key"), F.col("timestamp"), F.col("value"), partitions,
                  ties=[F.col("topic"), F.col("partition"), F.col("offset")])


def manifest(log: DataFrame, name: str, start=None, end=None, at=None, config: Mapping[str, str] | None = None,
             replication_factor: int = 1) -> DataFrame:
    """One row that describes a dump; missing bounds come from the messages."""
    picked = scan_log(log, start=start, end=end, at=at)
    settings = F.map_from_arrays(
        F.array(*[F.lit(k) for k in (config or {})]).cast("array<string>"),
        F.array(*[F.lit(str(v)) for v in (config or {}).values()]).cast("array<string>"))
    facts = picked.agg(
        F.min("timestamp").alias("first"), F.max("timestamp").alias("last"),
        F.count(F.lit(1)).alias("messages"), F.count_distinct("partition").alias("partition_count"))
    bounds = facts.select(
        F.lit(name).alias("name"),
        (_time(start) if start is not None else F.col("first")).alias("start_ts"),
        (_time(end) if end is not None else F.col("last")).alias("end_ts"),
        "messages", "partition_count",
        F.lit(replication_factor).alias("replication_factor"), settings.alias("config"))
    if at is not None:
        stamp = file_stamp(_time(at))
    else:
        stamp = F.concat(file_stamp(F.col("start_ts")), F.lit("--"), file_stamp(F.col("end_ts")))
    return bounds.withColumn("file_name", F.concat(F.lit(f"{name}."), stamp))


def restored(messages: DataFrame, topic: str | None = None, start=None, end=None,
             partitions: int | None = None) -> DataFrame:
    """Messages of a dump with its overrides applied, as a fresh log whose offsets start at 0."""
    kept = in_range(messages, "timestamp", start, end)
    if partitions is not None:
        return copy_log(kept, topic, partitions=partitions) if topic else to_log(
            kept, F.col("topic"), F.col("key"), F.col("timestamp"), F.col("value"), partitions,
            ties=[F.col("partition"), F.col("offset")])
    kept = kept.withColumn("_source", F.col("topic"))
    return _rebased(kept.withColumn("topic", F.lit(topic)) if topic else kept).drop("_source")


def replace_if_not_shrunk(new: DataFrame, old: DataFrame, tolerance: int = 4000) -> DataFrame:
    """The new snapshot, or the old one if the new has shrunk by ``tolerance`` rows or more."""
    def size(df):
        return df.agg(F.count(F.lit(1)).alias("n")).scalar()

    grown = size(new) - size(old) > -tolerance
    return new.where(grown).unionByName(old.where(~grown))
