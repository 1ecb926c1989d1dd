from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.functions import encode_key
from tidemark.functions.clock import from_epoch_s
from tidemark.operators import log
from tidemark.schemas import LOG
from tidemark.session import work_dir
from tidemark.sources import files

T0 = datetime(2024, 1, 1)


def messages(spark, n=30, topic="t", step=60, parts=3):
    df = spark.createDataFrame(
        [(i, T0 + timedelta(seconds=step * (i // 2)), i % 7, None if i % 5 == 0 else str(i % 3)) for i in range(n)],
        "id bigint, ts timestamp, k bigint, a string")
    return log.to_log(df, topic, encode_key(F.col("k")), F.col("ts"), F.struct("id", "a"), parts, ties=[F.col("id")])


def test_offsets_are_dense_and_ordered(spark):
    m = messages(spark, 200, step=37)
    by_part = {}
    for r in m.select("partition", "offset", "timestamp", "value.id").collect():
        by_part.setdefault(r.partition, []).append((r.offset, r.timestamp, r.id))
    assert sum(map(len, by_part.values())) == 200
    for part in by_part.values():
        part.sort()
        assert [o for o, _, _ in part] == list(range(len(part)))
        assert [x[1:] for x in part] == sorted(x[1:] for x in part)


def test_same_key_same_partition_and_unkeyed_spread(spark):
    m = messages(spark, 200)
    assert m.groupBy("key").agg(F.count_distinct("partition").alias("n")).where("n > 1").count() == 0
    df = spark.range(200).withColumn("ts", F.lit(T0))
    free = log.to_log(df, "t", None, F.col("ts"), F.struct("id"), 4, ties=[F.col("id")])
    assert free.select("partition").distinct().count() == 4


@pytest.mark.parametrize("tied", [True, False])
def test_many_messages_of_one_time(spark, monkeypatch, tied):
    monkeypatch.setattr(log, "TIES_PER_SLICE", 7)
    df = spark.range(300).withColumn("ts", F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") % 2))
    ties = [F.col("id")] if tied else []
    args = (df, "t", None, F.col("ts"), F.struct("id"), 2)
    usual, cut = (log.to_log(*args, ties=ties, few_times=few) for few in (False, True))
    assert rows(cut, "partition", "offset", "value.id") == rows(usual, "partition", "offset", "value.id")


def test_values_with_maps_and_no_key(spark):
    df = spark.range(50).withColumn("m", F.create_map(F.lit("a"), F.col("id")))
    m = log.to_log(df, "t", None, F.lit(T0), F.struct("m"), 3)
    assert m.groupBy("partition", "offset").count().where("count > 1").count() == 0 and m.count() == 50


def test_range_bounds(spark):
    m = messages(spark)
    start, end = T0 + timedelta(minutes=3), T0 + timedelta(minutes=6)
    got = [r.timestamp for r in log.scan_log(m, start=start, end=end).collect()]
    assert min(got) == start and max(got) == end - timedelta(minutes=1)
    assert log.scan_log(m, at=start).count() == 2
    as_ms = int((start - datetime(1970, 1, 1)).total_seconds() * 1000)
    assert log.scan_log(m, at=as_ms).count() == 2
    with pytest.raises(ValueError):
        log.scan_log(m, start=start, at=start)


def test_head_rest_and_tail(spark):
    m = messages(spark)
    first = log.head(m, 4)
    rest = m.join(log.offsets(m), ["topic", "partition"]).where("offset >= low + 4")
    assert first.count() + rest.count() == m.count()
    assert log.tail(m, 1000, partition=1).count() == m.where("partition = 1").count()
    assert rows(log.tail(m, 1, partition=None), "partition", "offset") == rows(log.latest(m), "partition", "offset")
    with pytest.raises(ValueError):
        log.tail(m, 0)


def test_grep_passes_rows_without_the_field(spark):
    m = messages(spark)
    got = {r.a for r in log.grep(m, filters={"a": 1}).collect()}
    assert got == {None, "1"}
    assert log.grep(m, filters={"nowhere": 1}).count() == m.count()
    assert log.grep(m, n=5).count() == 5
    assert log.grep(m, key=encode_key(F.lit(3)), partition=0).count() == m.where("partition = 0").where(
        F.col("key") == encode_key(F.lit(3))).count()


def test_dump_restore_round_trip(spark):
    m, path = messages(spark), work_dir(spark, "test-dump")
    info = files.dump_log(m, path, "t", config={"retention.ms": 1}).collect()[0]
    assert (info.messages, info.partition_count, info.file_name) == (30, 3, "t.2024-01-01T00:00--2024-01-01T00:14")
    same = ["topic", "partition", "offset", "key", "timestamp", "value.id"]
    assert rows(files.restore_log(spark, path), *same) == rows(m, *same)
    end = T0 + timedelta(minutes=5)
    moved = files.restore_log(spark, path, topic="u", end=end, partitions=2)
    assert moved.count() == 10 and {r.topic for r in moved.select("topic").distinct().collect()} == {"u"}
    assert moved.agg(F.max("partition")).collect()[0][0] <= 1
    config = files.restored_config(spark.read.parquet(f"{path}/manifest"), {"retention.ms": 2, "x": "y"})
    assert config.collect()[0].config == {"retention.ms": "2", "x": "y"}


def test_empty_dump(spark):
    empty = messages(spark).where("false")
    info = log.manifest(empty, "t").collect()[0]
    assert info.messages == 0 and info.start_ts is None


def test_written_log_prunes_folders(spark):
    path = work_dir(spark, "test-log")
    m = messages(spark, 60, step=7200)
    files.write_log(m, path)
    picked = log.scan_log(files.read_log(spark, path), topic="t", start="2024-01-02", end="2024-01-03")
    assert picked.count() == log.scan_log(m, start="2024-01-02", end="2024-01-03").count()
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan or "PartitionFilters: [isnotnull(topic" in plan


@pytest.mark.parametrize("lost, which", [(3999, "new"), (4000, "old")])
def test_guarded_replace(spark, lost, which):
    old = spark.range(5000).select("id", F.lit("old").alias("w"))
    new = spark.range(5000 - lost).select("id", F.lit("new").alias("w"))
    assert {r.w for r in log.replace_if_not_shrunk(new, old).select("w").distinct().collect()} == {which}


def log_rows(spark, kind, values):
    """A log of one partition whose values are ``values`` of SQL type ``kind``."""
    return spark.createDataFrame(
        [("t", 0, i, None, v, T0 + timedelta(minutes=i), 0, None) for i, v in enumerate(values)],
        LOG.format(value=kind))


def test_grep_compares_in_the_fields_type(spark):
    rows_ = log_rows(spark, "struct<ok: boolean, x: double, s: string>",
                   [(True, 1e15, "1"), (False, 2.5, "True"), (None, None, None)])
    def found(**filters):
        return sorted(r.offset for r in log.grep(rows_, filters=filters, meta=True).select("offset").collect())
    assert found(ok=True) == [0, 2]
    assert found(x=1e15) == [0, 2] and found(x="2.50") == [1, 2]
    assert found(s=1) == [0, 2] and found(s="True") == [1, 2]
    assert found(x="no number") == [2] and found(absent=3) == [0, 1, 2]


def test_grep_takes_text_values(spark):
    assert [r.value for r in log.grep(log_rows(spark, "string", ["a", "b"]), filters={"x": 1}).collect()] == ["a", "b"]


def test_head_and_tail_of_logs_with_gaps(spark):
    rows_ = log_rows(spark, "string", list("abcdefghij")).where("offset not in (1, 2, 3, 8)")
    assert sorted(r.offset for r in log.head(rows_, 3).collect()) == [0, 4, 5]
    assert sorted(r.offset for r in log.tail(rows_, 3).collect()) == [6, 7, 9]


def test_copies_have_offsets_of_their_own(spark):
    one = log_rows(spark, "string", list("abcdef"))
    both = one.unionByName(one.withColumn("topic", F.lit("u")))
    for moved in (log.copy_log(both, "new"), log.restored(both, "new")):
        assert sorted(r.offset for r in moved.collect()) == list(range(12))
    late = log.copy_log(one, "new", start=T0 + timedelta(minutes=4))
    assert sorted((r.offset, r.value) for r in late.collect()) == [(0, "e"), (1, "f")]


def test_times_out_of_range_are_null(spark):
    df = spark.createDataFrame([(0,), (10**18,), (None,)], "s long")
    assert [r[0] is None for r in df.select(from_epoch_s(F.col("s"))).collect()] == [False, True, True]
