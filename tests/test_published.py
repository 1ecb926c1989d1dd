from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators import dimensions, log
from tidemark.session import kept, work_dir
from tidemark.sources import files, indexed_log, published
from tidemark.streaming import registration, runs

T0 = datetime(2024, 1, 1)
KEYS = "id bigint, name string"


def ids(spark, path):
    return [r[0] for r in rows(published.read(spark, path, "id bigint"))]


def test_a_batch_counts_once(spark):
    path = work_dir(spark, "once")
    first = published.publish(spark.range(5), path, "a", 0)
    again = published.publish(spark.range(5), path, "a", 0)
    other = published.publish(spark.range(5, 7), path, "b", 0)
    assert (first.rows, first.fresh, again.rows, again.fresh, other.rows) == (5, True, 5, False, 2)
    assert first.rate > 0 and ids(spark, path) == list(range(7))


def test_files_without_an_entry_are_not_read(spark):
    path = work_dir(spark, "killed")

    def killed(written):
        raise RuntimeError("killed")

    published.publish(spark.range(3), path, "a", 0)
    with pytest.raises(RuntimeError):
        published.publish(spark.range(3, 9), path, "a", 1, index=killed)
    assert ids(spark, path) == [0, 1, 2]
    assert published.publish(spark.range(3, 9), path, "a", 1).fresh
    assert ids(spark, path) == list(range(9))


def test_empty_batches_and_tables(spark):
    path = work_dir(spark, "empty")
    published.create(spark, path)
    assert ids(spark, path) == [] and published.compact(spark, path, "id bigint") is None
    assert published.publish(spark.range(0), path, "a", 0).rows == 0
    assert not published.publish(spark.range(9), path, "a", 0).fresh
    assert ids(spark, path) == []


def test_compaction_swaps_at_once_and_bounds_files(spark):
    path = work_dir(spark, "compact")
    table = spark.range(60).select("id", F.timestamp_seconds(1_704_067_200 + F.col("id") % 2 * 86400).alias("timebin"))
    for batch in range(3):
        published.append_table_once(table.where(F.col("id") % 3 == batch).repartition(8), path, ["id", "timebin"], "a", batch)
    schema = "id bigint, timebin timestamp, date date"
    was = rows(published.read(spark, path, schema))
    assert published.compact(spark, path, schema, ["date"]).rows == 60
    now = published.read(spark, path, schema)
    assert rows(now) == was and now.select("_metadata.file_path").distinct().count() == 2
    assert not published.append_table_once(table, path, ["id", "timebin"], "a", 1).fresh  # still known
    published.append_table_once(table.limit(1), path, ["id", "timebin"], "a", 3)
    assert published.compact(spark, path, schema, ["date"]).rows == 61


def test_observed_writes(spark):
    m = log.to_log(spark.range(40).withColumn("ts", F.lit(T0)), "t", None, F.col("ts"), F.struct("id"), 3)
    assert files.write_log(m, work_dir(spark, "observed")).rows == 40


def messages(spark, n, start=0):
    df = spark.range(start, start + n).select("id", (F.lit(T0) + F.make_dt_interval(F.lit(0), F.col("id"))).alias("ts"))
    return df.select(F.lit("t").alias("topic"), (F.col("id") % 2).cast("int").alias("partition"),
                     F.floor(F.col("id") / 2).alias("offset"), F.lit(None).cast("binary").alias("key"),
                     F.struct("id").alias("value"), F.col("ts").alias("timestamp"))


def indexed(spark, batches=4, n=48):
    path = work_dir(spark, "indexed")
    for batch in range(batches):
        indexed_log.append(messages(spark, n, batch * n), path, "a", batch)
    return path, messages(spark, 1).schema


def spoil(path, names):
    """Write over all files but those named: a read that opens one of them fails."""
    import glob
    import os

    touched = 0
    for name in glob.glob(f"{path}/data/**/*.parquet", recursive=True):
        if not any(name.endswith(n) for n in names):
            folder, base = os.path.split(name)
            sums = f"{folder}/.{base}.crc"
            if os.path.exists(sums):
                os.remove(sums)
            with open(name, "wb") as f:
                f.write(b"spoilt")
            touched += 1
    return touched


@pytest.mark.parametrize("last", [True, False])
def test_ends_open_only_the_files_named(spark, last):
    path, schema = indexed(spark)
    names = [r["file"] for r in indexed_log.holding(indexed_log.zones(spark, path), 3, last).collect()]
    assert spoil(path, names) > 0
    read = indexed_log.tail(spark, path, schema, 3, None) if last else indexed_log.head(spark, path, schema, 3)
    whole = messages(spark, 4 * 48)
    want = log.tail(whole, 3, None) if last else log.head(whole, 3)
    assert rows(read, "partition", "offset", "value.id") == rows(want, "partition", "offset", "value.id")


def test_offsets_and_seek_open_no_file(spark):
    path, _ = indexed(spark)
    spoil(path, [])
    assert rows(indexed_log.offsets(spark, path)) == [("t", 0, 0, 96), ("t", 1, 0, 96)]
    at = {r["partition"]: r["offset"] for r in indexed_log.seek(spark, path, T0 + timedelta(hours=100)).collect()}
    assert all(o <= 50 for o in at.values())
    past = indexed_log.seek(spark, path, T0 + timedelta(days=99))
    assert rows(past, "partition", "offset") == [(0, 96), (1, 96)]


@pytest.mark.parametrize("n", [1, 2, 5, 9, 100])
def test_overlapping_zones(spark, n):
    """Offsets of a log partition lie anyhow over files; the files named hold the whole end."""
    zones = [(f"f{i}", "t", 0, low, high, T0, T0, m) for i, (low, high, m) in enumerate(
        [(0, 9, 3), (2, 4, 3), (5, 20, 4), (8, 12, 2), (13, 13, 1), (30, 30, 1)])]
    held = {"f0": [0, 1, 9], "f1": [2, 3, 4], "f2": [5, 6, 7, 20], "f3": [8, 12], "f4": [13], "f5": [30]}
    df = spark.createDataFrame(zones, indexed_log.ZONES)
    every = sorted(x for v in held.values() for x in v)
    for last, want in ((False, every[:n]), (True, every[-n:])):
        names = {r["file"] for r in indexed_log.holding(df, n, last).collect()}
        assert {f for f, v in held.items() if set(v) & set(want)} <= names
    assert {r["file"] for r in indexed_log.holding(df, 1, True).collect()} == {"f5"}


def plan(batch, known):
    full = kept(dimensions.register(known, batch, ["name"]))
    return batch.join(full, "name").select("at", "id"), full


def feed(spark, path, batch):
    spark.createDataFrame(batch, "at bigint, name string").coalesce(1).write.mode("append").parquet(f"{path}/in")


def run(spark, path, base):
    stream = runs.read_files(spark, f"{path}/in", spark.createDataFrame([], "at bigint, name string").schema, 1)
    registration.register_stream(stream, plan, base, f"{path}/out", ["name"]).awaitTermination()


@pytest.mark.parametrize("dies_at", ["added", "rows"])
def test_ids_stay_unique_when_a_batch_dies(spark, monkeypatch, dies_at):
    path, base = work_dir(spark, "registering"), spark.createDataFrame([(7, "a")], KEYS)
    feed(spark, path, [(0, "a"), (1, "b"), (2, None)])
    run(spark, path, base)
    feed(spark, path, [(3, "b"), (4, "c"), (5, "d")])
    real = published.publish

    def dying(df, to, *args, **kwargs):
        if to.endswith(dies_at):
            raise RuntimeError("killed")
        return real(df, to, *args, **kwargs)

    monkeypatch.setattr(published, "publish", dying)
    with pytest.raises(Exception, match="killed"):
        run(spark, path, base)
    before = {r["name"]: r["id"] for r in registration.registered(spark, f"{path}/out", base.schema).collect()}
    assert ("c" in before) == (dies_at == "rows")
    monkeypatch.setattr(published, "publish", real)
    run(spark, path, spark.createDataFrame([(99, "z")], KEYS))  # the first rows are those of the first start
    dim = {r["name"]: r["id"] for r in registration.registered(spark, f"{path}/out", base.schema).collect()}
    assert set(dim) == {"a", "b", "c", "d"} and len(set(dim.values())) == 4 and dim["a"] == 7
    assert before.items() <= dim.items()
    found = rows(registration.result(spark, f"{path}/out", spark.createDataFrame([], "at bigint, id bigint").schema))
    assert found == sorted((at, dim[name]) for at, name in enumerate(["a", "b", None, "b", "c", "d"]) if name)
