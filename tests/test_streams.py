from datetime import datetime

from pyspark.sql import functions as F

from checks import event_queries, stream_queries, views  # noqa: F401
from checks.registry import QUERIES
from conftest import SMALL, rows
from tidemark.operators import hegemony
from tidemark.session import work_dir
from tidemark.streaming import bins, outages, registration, runs

SCHEMA = "timestamp bigint, scope string, asn string, hege double"
DAY = 86400
T0 = 1_704_067_200  # 2024-01-01


def cone_of(spark, batches, delay):
    path = work_dir(spark, "test-scores")
    for batch in batches:
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    stream = runs.read_files(spark, path, spark.createDataFrame([], SCHEMA).schema, files_per_trigger=1)
    return runs.drain(bins.cone_stream(hegemony.score_rows(stream), 4, delay), "test-cones")


def test_rows_out_of_order_inside_the_watermark_count(spark):
    got = cone_of(spark, [
        [(T0, "1", "9", 0.5), (T0 + DAY, "1", "9", 0.5)],
        [(T0, "2", "9", 0.5)],  # late, but not beyond a day
        [(T0 + 3 * DAY, "1", "9", 0.5)],
        [(T0 + 3 * DAY, "2", "9", 0.5)],  # closes the first two bins
        [(T0 + DAY, "5", "9", 0.5)],  # beyond it: dropped
    ], "1 day 1 hour")
    assert rows(got, "timebin", "conesize") == [(datetime(2024, 1, 1), 2), (datetime(2024, 1, 2), 1)]


def test_append_once_is_idempotent(spark):
    path = work_dir(spark, "test-once")
    write = runs.append_once(path)
    df = spark.range(3)
    write(df, 0)
    write(df, 0)
    write(df, 1)
    assert spark.read.parquet(path).count() == 6


BURST = ("streamtype string, streamname string, starttime bigint, level double, totalprobes bigint, "
         "probelist map<bigint, bigint>")
BACK = "streamtype string, streamname string, starttime bigint, endtime bigint, reconnectedprobes map<bigint, bigint>, offset bigint"


def test_outages_change_only_what_a_batch_touches(spark):
    path, none = work_dir(spark, "test-outages"), []
    batches = [
        ([("ASN", "1", T0, 3.0, 9, {7: T0, 8: T0 + 1})], none),  # opens
        ([("ASN", "2", T0, 3.0, 9, {7: T0})], [("ASN", "3", T0, T0 + 900, {9: T0 + 800}, 1)]),  # 3 waits for its burst
        (none, [("ASN", "1", T0, T0 + 600, {8: T0 + 500}, 2)]),  # closes
        ([("ASN", "3", T0, 4.0, 9, {9: T0})], [("ASN", "2", T0, T0 + 60, {}, 3)]),  # inserted closed; 2 was short
        (none, [("ASN", "1", T0, T0 + 700, {}, 1), ("ASN", "2", T0, T0 + 900, {}, 9)]),  # older end; deleted stays so
        ([("ASN", "4", 10 ** 18, 1.0, 1, {})], [("ASN", "1", T0, T0 + 800, {7: T0 + 650}, 5)]),
    ]
    for bursts, ends in batches:
        spark.createDataFrame(bursts, BURST).coalesce(1).write.mode("append").parquet(f"{path}/bursts")
        spark.createDataFrame(ends, BACK).coalesce(1).write.mode("append").parquet(f"{path}/ends")
        streams = [runs.read_files(spark, f"{path}/{n}", spark.createDataFrame([], k).schema) for n, k in (("bursts", BURST), ("ends", BACK))]
        outages.follow(*streams, f"{path}/out").awaitTermination()  # restarts from its checkpoint
    log = spark.read.parquet(f"{path}/out/changes")
    by_batch = {b: set() for b in range(6)}
    for r in log.selectExpr("batch", "streamname", "op", "end.endtime AS e").collect():
        by_batch[r["batch"]].add((r["streamname"], r["op"], r["e"] and r["e"] - T0))
    assert list(by_batch.values()) == [
        {("1", "upsert", None)}, {("2", "upsert", None)}, {("1", "upsert", 600)},
        {("3", "upsert", 900), ("2", "delete", None)}, {("1", "upsert", 600), ("2", "delete", 900)}, {("1", "upsert", 800)}]
    found = outages.current_events(spark, f"{path}/out")
    assert rows(found, "streamname", "nbdiscoprobes", "ongoing") == [("1", 2, False), ("3", 1, False)]
    known = spark.createDataFrame([(7, "a", "p", [1.0, 2.0]), (8, "b", "q", None)],
                                  "id bigint, address_v4 string, prefix_v4 string, coordinates array<double>")
    probes = outages.current_probes(spark, f"{path}/out", known).selectExpr("probe_id", "unix_seconds(endtime) e", "lat", "lon")
    assert rows(probes) == [(7, T0 + 650, 2.0, 1.0), (8, T0 + 1, None, None)]


def test_a_topic_has_as_many_files_as_it_needs(spark, monkeypatch):
    """No task writes or reads a whole topic."""
    base, turns = work_dir(spark, "test-topics"), []
    for name in ("v_burst", "v_reconnect"):
        topic = getattr(views, name)(spark, SMALL).repartition(8, F.monotonically_increasing_id())
        monkeypatch.setattr(views, name, lambda spark, sf, topic=topic: topic)
    monkeypatch.setattr(stream_queries, "work_dir", lambda spark, label: base)
    follow = outages.follow
    monkeypatch.setattr(outages, "follow", lambda *a: turns.append(1) or follow(*a))
    for n in (1, 3):
        base, turns = work_dir(spark, "test-topics"), []
        stored = stream_queries._followed(spark, SMALL, n)
        assert len(turns) == n and stored == f"{base}/stored"
        assert len(spark.read.parquet(f"{base}/topic-bursts").inputFiles()) >= 8
        batches = spark.read.parquet(f"{stored}/changes").select("batch").distinct().count()
        assert batches == n and outages.current_events(spark, stored).count() == QUERIES["disco_events"](spark, SMALL).count()


def test_registering_streams_have_batches_of_many_files(spark):
    seen = []

    def plan(batch, known):
        seen.append((batch.select(F.input_file_name()).distinct().count(), batch.count()))
        return batch.select("ts"), known

    base = spark.createDataFrame([], "id bigint, k string")
    data = spark.range(80).select(F.when(F.col("id") % 8 != 0, F.col("id") % 3).alias("ts")).repartition(8, F.col("id"))
    path, _ = stream_queries._registered(spark, data, "ts", plan, base, ["k"])
    assert len(seen) == 3 and min(files for files, _ in seen) > 1 and sum(n for _, n in seen) == 80
    assert registration.result(spark, path, data.schema).where("ts IS NULL").count() == 10
