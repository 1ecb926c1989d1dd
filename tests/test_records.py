import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators import bgp, exchange, outages, planning, probes

ELEMENT = ("collector string, record_type string, pos bigint, time bigint, elem_type string, peer_asn bigint, "
           "peer_address string, next_hop string, as_path string, communities array<string>, prefix string")


def elements(spark, times, collector="rrc00", kind="updates"):
    return bgp.bgp_elements(spark.createDataFrame(
        [(collector, kind, i, t, "A", 1, "p", "n", "1 2", None, f"x{i}") for i, t in enumerate(times)], ELEMENT))


def sizes(records):
    return [r.n for r in records.select("pos", F.size("elements").alias("n")).orderBy("pos").collect()]


def test_batches_of_twenty(spark):
    assert sizes(bgp.batch_records(elements(spark, [5] * 41 + [6]))) == [20, 20, 1, 1]


def test_batches_follow_the_stream_across_buckets(spark):
    random.seed(5)
    times, now = [], 0
    while len(times) < 700:
        now = random.choice([now + 1, now + 1, max(0, now - 3)])  # time may go back
        times += [now] * random.randrange(1, 60)
    want, current = [], []
    for i, t in enumerate(times):
        if current and (times[current[0]] != t or len(current) == 20):
            want.append(current)
            current = []
        current.append(i)
    want.append(current)
    for bucket in (10, 64, 100_000):
        got = bgp.batch_records(elements(spark, times), bucket=bucket).orderBy("pos").collect()
        assert [[int(e.fields.prefix[1:]) for e in r.elements] for r in got] == want
    flat = bgp.flatten_records(bgp.batch_records(elements(spark, times), bucket=64))
    assert rows(flat, "element.time", "element.fields.prefix") == sorted((t, f"x{i}") for i, t in enumerate(times))


def test_element_fields(spark):
    got = elements(spark, [1], "route-views2", "ribs").collect()[0]
    assert (got.project, got.type, got.element.type, got.element.fields.communities) == ("routeviews", "rib", "R", [])
    assert elements(spark, [1]).collect()[0].project == "ris"


def test_records_are_whole_and_keep_their_fields(spark):
    raw = elements(spark, [1] * 25).withColumn("status", F.lit("valid")).withColumn("dump_position", F.lit("start"))
    got = bgp.bgp_records(raw, ("collector", "time", "status", "dump_position")).collect()
    assert len(got) == 1 and (got[0].rec.status, got[0].rec.dump_position) == ("valid", "start")
    assert [e.fields.prefix for e in got[0].elements] == [f"x{i}" for i in range(25)]


def test_exchange_rejects(spark):
    ix = spark.createDataFrame([(1, "a", "aa", "X")], "id bigint, name string, name_long string, country string")
    lan = spark.createDataFrame([(10, 1), (11, 2)], "id bigint, ix_id bigint")
    pfx = spark.createDataFrame([(100, 10, "IPv4", "p"), (101, 12, "IPX", "p"), (102, 12, "IPv6", "p"),
                                 (103, 11, "IPv4", "p"), (104, 10, None, "p")],
                                "id bigint, ixlan_id bigint, protocol string, prefix string")
    good, bad = exchange.ix_enrich(ix, lan, pfx)
    assert rows(good, "ixpfx_id", "name") == [(100, "a")]
    assert rows(bad, "ixpfx_id", "reason") == [(101, "protocol"), (102, "ixlan"), (103, "ix"), (104, "protocol")]


def test_keep_first(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (2, 5, "c")], "id int, pos int, x string")
    assert rows(exchange.keep_first(df, "id", "pos"), "id", "x") == [(1, "a"), (2, "c")]


BURST = ("streamtype string, streamname string, starttime bigint, level double, totalprobes int, "
         "probelist map<bigint,bigint>")
RECONNECT = ("streamtype string, streamname string, starttime bigint, endtime bigint, "
             "reconnectedprobes map<bigint,bigint>, offset bigint")


def test_outages(spark):
    bursts = spark.createDataFrame([
        ("ASN", "1", 1000, 1.0, 5, {7: 1001, 8: 1002, 99: 1003}), ("asn", "2", 1000, 1.0, 5, {7: 1000}),
        ("asn", "3", 1000, 1.0, 5, {7: 1000})], BURST)
    reconnects = spark.createDataFrame([
        ("asn", "1", 1000, 1300, {7: 1290}, 1),  # exactly 300 s
        ("ASN", "2", 1000, 1299, {}, 2),  # too short
        ("asn", "4", 1000, 2000, {}, 3), ("asn", "5", 1000, 1001, {}, 4)], RECONNECT)
    known = spark.createDataFrame([(7, "ip", "px", [1.0, 2.0]), (8, "", "", [0.0, 0.0])],
                                  "id bigint, address_v4 string, prefix_v4 string, coordinates array<double>")
    events, seen, unmatched = outages.outages(bursts, reconnects, known)
    assert rows(events, "streamname", F.unix_seconds("endtime"), "ongoing") == [("1", 1300, False), ("3", 1000, True)]
    assert rows(seen, "streamname", "probe_id", F.unix_seconds("endtime"), "lat", "lon") == [
        ("1", 7, 1290, 2.0, 1.0), ("1", 8, 1002, 0.0, 0.0), ("3", 7, 1000, 2.0, 1.0)]
    assert rows(unmatched, "streamname") == [("4",)]


def test_last_reconnect_wins(spark):
    bursts = spark.createDataFrame([("a", "1", 0, 1.0, 5, {})], BURST)
    twice = spark.createDataFrame([("a", "1", 0, 900, {}, 1), ("a", "1", 0, 600, {}, 2)], RECONNECT)
    assert rows(outages.outage_events(bursts, twice), F.unix_seconds("endtime")) == [(600,)]
    short_too = twice.unionByName(spark.createDataFrame([("a", "1", 0, 10, {}, 0)], RECONNECT))
    assert outages.outage_events(bursts, short_too).count() == 0


def test_probe_snapshot(spark):
    df = spark.createDataFrame([
        (1, 1, "old", None, ([1.0, 2.0],)), (1, 2, None, "p", ([None, 2.0],)), (2, 1, "a", "p", None),
        (3, 1, "a", "p", ([5.0, 6.0],))],
        "id bigint, offset bigint, address_v4 string, prefix_v4 string, geometry struct<coordinates: array<double>>")
    got = probes.probe_defaults(probes.latest_snapshot(df, "id"))
    assert rows(got, "id", "address_v4", "coordinates") == [
        (1, "", [0.0, 0.0]), (2, "a", [0.0, 0.0]), (3, "a", [5.0, 6.0])]
    near = probes.filter_probes(got, near=[(5.0, 6.2)], km=50)
    assert rows(near, "id") == [(3,)]


def test_measurements(spark):
    row = dict(interval=3600, start_time=10, type="traceroute", af=4, status=2, first_hop=1)
    crowds = [(1, None), (2, 100), (3, 101)]
    df = spark.createDataFrame([(i, *row.values(), c) for i, c in crowds],
                               "id int, interval int, start_time int, type string, af int, status int, first_hop int, "
                               "participant_count int")
    assert rows(planning.select_measurements(df, F.lit(10))) == [(1,), (3,)]
    assert planning.select_measurements(df, F.lit(9)).count() == 0


def test_freshness(spark):
    now = datetime(2024, 1, 2)
    log = spark.createDataFrame([("new", now), ("edge", now - timedelta(seconds=43000)),
                                 ("old", now - timedelta(seconds=43001)), ("skip", now - timedelta(days=1))],
                                "topic string, timestamp timestamp")
    expected = spark.createDataFrame([(t,) for t in ("new", "edge", "old", "none", "skip")], "topic string")
    fresh = planning.freshness(log, expected, ignore=["skip"])
    assert rows(fresh, "topic", "stale") == [
        ("edge", False), ("new", False), ("none", True), ("old", True), ("skip", False)]
    assert rows(planning.refetch_plan(fresh), "topic", "fetch_start") == [
        ("none", now - timedelta(hours=1)), ("old", now - timedelta(hours=1))]


def test_chunks_and_groups(spark):
    ids = spark.createDataFrame([(1,)], "id bigint")
    plan = planning.chunk_plan(ids, F.lit(0), F.lit(700), 300)
    assert rows(plan, "chunk_start", "chunk_stop") == [(0, 300), (300, 600), (600, 900)]
    assert planning.chunk_plan(ids, F.lit(5), F.lit(5), 300).count() == 0
    few = planning.id_groups(spark.range(5))
    assert rows(few, "id", "worker") == [(i, i) for i in range(5)]
    far = spark.range(1_000).select((F.xxhash64("id")).alias("id"))
    ordered = sorted(r.id for r in far.collect())
    assert rows(planning.id_groups(far), "id", "worker") == [(x, i // 125) for i, x in enumerate(ordered)]
    many = planning.id_groups(spark.range(20), width=3)
    assert rows(many, "id", "worker") == [(i, i // 2) for i in range(20)]


def test_bursts_with_times_out_of_range(spark):
    """They have no time, and neither meet a reconnection nor end the job."""
    bursts = spark.createDataFrame(
        [("ASN", 1, 1_000, 2.0, 5, {7: 10 ** 18}), ("ASN", 2, 10 ** 18, 2.0, 5, {7: 1_000})],
        "streamtype string, streamname bigint, starttime bigint, level double, totalprobes bigint, probelist map<bigint, bigint>")
    ends = spark.createDataFrame(
        [("ASN", 2, 10 ** 18, 10 ** 18 + 900, {7: 5}, 1), ("ASN", 1, 1_000, 10 ** 18, {}, 2), ("ASN", 1, -10 ** 18, 9 * 10 ** 18, {}, 3)],
        "streamtype string, streamname bigint, starttime bigint, endtime bigint, reconnectedprobes map<bigint, bigint>, offset bigint")
    got = {r["streamname"]: r for r in outages.outage_events(bursts, ends).collect()}
    assert got["2"]["starttime"] is None and got["2"]["ongoing"]
    assert got["1"]["starttime"] is not None and len(got) == 2


def test_chunks_of_few_ids_are_dealt_to_tasks(spark):
    ids = spark.createDataFrame([(1, 0, 7001), (2, 5, 5), (3, 100, 103), (4, None, 9)], "id bigint, a bigint, b bigint").coalesce(1)
    plan = planning.chunk_plan(ids, F.col("a"), F.col("b"), 10, run=7, per_task=100)
    assert rows(plan, "id", "chunk_start", "chunk_stop") == sorted(
        [(1, c, c + 10) for c in range(0, 7001, 10)] + [(3, 100, 110)])
    assert plan.columns == ["id", "a", "b", "chunk_start", "chunk_stop"]
    shares = plan.groupBy(F.spark_partition_id()).count().collect()
    assert len(shares) == 8 and max(r["count"] for r in shares) < 200
