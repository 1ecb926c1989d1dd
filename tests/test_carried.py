"""Streams that hand something on from batch to batch: any cut into batches, and batches that die, give the same."""

from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators import bgp, hegemony
from tidemark.session import work_dir
from tidemark.sources import published
from tidemark.streaming import bins, carried, records, runs, snapshot

T0 = datetime(2024, 1, 1)
RAW = ("collector string, record_type string, pos bigint, time bigint, elem_type string, peer_asn bigint, "
       "peer_address string, next_hop string, as_path string, communities array<string>, prefix string, status string")


def raw(spark, times, collector="rrc00", first=0):
    """One element per time, at ascending positions."""
    return spark.createDataFrame(
        [(collector, "updates", first + i, t, "A", 1, "p", "n", "1 2", None, f"10.0.{first + i}.0/24", "valid")
         for i, t in enumerate(times)], RAW)


def content(b):
    return rows(b, "rec.collector", "record_type", "pos", "rec.time",
                F.array_join(F.transform("elements", lambda e: e["fields"]["prefix"]), " "))


def die_once(monkeypatch, ending):
    """The next publication of a table with this ending fails."""
    publish, left = published.publish, [1]

    def failing(df, path, *rest, **more):
        if path.endswith(ending) and left:
            left.pop()
            raise RuntimeError("lost")
        return publish(df, path, *rest, **more)
    monkeypatch.setattr(published, "publish", failing)


TIMES = [1] * 7 + [2, 3, 3] + [4] * 6 + [4, 1, 1, 1, 1]


@pytest.mark.parametrize("cuts", [[], [3, 7], [1, 2, 3, 8, 16, 20], [3, 3, 6, 9, 12]])
def test_records_do_not_depend_on_how_a_feed_is_cut(spark, cuts):
    path = work_dir(spark, "test-records")
    both = bgp.bgp_elements(raw(spark, TIMES).unionByName(raw(spark, [5] * 4, "route-views", 100)))
    write = carried.carrying(records.closing_records(3), both.schema, path)
    for i, (low, high) in enumerate(zip([0, *cuts], [*cuts, len(TIMES)])):
        write(both.where(f"(pos >= {low} AND pos < {high}) OR (pos >= {100 + i} AND pos <= {100 + i + (i == len(cuts)) * 9})"), i)
    assert content(records.batched(spark, path, both, 3, ended=True)) == content(bgp.batch_records(both, 3))
    assert carried.left(spark, path, both.schema).groupBy("collector").count().where("count >= 3").isEmpty()


@pytest.mark.parametrize("where", ["/records", "/carried"])
def test_a_batch_of_records_that_dies_counts_once(spark, monkeypatch, where):
    path, feed = work_dir(spark, "test-records"), bgp.bgp_elements(raw(spark, TIMES))
    write = carried.carrying(records.closing_records(3), feed.schema, path)
    write(feed.where("pos < 5"), 0)
    die_once(monkeypatch, where)
    with pytest.raises(RuntimeError):
        write(feed.where("pos BETWEEN 5 AND 11"), 1)
    write(feed.where("pos BETWEEN 5 AND 11"), 1)
    write(feed.where("pos > 11"), 2)
    write(feed.where("pos > 11"), 2)
    assert content(records.batched(spark, path, feed, 3, ended=True)) == content(bgp.batch_records(feed, 3))


def test_an_open_record_is_not_given_out_before_it_ends(spark):
    path, feed = work_dir(spark, "test-records"), bgp.bgp_elements(raw(spark, [1, 1, 1, 1]))
    write = carried.carrying(records.closing_records(3), feed.schema, path)
    write(feed, 0)
    assert [r[2] for r in content(records.batched(spark, path, feed, 3))] == [0]
    write(feed.limit(0), 1)  # nothing new: it stays open
    write(bgp.bgp_elements(raw(spark, [2], first=4)), 2)
    assert [r[2] for r in content(records.batched(spark, path, feed, 3))] == [0, 3]


def test_an_empty_stream_has_no_records(spark):
    path, feed = work_dir(spark, "test-records"), bgp.bgp_elements(raw(spark, [1])).limit(0)
    assert records.batched(spark, path, feed, ended=True).isEmpty()
    carried.carrying(records.closing_records(), feed.schema, path)(feed, 0)
    assert records.batched(spark, path, feed, ended=True).isEmpty()


SEEN = "timebin timestamp, prefix string, originasn_id bigint, nb_peers int"


@pytest.mark.parametrize("dies", [None, "/visibility", "/carried"])
def test_the_most_peers_are_never_reset(spark, monkeypatch, dies):
    path = work_dir(spark, "test-visibility")
    batches = [[(T0, "a", 1, 10), (T0 + timedelta(1), "a", 1, 5)], [], [(T0 + timedelta(2), "b", 1, 4), (T0 + timedelta(3), "a", 2, 20)],
               [(T0 + timedelta(4), "a", 1, 10)]]
    write = carried.carrying(bins._seen_from, bins.MOST, path)
    for i, batch in enumerate(batches):
        batch = spark.createDataFrame(batch, SEEN)
        if dies and i == 2:
            die_once(monkeypatch, dies)
            with pytest.raises(RuntimeError):
                write(batch, i)
        write(batch, i)
    every = spark.createDataFrame([r for b in batches for r in b], SEEN)
    assert rows(bins.visible(spark, path).select("timebin", "peer_max").distinct()) == rows(hegemony.peer_max(every))
    assert rows(bins.visible(spark, path), "visibility") == [(40.0,), (50.0,), (50.0,), (100.0,), (100.0,)]


@pytest.mark.parametrize("dies", [None, "/visibility", "/carried"])
def test_bins_are_closed_by_the_batch_that_passes_them(spark, monkeypatch, dies):
    """Only rows of open bins are handed on; a bin's rows may come in several batches, late ones are left out."""
    path, day = work_dir(spark, "test-closing"), timedelta(1)
    batches = [[(T0, "a", 1, 10), (T0, "a", 1, 4), (T0 + day, "a", 1, 5), (T0 + 2 * day, "a", 1, 6), (T0 + 2 * day, None, 1, None)],
               [(T0 + day, "b", 1, 90), (T0 + 2 * day, "a", 1, 7), (T0 + 2 * day, "a", 2, 1)], [],
               [(T0 + 3 * day, "a", 1, 20), (T0 + 9 * day, "a", 1, 40)]]
    write, left = carried.carrying(bins.closing("1 DAY"), bins.OPEN, path), []
    for i, batch in enumerate(batches):
        batch = spark.createDataFrame(batch, SEEN)
        if dies and i == 3:
            die_once(monkeypatch, dies)
            with pytest.raises(RuntimeError):
                write(batch, i)
        write(batch, i)
        left.append(carried.left(spark, path, bins.OPEN).where("timebin IS NOT NULL").count())
    assert left == [2, 3, 3, 1]
    assert sorted(map(tuple, bins.visible(spark, path).drop("visibility").collect()), key=str) == sorted([
        (T0, "a", 1, 10, 10), (T0 + day, "a", 1, 5, 10), (T0 + 2 * day, "a", 1, 7, 10), (T0 + 2 * day, "a", 2, 1, 10),
        (T0 + 2 * day, None, 1, None, 10), (T0 + 3 * day, "a", 1, 20, 20)], key=str)


def test_closed_bins_are_in_no_state(spark):
    """A run over what is there now takes one batch, and no row of a closed bin waits in state for a second one."""
    path, files = work_dir(spark, "test-visibility"), work_dir(spark, "test-rows")
    spark.range(200).selectExpr("timestamp_seconds(id * 86400) timebin", "'a' prefix", "id originasn_id", "1 nb_peers").write.parquet(files)
    query = bins.visibility_stream(spark.readStream.schema(SEEN).parquet(files), path, "31 days")
    query.awaitTermination()
    assert sum(s.numRowsTotal for p in query.recentProgress for s in p.stateOperators) == 0
    assert bins.visible(spark, path).count() == 200 - 31
    assert carried.left(spark, path, bins.OPEN).count() == 31 + 1


def test_late_rows_are_an_output(spark):
    path, day = work_dir(spark, "test-late"), timedelta(1)
    schema = spark.createDataFrame([], "timebin timestamp, n int").schema
    batches = [[(T0, 1), (T0 + 3 * day, 2), (T0, 3)],  # nothing is late in the first batch
               [(T0 + 2 * day, 4), (T0 + 2 * day + timedelta(seconds=1), 5), (None, 6), (T0 + 9 * day, 7)],
               [(T0 + 8 * day, 8), (T0 + 9 * day, 9)], []]
    write = carried.carrying(bins.by_lateness("timebin", "1 DAY"), bins.NEWEST, path)
    for i, batch in enumerate(batches):
        write(spark.createDataFrame(batch, schema), i)
    assert rows(carried.result(spark, path, "late", schema), "n") == [(4,), (8,)]
    assert rows(carried.result(spark, path, "on_time", schema), "n") == [(n,) for n in (1, 2, 3, 5, 6, 7, 9)]
    assert rows(bins.complete(spark, path, schema, "1 DAY"), "n") == [(1,), (2,), (3,), (5,)]


def test_rejects_have_their_own_table(spark, monkeypatch):
    path = work_dir(spark, "test-valid")
    records_in = spark.createDataFrame([(1, "valid"), (2, "corrupted"), (3, None)], "pos int, status string")
    write = carried.carrying(records.sorted_out(), "seen bigint", path)
    die_once(monkeypatch, "/rejects")
    with pytest.raises(RuntimeError):
        write(records_in, 0)
    write(records_in, 0)
    write(records_in.where("pos = 1"), 1)
    assert rows(carried.result(spark, path, "valid", records_in.schema), "pos") == [(1,), (1,)]
    assert rows(carried.result(spark, path, "rejects", records_in.schema), "pos") == [(2,), (3,)]
    assert carried.left(spark, path, "seen bigint").head()["seen"] == 4


def numbers(spark, n=3):
    path = work_dir(spark, "test-numbers")
    for i in range(n):
        spark.range(i, i + 1).coalesce(1).write.mode("append").parquet(path)
    return runs.read_files(spark, path, spark.range(1).schema, files_per_trigger=1)


def test_a_failing_stream_is_started_again_after_longer_pauses(spark):
    path, fails, pauses = work_dir(spark, "test-again"), [2], []
    once = runs.append_once(f"{path}/out")

    def write(batch, batch_id):
        if batch_id == 1 and fails[0]:
            fails[0] -= 1
            raise RuntimeError("lost")
        once(batch, batch_id)
    stream = numbers(spark)
    begin = lambda: runs.start(stream, path, checkpoint=f"{path}/checkpoint", writer=write)
    assert runs.with_restarts(begin, first_s=0.5, wait=pauses.append) == 2
    assert rows(spark.read.parquet(f"{path}/out"), "id") == [(0,), (1,), (2,)]
    assert pauses == [0.5, 1.0]  # the first run had finished a batch, the second had not


def test_restarts_have_an_end(spark):
    def write(batch, batch_id):
        raise RuntimeError("lost")
    path, stream, pauses = work_dir(spark, "test-again"), numbers(spark, 1), []
    with pytest.raises(StreamingQueryException):
        runs.with_restarts(lambda: runs.start(stream, path, checkpoint=f"{path}/checkpoint", writer=write), restarts=3,
                           first_s=1, most_s=3, wait=pauses.append)
    assert pauses == [1, 2, 3]


def test_an_idle_stream_is_stopped(spark):
    path, stream = work_dir(spark, "test-idle"), numbers(spark)
    query = runs.start(stream, f"{path}/out", checkpoint=f"{path}/checkpoint", every="100 milliseconds")
    assert runs.until_idle(query, idle_s=3, poll_s=0.2)
    assert not query.isActive and spark.read.parquet(f"{path}/out").count() == 3
    assert not runs.until_idle(runs.start(stream, f"{path}/again", checkpoint=f"{path}/c2"), idle_s=60, poll_s=0.2)


def test_a_snapshot_tells_what_has_changed(spark):
    path, seen = work_dir(spark, "test-snapshot"), []
    schema = spark.createDataFrame([], "id bigint, offset bigint, name string").schema
    batches = [[(1, 1, "a"), (2, 2, "b"), (1, 3, "c")], [(2, 1, "old"), (3, 4, None)], [(1, 9, "d")]]
    tell = lambda changed, batch: seen.append((batch, rows(changed)))
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(f"{path}/in")
        stream = runs.read_files(spark, f"{path}/in", schema)
        snapshot.snapshot_stream(stream, path, "id", ["offset"], buckets=2, observers=[tell]).awaitTermination()
    assert seen == [(0, [(1, 3, "c"), (2, 2, "b")]), (1, [(2, 2, "b"), (3, 4, None)]), (2, [(1, 9, "d")])]
    want = [(1, 9, "d"), (2, 2, "b"), (3, 4, None)]
    assert rows(snapshot.current(spark, path, schema, "id")) == want
    assert snapshot.tidy(spark, path, schema, "id").rows == 3
    assert rows(snapshot.current(spark, path, schema, "id")) == want
    assert snapshot.tidy(spark, path, schema, "id") is None
