import random
import statistics
from dataclasses import replace
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators import dense_history
from tidemark.operators.detector import DetectorSpec, anomalies, rolling_mad, scored, with_history
from tidemark.session import work_dir
from tidemark.streaming import detector as streamed, runs

T0 = datetime(2024, 1, 1)
SPEC = DetectorSpec(key=("k",), value="v", granularity_min=1440.0, history_min_ratio=0.6)  # more than 1.8 rows


def series(spark, points, key="a"):
    return spark.createDataFrame([(key, T0 + timedelta(milliseconds=int(ms)), float(v)) for ms, v in points],
                                 "k string, timestamp timestamp, v double")


HOUR = 3_600_000


def test_lower_bound_is_inclusive(spark):
    df = series(spark, [(0, 1), (1, 2), (2, 4), (72 * HOUR, 9), (72 * HOUR + 1, 9)])
    got = {r.timestamp: sorted(r.history) for r in with_history(df, SPEC).collect()}
    assert got[T0 + timedelta(hours=72)] == [1, 2, 4]
    assert got[T0 + timedelta(hours=72, milliseconds=1)] == [2, 4, 9]


def test_gate_is_strict(spark):
    spec = replace(SPEC, history_min_ratio=1.0)  # 3 rows expected
    df = series(spark, [(i, i) for i in range(5)])
    assert [r.hist_n for r in rolling_mad(df, spec).collect()] == [4]


def test_even_median(spark):
    df = series(spark, [(0, 9), (1, 1), (2, 4), (3, 2), (4, 0)])
    last = rolling_mad(df, SPEC).where("hist_n = 4").collect()[0]
    assert (last.hist_median, last.hist_mad, last.hist_mean_dev) == (3.0, 1.5, 2.5)


def test_threshold_is_strict_and_flat_data_has_no_scale(spark):
    spec = replace(SPEC, threshold=5.0, min_dev=1 / 1.4826)
    df = series(spark, [(0, 0), (1, 0), (2, 5), (3, 5.001)])
    assert [r.deviation for r in scored(df, spec).where("v = 5").collect()] == [pytest.approx(5.0)]
    flat = series(spark, [(0, 1), (1, 1), (2, 1), (3, 50)])
    got = scored(flat, replace(SPEC, min_dev=0.0))
    assert {r.deviation for r in got.collect()} == {None}
    assert anomalies(flat, replace(SPEC, min_dev=0.0)).count() == 0


def test_anomalies_stay_in_the_history(spark):
    df = series(spark, [(0, 1), (1, 1), (2, 1000), (3, 1)])
    history = {r.timestamp: r.history for r in with_history(df, SPEC).collect()}
    assert 1000.0 in history[T0 + timedelta(milliseconds=3)]


def test_value_named_like_a_statistic(spark):
    df = series(spark, [(0, 1), (1, 1), (2, 50)]).withColumnRenamed("v", "median")
    found = anomalies(df, replace(SPEC, value="median")).collect()
    assert [r.datapoint["median"] for r in found] == [50.0]


def test_ties_with_an_order(spark):
    df = series(spark, [(0, 1), (5, 2), (5, 3), (9, 4)]).withColumn("n", F.col("v"))
    free = {r.v: sorted(r.history) for r in with_history(df, SPEC).collect()}
    assert free[3.0] == [1.0] and free[4.0] == [1.0, 2.0, 3.0]
    ordered = {r.v: sorted(r.history) for r in with_history(df, SPEC, order=["n"]).collect()}
    assert ordered[2.0] == [1.0] and ordered[3.0] == [1.0, 2.0]


def brute(points, spec):
    out = []
    for t, v in points:
        h = [w for u, w in points if t - spec.history_us / 1000 <= u < t]
        if len(h) > spec.min_samples:
            m = statistics.median(h)
            away = [abs(x - m) for x in h]
            d = statistics.median(away) if spec.dev_metric == "median" else statistics.mean(away)
            dev = (v - m) / (1.4826 * (spec.min_dev + d))
            if abs(dev) > spec.threshold:
                out.append((t, round(dev, 6)))
    return sorted(out)


def sample(n=400, hours=400):
    random.seed(7)
    times = sorted(random.sample(range(hours * HOUR), n))
    return [(t, random.choice([1, 2, 3, 100]) * random.random()) for t in times]


def ms(ts):
    return round((ts - T0).total_seconds() * 1000)


@pytest.mark.parametrize("metric", ["mean", "median"])
@pytest.mark.parametrize("blocks, dense_rows", [(1, 20_000), (3, 20_000), (1, 1), (2, 130)])
def test_matches_brute_force_across_blocks(spark, metric, blocks, dense_rows):
    """Few rows take lists, more than ``dense_rows`` in a block the index; 130 mixes both."""
    spec = replace(SPEC, dev_metric=metric, threshold=3.0)
    points = sample()
    got = anomalies(series(spark, points), spec, blocks=blocks, dense_rows=dense_rows)
    assert sorted((ms(r.timestamp), round(r.deviation, 6)) for r in got.collect()) == brute(points, spec)


def test_start_only_hides_earlier_rows(spark):
    points, spec = sample(), replace(SPEC, threshold=3.0)
    start = T0 + timedelta(hours=200)
    got = anomalies(series(spark, points), spec, start=start)
    want = [x for x in brute(points, spec) if x[0] >= 200 * HOUR]
    assert sorted((ms(r.timestamp), round(r.deviation, 6)) for r in got.collect()) == want


def test_stream_equals_batch(spark):
    points, spec = sample(120, 300), replace(SPEC, threshold=3.0)
    both = series(spark, points).unionByName(series(spark, [(t, v * 2) for t, v in points], "b"))
    path = work_dir(spark, "test-series")
    for day in range(0, 300, 100):
        part = both.where((F.col("timestamp") >= T0 + timedelta(hours=day))
                          & (F.col("timestamp") < T0 + timedelta(hours=day + 100)))
        part.coalesce(1).write.mode("append").parquet(path)
    stream = runs.read_files(spark, path, both.schema, files_per_trigger=1)
    got = runs.drain(streamed.anomalies_stream(stream, spec))
    flat = ["timestamp", "datapoint.k", F.round("deviation", 6)]
    assert rows(got, *flat) == rows(anomalies(both, spec), *flat)
    assert got.count() > 0


def test_late_rows_meet_the_history_they_had(spark):
    """70 hourly rows, one far ahead, then a spike that comes late, and one beyond all patience."""
    path = work_dir(spark, "test-late")
    early = series(spark, [(h * HOUR, 1 + h % 3) for h in range(70)])
    for part in (early, series(spark, [(140 * HOUR, 2)]), series(spark, [(69.5 * HOUR, 50)]),
                 series(spark, [(20.5 * HOUR, 50)])):
        part.coalesce(1).write.mode("append").parquet(path)
    stream = runs.read_files(spark, path, early.schema, files_per_trigger=1)
    got = runs.drain(streamed.anomalies_stream(stream, SPEC, late_seconds=72 * 3600))
    want = anomalies(spark.read.parquet(path).where(F.col("timestamp") != T0 + timedelta(hours=20.5)), SPEC)
    flat = ["timestamp", F.round("deviation", 6)]
    assert rows(got, *flat) == rows(want, *flat) and got.count() == 1


def test_idle_keys_are_freed(spark):
    path = work_dir(spark, "test-idle")
    for key, hour in (("a", 0), ("b", 100), ("b", 200), ("b", 300)):
        series(spark, [(hour * HOUR, 1), (hour * HOUR + 1, 1)], key).coalesce(1).write.mode("append").parquet(path)
    stream = runs.read_files(spark, path, series(spark, []).schema, files_per_trigger=1)
    query = runs.start(streamed.anomalies_stream(stream, SPEC), work_dir(spark, "test-idle-out"))
    query.awaitTermination()
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert held[-1] == 1  # key a is gone, key b is there


def test_index_equals_lists_with_ties_and_nulls(spark):
    random.seed(11)
    data = [("ab"[i % 2], T0 + timedelta(hours=random.randrange(300)), random.choice([None, 1.0, 2.0, random.random()]), i)
            for i in range(500)]
    df = spark.createDataFrame(data, "k string, timestamp timestamp, v double, i int")
    for order in ([], ["i"]):
        lists, index = (rolling_mad(df, SPEC, order=order, gated=g, dense_rows=n)
                        for g, n in ((True, 10_000), (True, 1)))
        columns = ["i", "hist_n", *[F.round(c, 9).alias(c) for c in ("hist_median", "hist_mad", "hist_mean_dev")]]
        assert rows(lists, *columns) == rows(index, *columns)


def test_huge_and_odd_values_give_one_answer_either_way(spark):
    """A huge value that has left the history, and values that are no numbers, in lists and index."""
    random.seed(5)
    values = [random.random() for _ in range(260)]
    values[3], values[40], values[41], values[42], values[43] = 1e16, None, float("nan"), float("inf"), -float("inf")
    data = [("a", T0 + timedelta(hours=i), v, i) for i, v in enumerate(values)]
    df = spark.createDataFrame(data, "k string, timestamp timestamp, v double, i int")
    lists, index = (sorted(rolling_mad(df, SPEC, dense_rows=n).select(
        "i", "hist_n", "hist_median", "hist_mad", "hist_mean_dev").collect()) for n in (20_000, 1))
    assert [tuple(r)[:2] for r in lists] == [tuple(r)[:2] for r in index]
    for a, b in zip(lists, index):
        assert tuple(a)[2:] == pytest.approx(tuple(b)[2:], rel=1e-9)
    for r in index:
        past = [v for v in values[max(0, r.i - 72):r.i] if v is not None and abs(v) < float("inf")]
        middle = statistics.median(past)
        assert (r.hist_n, r.hist_mean_dev) == (len(past), pytest.approx(statistics.fmean(abs(v - middle) for v in past), rel=1e-9))


def test_a_hot_key_is_not_quadratic(spark):
    """60,000 rows of one key inside one history."""
    df = spark.range(60_000).select(
        F.lit("a").alias("k"), F.timestamp_millis(F.lit(1_704_067_200_000) + F.col("id") * 1000).alias("timestamp"),
        (F.hash("id") % 1000).cast("double").alias("v"))
    stats = rolling_mad(df, SPEC).where("hist_n = 59999").collect()[0]
    values = [r.v for r in df.orderBy("timestamp").collect()][:-1]
    middle = statistics.median(values)
    away = [abs(x - middle) for x in values]
    assert stats.hist_median == middle and stats.hist_mad == statistics.median(away)
    assert stats.hist_mean_dev == pytest.approx(statistics.fmean(away), rel=1e-9)


@pytest.mark.parametrize("metric", ["mean", "median"])
def test_stream_index_equals_row_by_row(monkeypatch, metric):
    import numpy as np

    rng = np.random.default_rng(3)
    us = np.sort(rng.integers(0, 400 * 3600 * 10**6, 500))
    values = rng.choice([np.nan, np.inf, 1.0, 2.0, 7.5, 100.0], 500)
    values[4] = 1e16
    spec = replace(SPEC, dev_metric=metric)
    plain = streamed.deviations(us, values, spec)
    monkeypatch.setattr(streamed, "INDEXED_ROWS", 1)
    assert np.allclose(streamed.deviations(us, values, spec), plain, equal_nan=True)


def test_sums_are_not_part_of_the_search_and_equal_windows_are_answered_once(monkeypatch):
    of, asked = dense_history.Sums.of, []
    monkeypatch.setattr(dense_history.Sums, "of", lambda self, lo, hi: asked.append(len(lo)) or of(self, lo, hi))
    values = np.random.default_rng(5).integers(0, 50, 400) / 8
    lo, hi = np.repeat(np.arange(0, 300, 3), 4), np.repeat(np.arange(1, 301, 3) + np.arange(100) % 7, 4)
    n, median, mad, mean_dev = dense_history.window_stats(values, lo, hi)
    for i in range(0, 400, 4):
        window = values[lo[i]:hi[i]]
        away = np.abs(window - np.median(window))
        assert (n[i], median[i], mad[i]) == (len(window), np.median(window), np.median(away))
        assert mean_dev[i] == pytest.approx(away.mean(), abs=1e-9)
    assert len(asked) <= 2 * 6 and sum(asked) <= 2 * 6 * 100
