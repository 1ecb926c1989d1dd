"""What to fetch: measurements, time chunks, id groups, windows and stale topics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.numbering import numbered

# Limits of measurement selection, staleness and the default windows.
MIN_PARTICIPANTS = 100
MAX_INTERVAL_S = 3600
MAX_LAG_S = 43_000
WORKERS = 8

CHUNKS_IN_RUN = 1_000
CHUNKS_PER_TASK = 4_000_000


def select_measurements(df: DataFrame, as_of: Column, min_participants: int = MIN_PARTICIPANTS) -> DataFrame:
    """Ids of running IPv4 traceroute measurements that started by ``as_of``.

    An unknown number of participants passes.
    """
    crowd = F.col("participant_count")
    return df.where(
        (F.col("interval") <= MAX_INTERVAL_S) & (F.col("start_time") <= as_of)
        & (F.col("type") == "traceroute") & (F.col("af") == 4) & (F.col("status") == 2)
        & (F.col("first_hop") == 1) & (crowd.isNull() | (crowd > min_participants))
    ).select("id").distinct()


def chunk_plan(ids: DataFrame, start: Column, stop: Column, seconds: int, run: int = CHUNKS_IN_RUN,
               per_task: int = CHUNKS_PER_TASK) -> DataFrame:
    """``[start, stop)`` in steps of ``seconds`` for every id; the last step may run over.

    A few ids may have very many steps. They are cut into runs of ``run`` steps, and if there are
    more than ``per_task`` steps in all, the runs are dealt to tasks before they are written out.
    """
    def steps(first, last, step):
        return F.when(first <= last, F.sequence(first, last, F.lit(step).cast("bigint")))

    total = ids.agg(F.sum(F.when(start < stop, F.ceil((stop - start) / F.lit(seconds))))).first()[0] or 0
    last = F.when(start < stop, stop - 1)
    runs = ids.select("*", last.alias("_last"), F.explode(steps(start, last, seconds * run)).alias("_first"))
    if total > per_task:
        runs = runs.repartition(-(-total // per_task))
    end = F.least("_last", F.try_add("_first", F.lit(seconds * (run - 1)).cast("bigint")))
    return runs.select(*ids.columns, F.explode(steps(F.col("_first"), end, seconds)).alias("chunk_start")).withColumn(
        "chunk_stop", F.col("chunk_start") + seconds)


def id_groups(ids: DataFrame, workers: int = WORKERS, width: int | None = None, slices: int = 4_096) -> DataFrame:
    """Groups of ``int(count / workers)`` consecutive ids, at least one id each.

    Ids are numbered in slices of ``width`` numbers, or in ``slices`` even parts of their
    range, so that neither dense nor sparse ids make one large or very many small slices.
    """
    total = ids.agg(F.count(F.lit(1)).alias("n")).scalar()
    size = F.greatest(F.floor(total / F.lit(workers)), F.lit(1))
    if width is None:
        first, last = (ids.agg(f("id").cast("double").alias("x")).scalar() for f in (F.min, F.max))
        part = F.greatest((last - first) / F.lit(slices), F.lit(1.0))
        slice_of = F.floor((F.col("id").cast("double") - first) / part)
    else:
        slice_of = F.floor(F.col("id") / F.lit(width))
    placed = numbered(ids, [], slice_of, ["id"], "_at")
    return placed.select("id", F.floor(F.col("_at") / size).cast("int").alias("worker"))


def default_windows(params: DataFrame) -> DataFrame:
    """``window_start`` and ``window_end`` for each ``(kind, collector, now)``.

    Kinds are atlas, updates, ribs and table.
    """
    now, kind = F.col("now"), F.col("kind")
    minute = F.date_trunc("minute", now)
    quarter = F.timestamp_seconds(F.floor(F.unix_seconds(now) / 900) * 900)
    rib_back = F.when(F.col("collector").contains("rrc"), F.expr("INTERVAL 480 MINUTES")).otherwise(
        F.expr("INTERVAL 120 MINUTES"))
    day = F.date_trunc("day", now)
    return params.select(
        "*",
        F.when(kind == "atlas", minute - F.expr("INTERVAL 10 MINUTES"))
        .when(kind == "updates", quarter - F.expr("INTERVAL 30 MINUTES"))
        .when(kind == "ribs", now - rib_back)
        .when(kind == "table", day).alias("window_start"),
        F.when(kind == "atlas", minute - F.expr("INTERVAL 5 MINUTES"))
        .when(kind == "updates", quarter - F.expr("INTERVAL 15 MINUTES"))
        .when(kind == "ribs", now)
        .when(kind == "table", day + F.expr("INTERVAL 1 DAY")).alias("window_end"))


def freshness(log: DataFrame, expected: DataFrame, ignore: Sequence[str] = (), max_lag_s: int = MAX_LAG_S) -> DataFrame:
    """The last message of each expected topic, its lag behind the newest, and ``stale``.

    ``expected`` has one row per topic to be watched. Ignored topics are never stale but
    still count for the newest time.
    """
    ends = expected.join(log.groupBy("topic").agg(F.max("timestamp").alias("latest")), "topic", "left")
    newest = ends.agg(F.max("latest").alias("newest")).scalar()
    lag = (F.unix_micros("newest") - F.unix_micros("latest")) / F.lit(1_000_000)
    stale = ~F.col("topic").isin(*ignore) if ignore else F.lit(True)
    return (
        ends.withColumn("newest", newest)
        .withColumn("lag_s", lag)
        .withColumn("stale", stale & (F.col("latest").isNull() | (F.col("lag_s") > max_lag_s)))
    )


def refetch_plan(fresh: DataFrame) -> DataFrame:
    """An hour on both sides of the newest time, for each stale topic."""
    hour = F.expr("INTERVAL 1 HOUR")
    return fresh.where("stale").select(
        "topic", (F.col("newest") - hour).alias("fetch_start"), (F.col("newest") + hour).alias("fetch_end"))


def cutoff(df: DataFrame, column: str, end) -> DataFrame:
    """Rows before ``end``."""
    return df.where(F.col(column) < end)
