"""Anomalies against a sliding history of each key's own values.

A row is compared with the median of the values its key had in the last hours, scaled by
their absolute deviation from it. The median and both deviations are exact.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from tidemark.operators.dense_history import block_stats
from tidemark.operators.log import in_range
from tidemark.session import kept, small_side

MAD_SCALE = 1.4826  # Fixed value: makes the deviation comparable to a standard deviation.


@dataclass(frozen=True)
class DetectorSpec:
    key: tuple[str, ...]
    value: str
    threshold: float = 5.0
    min_dev: float = 0.01
    dev_metric: str = "mean"  # or "median"
    history_hours: float = 72.0
    history_min_ratio: float = 0.6
    granularity_min: float = 15.0

    @property
    def history_us(self) -> int:
        return int(self.history_hours * 3600 * 1_000_000)

    @property
    def min_samples(self) -> float:
        """A row is tested only if its history holds more rows than this."""
        return self.history_min_ratio * self.history_hours * (60 / self.granularity_min)


# The settings of the three detectors in production.
SCORE_DETECTOR = DetectorSpec(key=("scope", "asn"), value="hege")
SCORE_DETECTOR_V6 = SCORE_DETECTOR
DELAY_DETECTOR = DetectorSpec(key=("startpoint", "endpoint"), value="median", min_dev=1.0, granularity_min=30.0)


def _finite(value: Column) -> Column:
    """The value, or null where it is no number or infinite; such values are in no history."""
    return F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value)


def _placed(df: DataFrame, spec: DetectorSpec, ts: str, order: Sequence[str], blocks: int) -> DataFrame:
    """Rows with their key, time and value beside them, in the block they belong to.

    A key's series is cut into blocks of ``blocks`` histories, and the last history of a
    block is copied into the next one without its payload. A task so handles one block of
    one key and never a whole series, however many rows a key has in all.
    """
    width = spec.history_us * blocks
    us = F.unix_micros(F.col(ts))
    block = F.floor(us / F.lit(width)).cast("bigint")
    near_end = us >= (block + 1) * F.lit(width) - F.lit(spec.history_us)
    placed = df.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(spec.key)],
        *[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)],
        us.alias("_us"),
        _finite(F.col(spec.value).cast("double")).alias("_value"),
        F.struct(*[F.col(c) for c in df.columns]).alias("_row"),
        F.explode(F.when(near_end, F.array(block, block + 1)).otherwise(F.array(block))).alias("_block"),
        block.alias("_home"),
    )
    placed = placed.withColumn("_own", F.col("_block") == F.col("_home")).drop("_home")
    return placed.withColumn("_row", F.when(F.col("_own"), F.col("_row")))


def _block_key(spec: DetectorSpec) -> list[str]:
    return [*[f"_k{i}" for i in range(len(spec.key))], "_block"]


def _listed(placed: DataFrame, spec: DetectorSpec, order: Sequence[str]) -> DataFrame:
    """Add ``history`` as a list to the own rows of each block."""
    part = Window.partitionBy(*_block_key(spec))
    history = F.collect_list("_value").over(part.orderBy("_us").rangeBetween(-spec.history_us, -1))
    if order:
        same = Window.partitionBy(*_block_key(spec), "_us").orderBy(*[f"_o{i}" for i in range(len(order))])
        earlier = F.collect_list("_value").over(same.rowsBetween(Window.unboundedPreceding, -1))
        history = F.concat(history, earlier)
    return placed.withColumn("history", history).where("_own").select("_row", "history")


def with_history(df: DataFrame, spec: DetectorSpec, ts: str = "timestamp",
                 order: Sequence[str] = (), blocks: int = 2) -> DataFrame:
    """Add ``history``: the key's finite values in the hours before the row.

    Rows of one timestamp are not in each other's history, unless ``order`` says which
    of them came first.
    """
    return _listed(_placed(df, spec, ts, order, blocks), spec, order).select("_row.*", "history")


def _middle(ordered: Column, n: Column) -> Column:
    """The median of a sorted array."""
    low = F.get(ordered, F.floor((n - 1) / 2).cast("int"))
    high = F.get(ordered, F.floor(n / 2).cast("int"))
    return (low + high) / 2


def _stats_of_lists(listed: DataFrame, min_samples: float) -> DataFrame:
    """Statistics of ``history``; rows without enough of it are left out first."""
    tested = listed.withColumn("hist_n", F.size("history")).where(F.col("hist_n") > F.lit(min_samples))
    ordered = tested.withColumn("_sorted", F.sort_array("history"))
    centred = ordered.withColumn("hist_median", _middle(F.col("_sorted"), F.col("hist_n")))
    spread = centred.withColumn(
        "_dev", F.sort_array(F.transform("_sorted", lambda x: F.abs(x - F.col("hist_median")))))
    total = F.aggregate("_dev", F.lit(0.0), lambda a, x: a + x)
    return spread.select(
        "_row", "hist_n", "hist_median", _middle(F.col("_dev"), F.col("hist_n")).alias("hist_mad"),
        F.try_divide(total, F.col("hist_n")).alias("hist_mean_dev"))


def _stats_of_dense(placed: DataFrame, spec: DetectorSpec, min_samples: float, order: Sequence[str]) -> DataFrame:
    """The same statistics from an index per block, for blocks with very many rows."""
    ties = [f"_o{i}" for i in range(len(order))]
    span = spec.history_us
    sent = placed.select(*_block_key(spec), *ties, "_us", "_value", "_own", "_row")
    out = StructType([sent.schema["_row"], StructField("hist_n", IntegerType()),
                      *[StructField(c, DoubleType()) for c in ("hist_median", "hist_mad", "hist_mean_dev")]])
    keys = _block_key(spec)

    def stats(block):
        return block_stats(block.drop_columns(keys), span, min_samples, ties)

    return sent.groupBy(*keys).applyInArrow(stats, out)


def rolling_mad(df: DataFrame, spec: DetectorSpec, ts: str = "timestamp", order: Sequence[str] = (),
                gated: bool = True, blocks: int = 2, dense_rows: int = 20_000) -> DataFrame:
    """Add ``hist_n``, ``hist_median``, ``hist_mad`` and ``hist_mean_dev`` of each row's history.

    With ``gated`` only rows whose history is long enough are kept, else those that have
    any. Blocks are counted first: those of more than ``dense_rows`` rows, if there are
    any, take the indexed way, and all others stay in Catalyst with a short list per row.
    """
    min_samples = spec.min_samples if gated else 0.0
    placed = _placed(df, spec, ts, order, blocks)
    keys = _block_key(spec)
    dense = kept(placed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > dense_rows).drop("_n"))
    stats = ["hist_n", "hist_median", "hist_mad", "hist_mean_dev"]
    if dense.isEmpty():
        return _stats_of_lists(_listed(placed, spec, order), min_samples).select("_row.*", *stats)
    dense = small_side(dense)
    hot = F.lit(True)
    for k in keys:
        hot = hot & placed[k].eqNullSafe(dense[k])
    short = _stats_of_lists(_listed(placed.join(dense, hot, "left_anti"), spec, order), min_samples)
    long = _stats_of_dense(placed.join(dense, hot, "left_semi"), spec, min_samples, order)
    return short.unionByName(long).select("_row.*", *stats)


def scored(df: DataFrame, spec: DetectorSpec, ts: str = "timestamp", order: Sequence[str] = (),
           blocks: int = 2, dense_rows: int = 20_000) -> DataFrame:
    """Rows with enough history and their ``deviation``; null where that has no scale."""
    stats = rolling_mad(df, spec, ts, order, blocks=blocks, dense_rows=dense_rows)
    dev = F.col("hist_mad") if spec.dev_metric == "median" else F.col("hist_mean_dev")
    scale = F.lit(MAD_SCALE) * (F.lit(float(spec.min_dev)) + dev)
    return stats.withColumn(
        "deviation", F.try_divide(F.col(spec.value).cast("double") - F.col("hist_median"), scale))


def anomalies(df: DataFrame, spec: DetectorSpec, ts: str = "timestamp", start=None,
              order: Sequence[str] = (), blocks: int = 2, dense_rows: int = 20_000) -> DataFrame:
    """``(timestamp, datapoint, deviation)`` of the rows beyond the threshold.

    With ``start`` (a timestamp or epoch milliseconds) earlier rows only feed the history,
    and rows older than one history before it are not read.
    """
    if start is not None:
        start = F.timestamp_millis(F.lit(start)) if isinstance(start, int) else F.lit(start).cast("timestamp")
        df = in_range(df, ts, start - F.expr(f"INTERVAL '{spec.history_us / 1e6}' SECOND"))
    found = scored(df, spec, ts, order, blocks, dense_rows).where(F.abs("deviation") > F.lit(spec.threshold))
    if start is not None:
        found = found.where(F.col(ts) >= start)
    return found.select(
        F.col(ts).alias("timestamp"), F.struct(*df.columns).alias("datapoint"), "deviation")
