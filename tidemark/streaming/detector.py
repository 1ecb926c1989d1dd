"""The detector as a stateful stream: each key's recent values are its state."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from tidemark.operators.dense_history import Ranges
from tidemark.operators.detector import MAD_SCALE, DetectorSpec
from tidemark.streaming.runs import use_rocksdb

INDEXED_ROWS = 2_000
HISTORY = StructType([StructField("us", LongType()), StructField("value", DoubleType())])


def deviations(us: np.ndarray, values: np.ndarray, spec: DetectorSpec) -> np.ndarray:
    """Deviation of each row from the rows before it, in time order; NaN where not tested.

    Long runs are answered together from an index, short ones row by row.
    """
    out = np.full(len(us), np.nan)
    known = np.isfinite(values)
    past_us, past = us[known], values[known]
    low = np.searchsorted(past_us, us - spec.history_us, side="left")
    high = np.searchsorted(past_us, us, side="left")
    tested = np.flatnonzero((high - low > spec.min_samples) & (high > low))
    if not len(tested):
        return out
    low, high = low[tested], high[tested]
    if len(past) > INDEXED_ROWS:
        index = Ranges(past)
        middle = index.median(low, high)
        if spec.dev_metric == "median":
            spread = index.mad(low, high, middle)
        else:
            spread = index.mean_dev(low, high, middle)
    else:
        reduce = np.median if spec.dev_metric == "median" else np.mean
        middle = np.array([np.median(past[a:b]) for a, b in zip(low, high)])
        spread = np.array([reduce(np.abs(past[a:b] - m)) for a, b, m in zip(low, high, middle)])
    scale = MAD_SCALE * (spec.min_dev + spread)
    with np.errstate(divide="ignore", invalid="ignore"):
        out[tested] = np.where(scale > 0, (values[tested] - middle) / scale, np.nan)
    return out


class KeyHistory(StatefulProcessor):
    """Keeps the values of the last hours per key and reports rows beyond the threshold."""

    def __init__(self, spec: DetectorSpec, late_seconds: int):
        self.spec = spec
        self.kept_us = spec.history_us + late_seconds * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.history = handle.getListState("history", HISTORY)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frames = [frame for frame in rows if len(frame)]
        if not frames:
            return
        fresh = pd.concat(frames, ignore_index=True).sort_values("event_us", kind="stable")
        past = list(self.history.get())
        old = pd.DataFrame(past, columns=["event_us", "event_value"]).sort_values("event_us", kind="stable")
        us = np.concatenate([old["event_us"].to_numpy("int64"), fresh["event_us"].to_numpy("int64")])
        values = np.concatenate([old["event_value"].to_numpy("float64"), fresh["event_value"].to_numpy("float64")])
        # Late rows belong before some of the kept ones, so all are put in time order.
        order = np.argsort(us, kind="stable")
        is_new = order >= len(old)
        us, values = us[order], values[order]
        deviation = deviations(us, values, self.spec)[is_new]
        recent = (us >= us[-1] - self.kept_us) & np.isfinite(values)
        self.history.put([(int(t), float(v)) for t, v in zip(us[recent], values[recent])])
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(int(us[-1] + self.kept_us) // 1000 + 1)
        fresh = fresh.assign(deviation=deviation)
        found = fresh[fresh["deviation"].abs() > self.spec.threshold]
        if len(found):
            yield found.drop(columns=["event_us", "event_value"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """No row to come can have this key's rows in its history."""
        self.history.clear()
        return iter(())

    def close(self) -> None:
        pass


def anomalies_stream(stream: DataFrame, spec: DetectorSpec, ts: str = "timestamp",
                     late_seconds: int = 3600) -> DataFrame:
    """``(timestamp, datapoint, deviation)`` for a stream of rows.

    Rows of a micro-batch are taken in event-time order, so a stream read in time order
    gives what ``operators.detector.anomalies`` gives. A row that is late by up to
    ``late_seconds`` meets the history it would have had in time; later ones are dropped and
    counted by Spark (``numRowsDroppedByWatermark``). A key's state goes when no row to come
    can need it. Limit the source's batch size to bound what one key gathers at a time.
    """
    use_rocksdb(stream.sparkSession)
    stream = stream.withWatermark(ts, f"{late_seconds} seconds")
    timed = stream.withColumn("event_us", F.unix_micros(ts)).withColumn("event_value", F.col(spec.value).cast("double"))
    fields = [f for f in stream.schema.fields]
    out = StructType([*fields, StructField("deviation", DoubleType())])
    found = timed.groupBy(*spec.key).transformWithStateInPandas(
        statefulProcessor=KeyHistory(spec, late_seconds), outputStructType=out, outputMode="append",
        timeMode="EventTime")
    return found.select(
        F.col(ts).alias("timestamp"), F.struct(*stream.columns).alias("datapoint"), "deviation")
