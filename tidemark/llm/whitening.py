"""Whitening of vectors by a polarisation covariance.

Entries become integers, so that sums are exact. The covariance of two dimensions is half of
what the variance of their sum exceeds their own variances by; hence only squares of centred
values are added up, for every dimension and every sum of two. Values are centred at the
whole part of the mean, y = x - floor(S / n). With r, the sum of all y, the sum of (n x - S)^2
is n (n sum(y^2) - r^2), in whole numbers, with nothing lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import kind, table

SAFE = 1 << 62
LIMB = 1 << 60


@dataclass(frozen=True)
class Fit:
    """What whitening needs: ``n`` vectors with sums ``total``, unit components in rows by
    falling ``eigenvalue``, and ``explained``, each one's share of the whole variance."""
    n: int
    total: tuple[int, ...]
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray

    @property
    def usable(self) -> np.ndarray:
        """Components along which the vectors vary by more than rounding."""
        largest = float(self.eigenvalues[0]) if len(self.eigenvalues) else 0.0
        return self.eigenvalues > largest * len(self.total) * np.finfo(float).eps


def whole_numbers(vectors: DataFrame, scale: int = 64, offset: int = 1_000_000, id_column: str = "vec_id",
                  vector_column: str = "embedding") -> DataFrame:
    """``vec_id, x``: each entry c as ``floor(scale * c) + offset``. Rows whose vector is null or
    holds null or non-finite entries go, and so do those with an entry beyond 2^52 after scaling,
    which a double does not hold to the unit."""
    c = F.col(vector_column).cast("array<double>")
    fine = F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) * scale < float(1 << 52)))
    return vectors.where(F.coalesce(fine, F.lit(False))).select(F.col(id_column).alias("vec_id"), F.transform(
        c, lambda v: (F.floor(v * scale) + offset).cast("long")).alias("x"))


def of_length(rows: DataFrame, size: int) -> DataFrame:
    return rows.where(F.size("x") == size)


def common_length(rows: DataFrame) -> int:
    """The commonest number of entries, the larger of equal ones; 0 without rows. Lengths are few."""
    top = rows.groupBy(F.size("x").alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy(
        F.desc("n"), F.desc("size")).first()
    return top["size"] if top else 0


def matrix(part: pa.Array, size: int) -> np.ndarray:
    return part.flatten().to_numpy().reshape(-1, size)


def sums(rows: DataFrame, size: int) -> tuple[int, list[int]]:
    """The number of vectors and the exact sum of each dimension."""
    values = [F.sum(F.get("x", F.lit(i)).cast("decimal(38,0)")).alias(f"s{i}") for i in range(size)]
    n, *total = rows.agg(F.count(F.lit(1)), *values).first()
    return n, [int(t or 0) for t in total]


def squares(y: np.ndarray) -> list[int]:
    """Exact sums of squares of the columns."""
    if not y.size:
        return [0] * y.shape[1]
    largest = int(np.abs(y).max())
    if largest * largest * len(y) >= SAFE:
        y = y.astype(object)
    return [int(v) for v in (y * y).sum(axis=0)]


def square_sums(rows: DataFrame, centre: list[int]) -> dict[tuple[int, int], int]:
    """Exact sums over all vectors of ``(x_i - c_i)^2`` under ``(i, i)`` and of
    ``(x_i - c_i + x_j - c_j)^2`` under ``(i, j)``. A task gives one row per pair of dimensions,
    and so much reaches the driver: the vector's length bounds it, not the number of vectors."""
    size = len(centre)
    pairs = [(i, j) for i in range(size) for j in range(i, size)]

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * len(pairs)
        at = np.array(centre, np.int64)
        for part in parts:
            y = matrix(part.column(0), size) - at
            found: list[int] = []
            for i in range(size):
                found += squares(np.column_stack([y[:, i:i + 1], y[:, i:i + 1] + y[:, i + 1:]]))
            total = [a + b for a, b in zip(total, found)]
        i, j = zip(*pairs)
        high, low = zip(*(divmod(t, LIMB) for t in total))  # two parts, so that no sum outgrows a decimal
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()), decimals(high), decimals(low)], ["i", "j", "high", "low"])

    found = rows.select("x").mapInArrow(batches, "i int, j int, high decimal(38,0), low decimal(38,0)")
    found = found.groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    return {(r["i"], r["j"]): int(r["high"]) * LIMB + int(r["low"]) for r in found}


def decimals(values) -> pa.Array:
    """Whole numbers as decimals; null where one has more than 38 digits."""
    return pa.array([str(v) if abs(v) < 10 ** 38 else None for v in values], pa.string()).cast(pa.decimal128(38, 0))


def covariance(n: int, total: list[int], centre: list[int], q: dict[tuple[int, int], int]) -> np.ndarray:
    """The covariance by polarisation, each entry rounded once from its exact fraction."""
    size = len(total)
    rest = [s - n * c for s, c in zip(total, centre)]

    def spread(i: int, j: int) -> int:
        """n times the sum of (n x_i - S_i)^2, or of the squared sum of two dimensions."""
        r = rest[i] if i == j else rest[i] + rest[j]
        return n * q[i, j] - r * r

    out = np.zeros((size, size))
    for i in range(size):
        out[i, i] = float(Fraction(spread(i, i), n * n))
        for j in range(i + 1, size):
            out[i, j] = out[j, i] = float(Fraction(spread(i, j) - spread(i, i) - spread(j, j), 2 * n * n))
    return out


def fit(rows: DataFrame, size: int, components: int = 32) -> Fit:
    """The leading components of all ``rows``, which hold vectors of ``size`` entries."""
    n, total = sums(rows, size)
    if not n or not size:
        return Fit(n, tuple(total), np.zeros((0, size)), np.zeros(0), np.zeros(0))
    centre = [s // n for s in total]
    v = covariance(n, total, centre, square_sums(rows, centre))
    values, vectors = np.linalg.eigh(v)
    order = np.argsort(-values, kind="stable")[:components]
    trace = float(np.trace(v))
    return Fit(n, tuple(total), vectors[:, order].T.copy(), np.maximum(values[order], 0),
               np.maximum(values[order], 0) / trace if trace else np.zeros(len(order)))


def centred(x: np.ndarray, model: Fit) -> np.ndarray:
    """x - S / n in doubles: the whole part of the mean is taken off in whole numbers first."""
    whole = np.array([s // model.n for s in model.total], np.int64)
    rest = np.array([s % model.n / model.n for s in model.total])
    return (x - whole) - rest


def project(x: np.ndarray, model: Fit) -> np.ndarray:
    """Whitened values of the usable components, NaN for others."""
    out = np.full((len(x), len(model.components)), np.nan)
    some = model.usable
    out[:, some] = centred(x, model) @ model.components[some].T / np.sqrt(model.eigenvalues[some])
    return out


def deviations(x: np.ndarray, model: Fit) -> list[int]:
    """The exact sum over dimensions of ``(n x - S)^2``."""
    whole = np.array([s // model.n for s in model.total], np.int64)
    rest = [s % model.n for s in model.total]
    y = x - whole
    largest = (int(np.abs(y).max()) + 1) * model.n if y.size else 0
    if largest * largest * max(1, x.shape[1]) >= SAFE:
        y = y.astype(object)
    d = y * model.n - np.array(rest, y.dtype)
    return [int(v) for v in (d * d).sum(axis=1)]


def identity_error(rows: DataFrame, model: Fit) -> float | None:
    """The largest entry of the whitened vectors' covariance minus the identity, over usable
    components; null without any. A task gives one row per pair of components."""
    some = np.flatnonzero(model.usable)
    k, size = len(some), len(model.total)
    if not k:
        return None
    upper = np.triu_indices(k)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = np.zeros(k), np.zeros((k, k))
        for part in parts:
            w = project(matrix(part.column(0), size), model)[:, some]
            first += w.sum(axis=0)
            second += w.T @ w
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(upper[0], np.arange(k))), pa.array(np.append(upper[1], np.full(k, -1))),
             pa.array(np.append(second[upper], first))], ["i", "j", "v"])

    found = rows.select("x").mapInArrow(batches, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    value = {(r["i"], r["j"]): r["v"] / model.n for r in found.collect()}
    return max(abs(value[i, j] - value[i, -1] * value[j, -1] - (i == j)) for i, j in zip(*(u.tolist() for u in upper)))


def whiten(vectors: DataFrame, components: int = 32, id_column: str = "vec_id",
           vector_column: str = "embedding") -> DataFrame:
    """One row per vector: ``vec_id, n, deviation`` (decimal), ``whitened``, ``explained`` (one entry
    per component) and ``identity_error``.

    Vectors that are null or hold null, non-finite or too large entries (``whole_numbers``)
    have no row and no part in the fit; nor have those of another than the commonest length.
    Repeated rows count and come back one for one, a null identifier too. Along components
    without variance, as where all vectors are equal, ``whitened`` is null; so is a deviation of
    more than 38 digits.
    """
    rows = whole_numbers(vectors, id_column=id_column, vector_column=vector_column)
    size = common_length(rows)
    rows = of_length(rows, size)
    model = fit(rows, size, components)
    k = len(model.components)
    explained = model.explained.tolist()
    usable = model.usable

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            x = matrix(part.column(1), size)
            w = project(x, model)
            flat = pa.array(w.ravel(), mask=np.tile(~usable, len(x)))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), decimals(deviations(x, model)), pa.FixedSizeListArray.from_arrays(flat, k).cast(pa.list_(pa.float64()))],
                ["vec_id", "deviation", "whitened"])

    fields = f"vec_id {kind(rows, 'vec_id')}, deviation decimal(38,0), whitened array<double>"
    if not k:  # no rows, or vectors without entries
        return rows.limit(0).select("vec_id", F.lit(0).cast("long").alias("n"), F.lit(0).cast("decimal(38,0)").alias(
            "deviation"), F.array().cast("array<double>").alias("whitened"), F.array().cast("array<double>").alias(
                "explained"), F.lit(None).cast("double").alias("identity_error"))
    return rows.mapInArrow(batches, fields).select(
        "vec_id", F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.array(*[F.lit(e) for e in explained]).alias("explained"),
        F.lit(identity_error(rows, model)).cast("double").alias("identity_error"))


def by_component(whitened: DataFrame) -> DataFrame:
    """A row per vector and component, numbered from 1. A deviation beyond a long is null."""
    both = F.posexplode(F.arrays_zip("whitened", "explained")).alias("pos", "c")
    return whitened.select("vec_id", "n", "deviation", "identity_error", both).select(
        "vec_id", (F.col("pos") + 1).alias("component"), "n", F.expr("try_cast(deviation AS BIGINT)").alias("deviation"),
        F.col("c.whitened").alias("whitened"), F.col("c.explained").alias("explained"), "identity_error")


def op12_whitening(spark, sf_dir: str) -> DataFrame:
    return by_component(whiten(table(spark, sf_dir, "embeddings")))
