"""Near-duplicate vectors by rotated binary codes with stored correction factors.

A unit vector x is turned by a random rotation; its code is the signs, and the factor
f = <x, code> / sqrt(D) says how well the code stands for it. For another unit vector y,
<y, code> / (sqrt(D) f) estimates <x, y> without bias, and its error stays, except with
the small chance that ``sigmas`` sets, below sigmas sqrt((1 - f^2) / (f^2 (D - 1))). Pairs
whose estimate lies below the limit by more than that are dropped; the others are computed
exactly. Which pairs are looked at is decided by rotated keys: the largest coordinate of a
few further rotations.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import components, in_units, split_join, table, written
from tidemark.llm.simhash import by_key, spanning


@dataclass(frozen=True)
class VectorRule:
    """``tables`` keys of ``depth`` rotations each are tried. A key has (2 D) ** depth values, so
    more depth suits more vectors, and more tables make up for what it misses."""
    limit: float = 0.93
    tables: int = 12
    depth: int = 2
    sigmas: float = 4.0
    rows_per_block: int = 1024
    seed: int = 5


def rotation(size: int, seed: int) -> np.ndarray:
    """A random rotation, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def units(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; scaling by the largest value first keeps squares in range."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def keys_of(x: np.ndarray, rule: VectorRule) -> np.ndarray:
    """For each row and table the place and sign of the largest coordinate under each rotation."""
    size = x.shape[1]
    out = np.zeros((len(x), rule.tables), np.int64)
    for t in range(rule.tables):
        for d in range(rule.depth):
            turned = x @ rotation(size, rule.seed + 1 + t * rule.depth + d)
            at = np.abs(turned).argmax(axis=1)
            out[:, t] = out[:, t] * (2 * size) + 2 * at + (turned[np.arange(len(x)), at] < 0)
    return out


def codes_of(x: np.ndarray, rule: VectorRule) -> tuple[np.ndarray, np.ndarray]:
    """Sign bits, packed, and the factor of each unit row."""
    turned = x @ rotation(x.shape[1], rule.seed)
    return np.packbits(turned > 0, axis=1), np.abs(turned).sum(axis=1) / np.sqrt(x.shape[1])


def usable(v: DataFrame) -> DataFrame:
    """The rows whose vector can link: a label, no missing or non-finite component, not zero."""
    finite = F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return v.where(F.col("label").isNotNull() & F.coalesce(finite & F.exists("vector", lambda c: c != 0), F.lit(False)))


def coded(distinct: DataFrame, rule: VectorRule) -> DataFrame:
    """``node, label, size, vector`` plus ``code, factor, keys``; vectors of one length share a batch's work."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            lists = part.column(3)
            lengths = np.diff(lists.offsets.to_numpy())
            for size in np.unique(lengths):
                some = part.take(pa.array(np.flatnonzero(lengths == size)))
                x = units(some.column(3).flatten().to_numpy().reshape(-1, size))
                bits, factor = codes_of(x, rule)
                code = pa.array([b.tobytes() for b in bits], pa.binary())
                keys = pa.FixedSizeListArray.from_arrays(pa.array(keys_of(x, rule).ravel()), rule.tables)
                yield pa.RecordBatch.from_arrays(
                    [*some.columns, code, pa.array(factor), keys.cast(pa.list_(pa.int64()))],
                    [*some.schema.names, "code", "factor", "keys"])

    return distinct.select("node", "label", "copies", "vector").mapInArrow(batches, (
        "node long, label long, copies long, vector array<double>, code binary, factor double, "
        "keys array<long>"))


def unit_pairs(x: np.ndarray, bits: np.ndarray, factor: np.ndarray, keys: np.ndarray, block: np.ndarray, at: int,
               rule: VectorRule, first: int, second: int, at_once: int = 512) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one unit with a cosine of at least the limit.

    A pair meets in every table whose keys agree; it counts in the first of them, ``at``.
    With two blocks only pairs across them count, the others being met in the blocks' own
    units.
    """
    size = x.shape[1]
    signs = (np.unpackbits(bits, axis=1, count=size).astype(np.float32) * 2 - 1) / np.float32(np.sqrt(size))
    turned = (x @ rotation(size, rule.seed)).astype(np.float32)
    slack = rule.sigmas * np.sqrt(np.maximum(1 - factor ** 2, 0) / (factor ** 2 * max(size - 1, 1)))
    left = np.flatnonzero(block == first)
    right = np.flatnonzero(block == second)
    for a in range(0, len(left), at_once):
        i = left[a:a + at_once]
        estimate = turned[i] @ signs[right].T / factor[right]
        maybe = estimate >= rule.limit - slack[right] - 1e-5
        if first == second:
            maybe &= right[None, :] > i[:, None]
        p, q = np.nonzero(maybe)
        p, q = i[p], right[q]
        near = (keys[p, :at] != keys[q, :at]).all(axis=1)
        p, q = p[near], q[near]
        exact = np.einsum("ij,ij->i", x[p], x[q]) >= rule.limit
        yield p[exact], q[exact]


def links(rows: DataFrame, rule: VectorRule) -> DataFrame:
    """``node, linked, other``: for a distinct vector in one unit the number of vectors it links
    to there, copies counted, and the first vector of its class there."""
    dealt = rows.select("node", "label", F.size("vector").alias("size"), "vector", "code", "factor", "copies", "keys",
                        F.posexplode("keys").alias("tab", "key"))
    cut = in_units(dealt, ["label", "size", "tab", "key"], F.xxhash64("node"), rule.rows_per_block)
    by = ["label", "size", "tab", "key", "unit_a", "unit_b"]
    cut = cut.select(*by, "node", "block", "copies", "factor", "vector", "keys", "code")
    cut = cut.repartition(*by).sortWithinPartitions(*by)

    def batches(arrived: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, (node, block, copies, factor, vector, keys, code) in by_key(arrived, len(by)):
            x = units(vector)
            bits = np.stack([np.frombuffer(c, np.uint8) for c in code])
            linked = np.zeros(len(node), np.int64)

            def counted():
                for p, q in unit_pairs(x, bits, factor, keys, block, key[2], rule, key[4], key[5]):
                    np.add.at(linked, p, copies[q])
                    np.add.at(linked, q, copies[p])
                    yield p, q

            root = spanning(len(node), counted())
            some = np.flatnonzero(linked)
            if len(some):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node[some]), pa.array(linked[some]), pa.array(node[root[some]])], ["node", "linked", "other"])

    return cut.mapInArrow(batches, "node long, linked long, other long")


def near_vectors(vectors: DataFrame, rule: VectorRule = VectorRule(), id_column: str = "vec_id",
                 vector_column: str = "embedding", label_column: str = "label") -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    Two vectors link when their labels are equal and not null and their cosine, in double
    precision, is at least ``rule.limit``. Vectors that are null, zero or hold null or
    non-finite components, and those of different lengths, link with nothing. No pair below
    the limit is linked; a pair above it is missed if no table's keys agree or its estimate is
    beyond its bound. Equal vectors of a label are one node, so their links are not searched
    for. Labels are integers. A component is named by an identifier that is not null, if it
    has one.

    A key's vectors are met in blocks, so one key may hold any share of all rows, and a unit
    gives counts and one link per vector instead of its pairs.
    """
    every = vectors.select(F.col(id_column).alias("vec_id"), F.col(label_column).cast("long").alias("label"),
                           F.col(vector_column).cast("array<double>").alias("vector"))
    nodes = usable(every).groupBy("label", "vector").agg(
        F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"))
    nodes = written(nodes.withColumn("node", F.monotonically_increasing_id()), "vectors")
    found = written(links(written(coded(nodes, rule), "codes"), rule), "vector-links")
    roots = components(found.select(F.col("node").alias("a"), F.col("other").alias("b")))
    counts = found.groupBy("node").agg(F.sum("linked").alias("linked"))
    joined = written(nodes.join(counts, "node", "left").join(roots, "node", "left").select(
        "label", "vector", "least", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("root", "node").alias("root")), "vector-nodes")
    names = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    named = written(split_join(joined, names, ["root"]).select("label", "vector", "n_links", "component_id"),
                    "vector-components")
    return every.join(named, ["label", "vector"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id")).withColumn(
            "kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op8_embeddings(spark, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
