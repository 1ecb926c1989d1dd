"""Helpers the operators share: tables, identical text rules, work units and connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.session import work_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder: it is computed once and outlives lost executors."""
    path = work_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII takes the fast built-in, which does the same there."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def split_join(rows: DataFrame, side: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join rows to an aggregated ``side`` so that a key with very many rows can be split.

    An aggregate leaves its side dealt by the keys, and adaptive execution does not split
    what it cannot deal anew. With a hash of the keys as a further key both sides are.
    """
    def marked(df: DataFrame) -> DataFrame:
        return df.withColumn("join_mark", F.xxhash64(*keys))

    return marked(rows).join(marked(side), ["join_mark", *keys], how).drop("join_mark")


def in_units(rows: DataFrame, keys: list[str], spread: Column, rows_per_block: int) -> DataFrame:
    """Cut each group of ``keys`` into work units that together meet every pair of its rows.

    A group of m rows gets ``c = ceil(m / rows_per_block)`` blocks, chosen by ``spread``, and
    a unit for each pair of blocks (and each block with itself). A row is copied to the c
    units of its block, so no unit has more than about two blocks and none is dropped.
    Groups of one row meet nobody and go. Adds ``unit_a``, ``unit_b`` and ``block``.
    """
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("unit_rows")).where("unit_rows > 1")
    cut = split_join(rows, sizes, keys).withColumn("unit_n", F.ceil(F.col("unit_rows") / rows_per_block))
    cut = cut.withColumn("block", F.pmod(spread, F.col("unit_n")).cast("int"))
    cut = cut.withColumn("unit_j", F.explode(F.sequence(F.lit(0), F.col("unit_n").cast("int") - 1)))
    return cut.withColumn("unit_a", F.least("block", "unit_j")).withColumn(
        "unit_b", F.greatest("block", "unit_j")).drop("unit_rows", "unit_n", "unit_j")


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for links ``a, b``: root is the smallest node that can be reached.

    Alternating star contraction. In turn every node ties its larger neighbours, then its
    smaller ones, to the smallest node it knows, until nothing changes; the number of rounds
    grows with the logarithm of the longest path. Each step groups with partial minima and
    joins on the node, which adaptive execution splits for a node with very many links. Each
    round is a written table, and the driver sees two numbers a round.
    """
    edges = _stars(written(links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"))
    before = None
    while True:
        edges = written(edges, "stars")
        # sums of hashes stand for the set of edges
        state = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                edges.select(F.col("b"), F.col("b")).distinct())
        before, edges = state, _stars(edges)


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over edges ``a > b``."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    large = split_join(both, least, ["a"]).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    return split_join(large, least, ["a"]).select(F.explode(F.array(
        F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))
    )).alias("e")).select("e.*").where("a <> b").distinct()


def texts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` alone, a null text as the empty one; no other column can clash."""
    return docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def kind(df: DataFrame, column: str) -> str:
    """The column's type as DDL, to declare what a function over Arrow batches returns."""
    return df.schema[column].dataType.simpleString()


def in_slices(parts: Iterator[pa.RecordBatch], column: int, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut into runs of rows with about ``most`` bytes of a text column, one row at least.

    Spark fills a batch by rows, so one may hold all texts of a task; what a function makes of a
    batch, and what goes back at once, is bounded by these runs instead.
    """
    for part in parts:
        ends = np.cumsum(pc.fill_null(pc.binary_length(part.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < part.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield part.slice(start, stop - start)
            start = stop


class Memo(dict):
    """A bounded memo for short keys, in two generations of at most ``most / 2``: when the new one
    is full it takes the place of the old one, whose keys live on if they were met again. Long
    keys are computed anew."""

    def __init__(self, make: Callable, most: int = 300_000, longest: int = 64):
        super().__init__()
        self.make, self.half, self.longest, self.old = make, most // 2, longest, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.half:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value
