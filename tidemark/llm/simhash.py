"""SimHash near-duplicates over a Gray-order hierarchical index.

Texts become 64-bit fingerprints; equal ones are merged first. Two fingerprints that differ
in at most ``limit`` bits agree in whole in one of ``limit + 1`` parts, so each is dealt
once for each part by that part's bits: these are the upper nodes, whose pattern all below
them share. Below a node, fingerprints stand in Gray order, so neighbours share long masked
patterns; nodes of the index hold those patterns, and a pair of nodes is dropped with all
below it once the differences of the patterns exceed the limit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import components, in_slices, in_units, kind, split_join, table, texts, written

LOWERED = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
BITS = 64


def shingle_hashes(text: str, shingle: int = 3, seed: int = 42) -> np.ndarray:
    """A hash of each shingle of a whole text, repeats included; none without words.

    A-Z are lower-cased, words are runs of other characters than ASCII white space, shingles
    are words joined by a space (all words where there are fewer).
    """
    words = text.encode().translate(LOWERED).split()
    if not words:
        return np.empty(0, "<u8")
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends.tolist()]
    ends = (ends - 1).tolist()[shingle - 1:] or [len(line)]
    view, digest = memoryview(line), xxhash.xxh64_intdigest
    return np.fromiter((digest(view[a:b], seed) for a, b in zip(starts, ends)), "<u8", len(ends))


def fingerprint(text: str, shingle: int = 3, seed: int = 42) -> int:
    """The SimHash of a whole text; 0 without words. A bit is set if it is set in more than
    half of the shingles' hashes, repeats counted."""
    hashes = shingle_hashes(text, shingle, seed)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 8192):  # bounds memory for very long texts
        part = hashes[at:at + 8192].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = 3) -> DataFrame:
    """``doc_id, fp`` of each whole text, ``fp`` as a signed 64-bit integer; null texts are empty."""
    docs = texts(docs, id_column, text_column)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_slices(parts, 1):
            found = np.array([fingerprint(t.as_py(), shingle) for t in part.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found)], ["doc_id", "fp"])

    return docs.mapInArrow(batches, f"doc_id {kind(docs, 'doc_id')}, fp long")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of each code in the Gray sequence: the inverse of ``x ^ (x >> 1)``."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Levels of nodes over fingerprints in Gray order; each node has the bits that all below share.

    ``all_set`` and ``any_set`` are the AND and OR of a node's fingerprints, so the shared
    mask is where they agree.
    """

    def __init__(self, codes: np.ndarray, fan: int = 16):
        self.fan, self.codes = fan, codes
        self.levels = [(codes, codes)]
        while len(self.levels[-1][0]) > 1:
            low, high = self.levels[-1]
            starts = np.arange(0, len(low), fan)
            self.levels.append((np.bitwise_and.reduceat(low, starts), np.bitwise_or.reduceat(high, starts)))

    def pairs(self, limit: int, at_once: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places ``i < j`` of all fingerprints that differ in at most ``limit`` bits, in blocks."""
        top = np.zeros(min(1, len(self.levels) - 1), np.int64)  # a fingerprint alone has no pair
        stack = [(len(self.levels) - 1, top, top)]
        while stack:
            level, a, b = stack.pop()
            low, high = self.levels[level]
            shared = ~(low[a] ^ high[a]) & ~(low[b] ^ high[b])
            near = np.bitwise_count((low[a] ^ low[b]) & shared) <= limit
            a, b = a[near], b[near]
            if level == 0:
                if len(a):
                    yield a, b
                continue
            below = len(self.levels[level - 1][0])
            for at in range(0, len(a), max(1, at_once // self.fan ** 2)):
                part = slice(at, at + max(1, at_once // self.fan ** 2))
                step = np.arange(self.fan)
                x = np.broadcast_to(a[part, None, None] * self.fan + step[:, None], (len(a[part]), self.fan, self.fan))
                y = np.broadcast_to(b[part, None, None] * self.fan + step, x.shape)
                ok = (x < below) & (y < below) & ((x < y) if level == 1 else (x <= y))
                stack.append((level - 1, x[ok], y[ok]))


def spanning(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For each of ``n`` places the smallest one that pairs connect it with."""
    root = np.arange(n)
    for a, b in pairs:
        while True:
            ra, rb = root[a], root[b]
            apart = ra != rb
            if not apart.any():
                break
            high, low = np.maximum(ra, rb)[apart], np.minimum(ra, rb)[apart]
            np.minimum.at(root, high, low)
            while not np.array_equal(root, again := root[root]):
                root = again
            a, b = a[apart], b[apart]
    return root


def unit_links(codes: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is near in one unit: every fingerprint with the first of its class."""
    codes = codes[np.argsort(gray_rank(codes), kind="stable")]
    if len(codes) <= 2:  # most units
        near = len(codes) == 2 and int(codes[0] ^ codes[1]).bit_count() <= limit
        return (codes[:1], codes[1:]) if near else (codes[:0], codes[:0])
    root = spanning(len(codes), GrayIndex(codes).pairs(limit))
    tied = np.flatnonzero(root != np.arange(len(codes)))
    return codes[root[tied]], codes[tied]


def near_links(distinct: DataFrame, limit: int = 3, rows_per_block: int = 1024) -> DataFrame:
    """Links ``a, b`` between the distinct ``fp`` that connect all that differ in at most
    ``limit`` bits. A unit gives a link for each fingerprint it ties, not all its pairs."""
    width = BITS // (limit + 1)
    parts = F.array(*[F.expr(f"shiftrightunsigned(fp, {width * i}) & {(1 << width) - 1}") for i in range(limit + 1)])
    dealt = distinct.select("fp", F.posexplode(parts).alias("part", "bits"))
    units = in_units(dealt, ["part", "bits"], F.xxhash64("fp"), rows_per_block)
    keys = ["part", "bits", "unit_a", "unit_b"]
    units = units.select(*keys, "fp").repartition(*keys).sortWithinPartitions(*keys)

    def batches(arrived: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, codes in by_key(arrived, 4):
            a, b = unit_links(codes[0].view(np.uint64), limit)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    return units.mapInArrow(batches, "a long, b long")


def by_key(arrived: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[tuple, list[np.ndarray]]]:
    """Sorted batches cut into units: the integer keys in the first columns, and the rest as
    numpy columns. A unit may span batches; one unit is held at a time."""
    held: list[pa.RecordBatch] = []

    def cut(batch: pa.RecordBatch) -> list[pa.RecordBatch]:
        keys = [c.to_numpy() for c in batch.columns[:n_keys]]
        new = np.flatnonzero(np.logical_or.reduce([k[1:] != k[:-1] for k in keys])) + 1
        bounds = [0, *new.tolist(), batch.num_rows]
        return [batch.slice(a, b - a) for a, b in zip(bounds, bounds[1:])]

    def unit() -> tuple[tuple, list[np.ndarray]]:
        key = tuple(c[0].as_py() for c in held[0].columns[:n_keys])
        rest = [as_numpy([b.column(i) for b in held]) for i in range(n_keys, held[0].num_columns)]
        return key, rest

    for batch in arrived:
        if not batch.num_rows:
            continue
        for part in cut(batch):
            if held and any(held[0].column(i)[0] != part.column(i)[0] for i in range(n_keys)):
                yield unit()
                held = []
            held.append(part)
    if held:
        yield unit()


def as_numpy(columns: list[pa.Array]) -> np.ndarray:
    """One column of a unit; lists of equal length become rows of a matrix."""
    if pa.types.is_list(columns[0].type):
        return np.concatenate([c.flatten().to_numpy(zero_copy_only=False).reshape(len(c), -1) for c in columns])
    return np.concatenate([c.to_numpy(zero_copy_only=False) for c in columns])


def near_groups(docs: DataFrame, limit: int = 3, id_column: str = "doc_id", text_column: str = "text",
                shingle: int = 3) -> DataFrame:
    """One row per document: ``doc_id, fp, component_id``, the smallest identifier it can reach.

    Documents with equal fingerprints are in one component, those of texts without words
    (null and empty ones too) included; identifiers that are null are reached, not named,
    unless a component has no other. Repeated rows come back one for one.
    """
    found = written(fingerprints(docs, id_column, text_column, shingle), "fingerprints")
    distinct = written(found.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = components(near_links(distinct.select("fp"), limit))
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = written(rooted, "rooted")
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = written(split_join(rooted, names, ["root"]).select("fp", "component_id"), "components")
    return found.join(named, "fp").select("doc_id", "fp", "component_id")


def op6_simhash(spark, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
