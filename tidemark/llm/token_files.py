"""Token identifiers in files of interleaved range-ANS blocks.

One table of frequencies, counted over all identifiers, is shared by all blocks. A block's
identifiers are dealt in turn to many independent coder states, which numpy moves together,
and the words they shed stand in the order the decoder takes them up. At regular steps the
states and the place among the words are kept as checkpoints, from which decoding can start
in the middle; checksums guard the table, the body and the decoded identifiers.

A file set is a folder: ``table`` (identifier, frequency), ``blocks`` (one row per block with
its documents) and ``parts`` (where each sorted part begins), written last.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.llm.common import kind, table, written
from tidemark.llm.packing import token_ids
from tidemark.session import small_side, work_dir

LOW = np.uint64(1 << 31)  # states stay from here to 2^63, and shed a word at a time
WORD = np.uint64(32)
LOWER = np.uint64((1 << 32) - 1)
HEADER = struct.Struct("<4sHHIIQQIIII")
MAGIC, VERSION = b"TRNS", 1


class FrequencyTable:
    """Frequencies that sum to ``2 ** scale``, one at least for each identifier that occurs."""

    def __init__(self, ids: np.ndarray, frequencies: np.ndarray, scale: int):
        self.scale = scale
        size = int(ids.max()) + 1 if len(ids) else 0
        f = np.zeros(size, np.uint64)
        f[ids] = frequencies
        # a frequency and, below it, the sum of those before: one look-up gives both
        self.both = f << WORD | np.cumsum(f, dtype=np.uint64) - f
        self.symbols = np.repeat(np.arange(size, dtype=np.uint32), f.astype(np.int64))
        self.check = zlib.crc32(f.tobytes())


def scaled(counts: np.ndarray, scale: int) -> np.ndarray:
    """Frequencies in proportion to ``counts``; what rounding leaves goes to the largest."""
    total, free = int(counts.sum()), (1 << scale) - len(counts)
    found = np.array([1 + int(c) * free // total for c in counts], np.int64)
    if len(found):
        found[np.argmax(counts)] += (1 << scale) - int(found.sum())
    return found


def encode_block(ids: np.ndarray, t: FrequencyTable, most_lanes: int = 4096, every: int = 128) -> bytes:
    """One block. Identifier ``i`` goes to lane ``i % lanes`` in step ``i // lanes``; a checkpoint
    stands before every ``every``-th step. Short blocks have fewer lanes, as each costs 8 bytes."""
    n = len(ids)
    if n and (ids.max() >= len(t.both) or not (t.both[ids] >> WORD).all()):
        raise ValueError("an identifier is not in the table of frequencies")
    lanes = min(most_lanes, 1 << max(0, (n // 64).bit_length() - 1))
    steps = -(-n // lanes)
    scale, reach = np.uint64(t.scale), np.uint64(63 - t.scale)
    x = np.full(lanes, LOW, np.uint64)
    shed, states, places = [], [], []
    count = 0
    for step in reversed(range(steps)):
        at = slice(step * lanes, min(n, (step + 1) * lanes))
        now = x[:at.stop - at.start]
        both = t.both[ids[at]]
        f = both >> WORD
        full = np.flatnonzero(now >= f << reach)
        part = now[full]
        shed.append(part.astype(np.uint32))
        count += len(part)
        now[full] = part >> WORD
        quotient = now // f
        now[:] = (quotient << scale) + (now - quotient * f) + (both & LOWER)
        if step % every == 0:
            states.append(x.copy())
            places.append(count)
    words = np.concatenate(shed[::-1]) if shed else np.zeros(0, np.uint32)
    starts = (count - np.array(places[::-1], np.uint64)).astype("<u8")
    body = starts.tobytes() + b"".join(s.astype("<u8").tobytes() for s in states[::-1]) + words.astype("<u4").tobytes()
    return HEADER.pack(MAGIC, VERSION, t.scale, lanes, every, n, count, len(starts), t.check, zlib.crc32(body),
                       zlib.crc32(ids.astype("<u4"))) + body


def decode_block(blob: bytes, t: FrequencyTable, first: int = 0, last: int | None = None) -> np.ndarray:
    """Identifiers ``first`` to ``last`` of a block, from the checkpoint before ``first`` on. A whole
    block's checksum is compared; a damaged block or another table is an error."""
    magic, version, scale, lanes, every, n, count, n_starts, table_check, body_check, ids_check = HEADER.unpack_from(blob)
    body = memoryview(blob)[HEADER.size:]
    if (magic, version) != (MAGIC, VERSION) or zlib.crc32(body) != body_check:
        raise ValueError("damaged block")
    if (scale, table_check) != (t.scale, t.check):
        raise ValueError("the block was written with another table of frequencies")
    last = n if last is None else min(last, n)
    if first >= last:
        return np.zeros(0, np.uint32)
    starts = np.frombuffer(body, "<u8", n_starts)
    states = np.frombuffer(body, "<u8", n_starts * lanes, 8 * n_starts).reshape(n_starts, lanes)
    words = np.frombuffer(body, "<u4", count, 8 * n_starts * (1 + lanes)).astype(np.uint64)
    mark = first // lanes // every
    x, place = states[mark].astype(np.uint64), int(starts[mark])
    begin = mark * every
    out = np.empty(min(n, -(-last // lanes) * lanes) - begin * lanes, np.uint32)
    mask, scale = np.uint64((1 << scale) - 1), np.uint64(scale)
    for step in range(begin, -(-last // lanes)):
        at = (step - begin) * lanes
        now = x[:len(out) - at]
        slot = now & mask
        symbol = t.symbols[slot]
        out[at:at + len(now)] = symbol
        both = t.both[symbol]
        now = (both >> WORD) * (now >> scale) + slot - (both & LOWER)
        short = np.flatnonzero(now < LOW)
        now[short] = now[short] << WORD | words[place:place + len(short)]
        place += len(short)
        x[:len(now)] = now
    if first == 0 and last == n and zlib.crc32(out.astype("<u4")) != ids_check:
        raise ValueError("decoded identifiers do not match their checksum")
    return out[first - begin * lanes:last - begin * lanes]


@lru_cache(maxsize=2)
def _table(ids: bytes, frequencies: bytes, scale: int) -> FrequencyTable:
    return FrequencyTable(np.frombuffer(ids, "<i8"), np.frombuffer(frequencies, "<i8"), scale)


def to_planes(ids: bytes) -> bytes:
    """32-bit identifiers as four runs of their first, second, third and fourth bytes, which
    compress to about half where rows are kept and shuffled."""
    return np.frombuffer(ids, np.uint8).reshape(-1, 4).T.tobytes()


def from_planes(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def in_planes(tokens: DataFrame) -> DataFrame:
    """``doc_id, ids`` with ``to_planes`` of ``ids``; null as no identifiers."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            planes = pa.array([to_planes(v) for v in part.column(1).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column(0), planes], ["doc_id", "ids"])

    return tokens.select("doc_id", F.coalesce("ids", F.lit(b"")).alias("ids")).mapInArrow(
        batches, f"doc_id {kind(tokens, 'doc_id')}, ids binary")


def counted(values: Iterator[np.ndarray], at_once: int = 1 << 20) -> np.ndarray:
    """How often each identifier stands in ``values``. A count goes over the whole vocabulary, so it is
    made of ``at_once`` identifiers or more, not value by value."""
    total, held, size = np.zeros(0, np.int64), [], 0
    for value in chain(values, [None]):
        if value is not None:
            held.append(value)
            size += len(value)
        if held and (value is None or size >= at_once):
            seen = np.bincount(np.concatenate(held), minlength=len(total))
            seen[:len(total)] += total
            total, held, size = seen, [], 0
    return total


def count_ids(rows: DataFrame) -> DataFrame:
    """``id, count`` over all identifiers of ``in_planes``. A task gives one row per identifier it met."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = counted(from_planes(value.as_py()) for part in parts for value in part.column(0))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["id", "count"])

    return rows.select("ids").mapInArrow(batches, "id long, count long").groupBy("id").agg(
        F.sum("count").alias("count"))


def write_table(rows: DataFrame, path: str, scale: int = 20) -> tuple[bytes, bytes, int]:
    """Count, scale and store the shared table. The driver sees a row per identifier, which the
    vocabulary bounds; ``scale`` grows until every identifier has four places in the mean."""
    found = sorted((r["id"], r["count"]) for r in count_ids(rows).collect())
    scale = max(scale, len(found).bit_length() + 2)
    if scale > 30:
        raise ValueError("too many different identifiers")
    ids, counts = (np.array(x, np.int64) for x in (zip(*found) if found else ((), ())))
    frequencies = scaled(counts, scale)
    found = [(int(i), int(f), scale) for i, f in zip(ids, frequencies)]
    rows.sparkSession.createDataFrame(found, "id long, frequency long, scale int").coalesce(1).write.parquet(f"{path}/table")
    return ids.astype("<i8").tobytes(), frequencies.astype("<i8").tobytes(), scale


def read_table(spark: SparkSession, path: str) -> tuple[bytes, bytes, int]:
    rows = sorted(tuple(r) for r in spark.read.parquet(f"{path}/table").collect())
    ids, frequencies, scales = zip(*rows) if rows else ((), (), (20,))
    return np.array(ids, "<i8").tobytes(), np.array(frequencies, "<i8").tobytes(), scales[0]


def write_tokens(tokens: DataFrame, path: str, block_ids: int = 1 << 20, planes: bool = False) -> None:
    """Write ``doc_id, ids`` (binary: little-endian unsigned 32-bit, or ``to_planes`` of that) as a
    file set, by ascending ``doc_id``; null identifiers of documents come first, rows of one
    identifier in any order.

    A document that fits stands in one block of at most ``block_ids`` identifiers; longer ones
    are cut. Null or empty ``ids`` are documents of no tokens. The rows are kept once, so the
    ranges are drawn from and dealt by the same order whenever a task is repeated; identifiers
    that very many rows share are spread over parts by their place.
    """
    rows = written(tokens.select("doc_id", "ids") if planes else in_planes(tokens), "token-rows")
    coder = write_table(rows, path)
    order = ["doc_id", "mix", "place"]
    placed = rows.withColumn("place", F.monotonically_increasing_id()).withColumn("mix", F.xxhash64("place"))
    sorted_ = placed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "ids")
    doc = f"struct<doc_id: {kind(rows, 'doc_id')}, row: long, start: long, n_tokens: long, begin: long, length: long>"

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, number = _table(*coder), TaskContext.get().partitionId()
        held: list[bytes] = []
        docs: list[tuple] = []
        size = block = written_ = row = start = 0
        fields = ["doc_id", "row", "start", "n_tokens", "begin", "length"]

        def out(id_type: pa.DataType) -> pa.RecordBatch:
            nonlocal held, docs, size, block, written_
            ids = np.frombuffer(b"".join(held), "<u4")
            arrays = [pa.array(c, k) for c, k in zip(zip(*docs), [id_type, *[pa.int64()] * 5])]
            listed = pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), pa.StructArray.from_arrays(arrays, fields))
            found = pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([block]), pa.array([written_]), pa.array([size]), listed,
                 pa.array([encode_block(ids, t)], pa.binary())], ["part", "block", "first", "n_ids", "docs", "payload"])
            held, docs, written_, size, block = [], [], written_ + size, 0, block + 1
            return found

        id_type = None
        for part in parts:
            id_type = part.schema.field(0).type
            for name, ids in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                ids, n = from_planes(ids).tobytes(), len(ids) // 4
                if docs and size + n > block_ids:
                    yield out(id_type)
                for begin in range(0, n, block_ids) or (0,):
                    piece = ids[4 * begin:4 * (begin + block_ids)]
                    if docs and size + len(piece) // 4 > block_ids:
                        yield out(id_type)
                    held.append(piece)
                    docs.append((name, row, start, n, begin, len(piece) // 4))
                    size += len(piece) // 4
                row, start = row + 1, start + n
        if docs:
            yield out(id_type)

    sorted_.mapInArrow(batches, (
        f"part long, block long, first long, n_ids long, docs array<{doc}>, payload binary")).write.option(
            "compression", "none").parquet(f"{path}/blocks")
    parts = rows.sparkSession.read.parquet(f"{path}/blocks").groupBy("part").agg(
        F.sum("n_ids").alias("n_ids"), F.sum(F.size("docs")).alias("n_pieces"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per part
    parts.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0))).coalesce(1).write.parquet(f"{path}/parts")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document of a file set: ``start`` counts the
    identifiers of all documents before it. Blocks are decoded independently; only documents
    cut into several blocks are put together by a shuffle, from the blocks that hold a piece of one."""
    coder = read_table(spark, path)
    blocks = spark.read.parquet(f"{path}/blocks")
    id_type = blocks.schema["docs"].dataType.elementType["doc_id"].dataType.simpleString()

    def batches(arrived: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _table(*coder)
        for rows in arrived:
            for number, listed, payload in zip(rows.column(0), rows.column(1), rows.column(2)):
                docs = listed.values
                lengths = docs.field("length").to_numpy()
                ends = np.zeros(len(lengths) + 1, np.int64)
                np.cumsum(lengths, out=ends[1:])
                flat = decode_block(payload.as_buffer().to_pybytes(), t).astype("<u4")
                if len(flat) != ends[-1]:
                    raise ValueError("the block's documents do not add up")
                ids = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), [
                    None, pa.py_buffer(4 * ends), pa.py_buffer(flat)]).cast(pa.binary())
                names = ["doc_id", "row", "start", "n_tokens", "begin"]
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(number, len(lengths)), *[docs.field(f) for f in names], ids], ["part", *names, "ids"])

    base = small_side(spark.read.parquet(f"{path}/parts").select("part", "base"), 200_000)

    def decoded(some: DataFrame) -> DataFrame:
        pieces = some.select("part", "docs", "payload").mapInArrow(batches, (
            f"part long, doc_id {id_type}, row long, start long, n_tokens long, begin long, ids binary"))
        return pieces.join(base, "part").withColumn("start", F.col("start") + F.col("base"))

    is_whole = F.octet_length("ids") == F.col("n_tokens") * 4
    whole = decoded(blocks).where(is_whole)
    holds_cut = F.exists("docs", lambda d: d["length"] < d["n_tokens"])
    cut = decoded(blocks.where(holds_cut)).where(~is_whole).groupBy("part", "row").agg(
        F.first("doc_id").alias("doc_id"), F.first("start").alias("start"), F.first("n_tokens").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("begin", "ids"))).alias("pieces"))
    joined = F.aggregate("pieces", F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
    columns = ["doc_id", "start", "n_tokens", "ids"]
    return whole.select(*columns).union(cut.withColumn("ids", joined).select(*columns))


def read_span(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """``start, ids``: the identifiers from place ``first`` to ``last`` of the whole file set, a row per
    block that holds some. Only those blocks are read, each from the checkpoint before ``first`` on."""
    coder = read_table(spark, path)
    base = small_side(spark.read.parquet(f"{path}/parts").where(
        (F.col("base") < last) & (F.col("base") + F.col("n_ids") > first)).select("part", "base"), 200_000)
    blocks = spark.read.parquet(f"{path}/blocks").select("part", "first", "n_ids", "payload").join(base, "part")
    start = F.col("base") + F.col("first")
    blocks = blocks.where((start < last) & (start + F.col("n_ids") > first)).select(
        start.alias("start"), "payload")

    def batches(arrived: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _table(*coder)
        for rows in arrived:
            for at, payload in zip(rows.column(0).to_pylist(), rows.column(1)):
                low = max(0, first - at)
                ids = decode_block(payload.as_buffer().to_pybytes(), t, low, last - at).astype("<u4").tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([at + low]), pa.array([ids], pa.binary())], ["start", "ids"])

    return blocks.mapInArrow(batches, "start long, ids binary")


def op13_token_files(spark, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "token-files")
    write_tokens(token_ids(table(spark, sf_dir, "documents"), end_id=2, layout=to_planes), path, planes=True)
    return read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
