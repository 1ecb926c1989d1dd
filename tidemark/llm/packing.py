"""Packing documents into training windows by the online sum-of-squares rule.

Each task packs the documents it reads, in one pass and bounded memory. A document longer
than a window fills whole windows; what is left of it is placed, uncut, on the fill level
that makes the sum of squared counts of partly filled windows smallest. Those counts and
the open windows stand in an array with a place for each level.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import in_slices, kind, table, texts

SPECIAL = "<|endoftext|>"
MARK = "<|\x00|"  # begins the marks that stand between texts here; a text with it is encoded alone
ROW, CUT = MARK + "row|>", MARK + "cut|>"
#: What the pattern's ``\s`` matches.
SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
BEFORE_WORD = re.compile(f"[{SPACES}]{{2,}}(?=[^{SPACES}])")
BRANCH, PLAIN = r"|\s+(?!\S)|\s+", r"|\s+"


class ByteBpe:
    """Identifiers of a byte-level BPE.

    Of several white space characters before a word the pattern leaves the last one to the word,
    by a look-ahead that makes it slow. Texts are cut before that character instead, where no
    token crosses, and the pattern goes without it.
    """

    def __init__(self, path: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        if not public_tokenizers.PATTERN.endswith(BRANCH):
            raise ValueError("the pattern ends otherwise")
        self.n = len(ranks)
        # letters, the most frequent, are tried first; an apostrophe is none
        first = r" ?\p{L}+|"
        plain = first + public_tokenizers.PATTERN.removesuffix(BRANCH).replace("|" + first, "|") + PLAIN
        self.model = tiktoken.Encoding("byte_bpe", pat_str=plain, mergeable_ranks=ranks, special_tokens={
            SPECIAL: self.n, ROW: self.n + 1, CUT: self.n + 2})

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit identifiers of the whole text."""
        if SPECIAL in text:
            return np.array([self.n], "<u4").tobytes().join(self.encode(part) for part in text.split(SPECIAL))
        cuts = [0, *(m.end() - 1 for m in BEFORE_WORD.finditer(text)), len(text)]
        return b"".join(self.model.encode_to_numpy(text[a:b], allowed_special=set(), disallowed_special=()).astype(
            "<u4").tobytes() for a, b in zip(cuts, cuts[1:]))

    def encode_each(self, column: pa.Array, end_id: int) -> pa.Array:
        """``encode`` of each text, and ``end_id`` after it: all in one call, with a mark after each."""
        column = column.cast(pa.string())
        if pc.any(pc.or_(pc.match_substring(column, SPECIAL), pc.match_substring(column, MARK))).as_py():
            end = np.array([end_id], "<u4").tobytes()
            return pa.array([self.encode(t) + end for t in column.to_pylist()], pa.binary())
        if pc.any(pc.match_substring_regex(column, f"[{SPACES}]{{2}}")).as_py():
            column = pc.replace_substring_regex(column, f"([{SPACES}])([{SPACES}][^{SPACES}])", rf"\1{CUT}\2")
        ids = self.model.encode_to_numpy("".join(t + ROW for t in column.to_pylist()), allowed_special="all").astype("<u4")
        ids = ids[ids != self.n + 2]
        ends = np.flatnonzero(ids == self.n + 1)
        ids[ends] = end_id
        at = np.zeros(len(ends) + 1, np.int32)
        at[1:] = 4 * (ends + 1)
        return pa.BinaryArray.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(at), pa.py_buffer(ids)])


@lru_cache(maxsize=2)
def byte_bpe(path: str) -> ByteBpe:
    return ByteBpe(path)


Batches = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def token_batches(path: str | None = None, end_id: int = 1, layout: Callable[[bytes], bytes] | None = None) -> Batches:
    """What ``token_ids`` does with batches of ``doc_id, text``, for functions that go on with them."""
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path)
        for part in in_slices(parts, 1):
            ids = bpe.encode_each(part.column(1), end_id)
            if layout:
                ids = pa.array([layout(i) for i in ids.to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column(0), ids], ["doc_id", "ids"])

    return batches


def token_ids(docs: DataFrame, path: str | None = None, end_id: int = 1, id_column: str = "doc_id",
              text_column: str = "text", layout: Callable[[bytes], bytes] | None = None) -> DataFrame:
    """``doc_id`` and ``ids``, binary: little-endian unsigned 32-bit token identifiers of each
    whole text, then ``end_id``, as ``layout`` arranges them. A null or empty text has ``end_id``
    alone."""
    docs = texts(docs, id_column, text_column)
    return docs.mapInArrow(token_batches(path, end_id, layout), f"doc_id {kind(docs, 'doc_id')}, ids binary")


class Packer:
    """Online sum-of-squares packing of pieces ``(doc, start, ids, doc_tokens)``."""

    def __init__(self, window: int, open_windows: int):
        self.window, self.most = window, open_windows
        self.counts = np.zeros(window + 1, np.int64)  # open windows at each level; none is open at 0 or full
        self.open: list[list[list]] = [[] for _ in range(window)]
        self.n_open = 0

    def level(self, size: int) -> int:
        """The level to put ``size`` tokens on; 0 is a new window.

        A window that moves from level h to h + size takes 2 N(h) - 1 from the sum and adds
        2 N(h + size) + 1, or nothing where it is full. Of equal sums the fullest level wins.
        """
        room = self.window - size
        leaves = np.where(self.counts[:room + 1] > 0, 1 - 2 * self.counts[:room + 1], 2 * self.window * self.most)
        leaves[0] = 0
        change = leaves + 2 * self.counts[size:] + 1
        change[room] = leaves[room]
        return room - int(np.argmin(change[::-1]))

    def add(self, doc, ids: bytes) -> Iterator[list[tuple]]:
        """Windows that the document fills."""
        total = len(ids) // 4
        for start in range(0, total - self.window + 1, self.window):
            yield [(doc, start, ids[4 * start:4 * (start + self.window)], total)]
        size = total % self.window
        if not size:
            return
        piece = (doc, total - size, ids[4 * (total - size):], total)
        at = self.level(size)
        pieces = self.open[at].pop() if at else []
        self.n_open += not at
        self.counts[at] -= at > 0
        pieces.append(piece)
        if at + size == self.window:
            self.n_open -= 1
            yield pieces
            return
        self.open[at + size].append(pieces)
        self.counts[at + size] += 1
        if self.n_open > self.most:
            yield from self.close()

    def close(self) -> Iterator[list[tuple]]:
        """What is open, refilled into whole windows by cutting; the last one is cut into
        sequences of a power of two, so none of them is padded."""
        pieces = [p for level in reversed(self.open) for window in level for p in window]
        left = sum(len(p[2]) // 4 for p in pieces)
        full, last = divmod(left, self.window)
        sizes = [self.window] * full + [1 << b for b in reversed(range(last.bit_length())) if last >> b & 1]
        pieces.reverse()
        for size in sizes:
            taken = []
            while size:
                doc, start, ids, total = pieces.pop()
                part = ids[:4 * size]
                taken.append((doc, start, part, total))
                size -= len(part) // 4
                if len(part) < len(ids):
                    pieces.append((doc, start + len(part) // 4, ids[len(part):], total))
            yield taken
        self.open = [[] for _ in range(self.window)]
        self.counts[:] = 0
        self.n_open = 0


def pack(tokens: DataFrame, window: int = 2048, open_windows: int = 4096, at_once: int = 512) -> DataFrame:
    """Pack ``doc_id, ids`` (as ``token_ids`` gives them) into sequences of at most ``window``.

    Returns one row per piece: ``doc_id, start, length, ids, doc_tokens, sequence_id,
    offset``. Each identifier lies in one piece; documents are cut only where they exceed a
    window and where windows still open are closed together, at the end of a task or when
    ``open_windows`` are open, which bounds a task's memory. A sequence is full or has a
    power of two tokens, so there is no padding. Documents without tokens (null or empty
    ``ids``) have no piece. Repeated rows are separate documents.

    Tasks are independent and no document moves. A sequence's identifier is its task's
    number and its own in the task, so a repeated task gives the same rows as long as its
    input comes in the same order, which a table's files do.
    """
    tokens = tokens.select("doc_id", "ids")
    return tokens.mapInArrow(pack_batches(window, open_windows, at_once), PACKED.format(kind(tokens, "doc_id")))


def pack_texts(docs: DataFrame, end_id: int = 1, **rule: int) -> DataFrame:
    """``pack`` of the ``token_ids`` of ``docs`` in one pass: a task's tokens stay in the process that
    makes them, and no batch of all of them is held or sent to a second one."""
    docs = texts(docs)
    tokens, packed = token_batches(end_id=end_id), pack_batches(**rule)
    return docs.mapInArrow(lambda parts: packed(tokens(parts)), PACKED.format(kind(docs, "doc_id")))


PACKED = "doc_id {}, start long, length long, ids binary, doc_tokens long, sequence_id long, `offset` long"


def pack_batches(window: int = 2048, open_windows: int = 4096, at_once: int = 512) -> Batches:
    """What ``pack`` does with batches of ``doc_id, ids``; about ``at_once`` pieces are given out together."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40
        packer, done = Packer(window, open_windows), 0
        rows: list[tuple] = []

        def put(sequences) -> None:
            nonlocal done
            for pieces in sequences:
                at = 0
                for doc, start, ids, total in pieces:
                    rows.append((doc, start, len(ids) // 4, ids, total, first + done, at))
                    at += len(ids) // 4
                done += 1

        def out() -> pa.RecordBatch:
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
            rows.clear()
            return pa.RecordBatch.from_arrays(columns, names)

        types = [pa.int64()] * 7
        for part in parts:
            types[0], types[3] = part.schema.field("doc_id").type, pa.binary()
            for doc, ids in zip(part.column(0), part.column(1)):
                put(packer.add(doc.as_py(), ids.as_py() or b""))
                if len(rows) >= at_once:
                    yield out()
        put(packer.close())
        if rows:
            yield out()

    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    return batches


def op7_packing(spark, sf_dir: str) -> DataFrame:
    return pack_texts(table(spark, sf_dir, "documents")).withColumn("ids", F.crc32("ids")).withColumnRenamed(
        "ids", "ids_crc32")
