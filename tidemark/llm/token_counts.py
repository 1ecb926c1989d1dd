"""Token counts with a whole-token shortcut.

No piece of the vocabulary has a word mark behind another character, so merges never cross
the start of a word, and a text's count is the sum over its words. Before any text is read,
each vocabulary string is encoded alone; those that come back as themselves are proven to
be one token, and words equal to one of them count 1 without merging. The rest is merged,
each distinct word once per worker.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, functions as F
from sentencepiece import SentencePieceProcessor

from tidemark.llm.common import kind, table, texts

MARK = "▁"  # a space, as pieces write it
RUNS = re.compile(r" +[^ ]*")


class PieceCounter:
    """Counts for a sentencepiece BPE that puts one space before a text and keeps all others."""

    def __init__(self, path: str, most: int = 300_000, longest: int = 64):
        self.model, self.most, self.longest = SentencePieceProcessor(model_file=path), most, longest
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        plain = [p for i, p in enumerate(pieces) if not (
            self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_byte(i))]
        if any(MARK in p.lstrip(MARK) for p in plain):
            raise ValueError("a piece spans the start of a word, so words can't be counted alone")
        words = [p[1:].replace(MARK, " ") for p in plain if p.startswith(MARK) and len(p) > 1]
        alone = self.model.encode(words, num_threads=1)
        #: What follows the first space of a word, for the words proven to be one token.
        self.whole = {w: 1 for w, ids in zip(words, alone) if len(ids) == 1}
        self.whole[""] = 1  # a space that nothing follows
        self.counts = dict(self.whole)

    def words(self, text: str) -> list[str]:
        """The words without their first space; further spaces before a word belong to it."""
        if MARK in text:
            text = text.replace(MARK, " ")
        words = text.split(" ")
        if "" in words:
            return [w[1:] for w in RUNS.findall(" " + text)] if text else []
        return words

    def count(self, batch: list[str]) -> list[int]:
        split = [self.words(t) for t in batch]
        fresh = list({w for words in split for w in words} - self.counts.keys())
        if len(self.counts) + len(fresh) > self.most:
            self.counts = dict(self.whole)
            fresh = list({w for words in split for w in words} - self.counts.keys())
        self.counts.update(zip(fresh, map(len, self.model.encode(fresh, num_threads=1))))
        totals = [sum(map(self.counts.__getitem__, words)) for words in split]
        for w in fresh:
            if len(w) > self.longest:
                del self.counts[w]
        return totals


@lru_cache(maxsize=2)
def counter(path: str) -> PieceCounter:
    return PieceCounter(path)


def count_tokens(docs: DataFrame, path: str | None = None, id_column: str = "doc_id", text_column: str = "text",
                 at_once: int = 256) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` of each whole text; null and empty texts have 0 of both.

    No begin or end is added, and the strings of special tokens are ordinary text.
    ``at_once`` texts share one call for their unknown words. Rows come back one for one.
    """
    docs = texts(docs, id_column, text_column)
    docs = docs.withColumn("n_bytes", F.octet_length("text").cast("long"))
    path = path or public_tokenizers.path("piece_bpe_32k.model")

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = counter(path)
        for part in parts:
            counts: list[int] = []
            for at in range(0, part.num_rows, at_once):
                counts += pieces.count(part.column(1).slice(at, at_once).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), pa.array(np.array(counts, np.int64))], ["doc_id", "n_bytes", "n_tokens"])

    return docs.mapInArrow(batches, f"doc_id {kind(docs, 'doc_id')}, n_bytes long, n_tokens long")


def op9_token_counts(spark, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents")).withColumn("over_limit", F.col("n_tokens") > 4096)
