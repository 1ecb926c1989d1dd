"""BPE encoding and decoding with forced-boundary splitting.

Merges only ever build vocabulary tokens. Where two neighbouring bytes stand together in no
token, no merge can cross, so the word may be cut there; its fragments are encoded one by
one, each distinct fragment once per worker, and the identifiers are put together again.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import regex
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer, models

from tidemark.llm.common import Memo, kind, table, texts

# Code points whose normal form, case and class the plain path below treats as the library
# does; it leaves texts with others to the library's own normaliser and word splitter.
UNUSUAL = regex.compile(r"[\x1c-\x1f]|[^\x00-ɏ]")


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte: visible Latin-1 bytes stand for
    themselves, the others take the code points from 256 on, in order."""
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordBpe:
    """Encoder and decoder for a lower-casing BPE whose tokens mark word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.library = Tokenizer.from_file(path)
        self.last = self.library.model  # marks word ends
        self.inner = models.BPE(vocab=model["vocab"], merges=merges)
        self.words = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True))) + ")")
        bare = [t.removesuffix(self.end) for t in model["vocab"]]
        self.joined = {a + b for t in bare for a, b in zip(t, t[1:])}
        self.letters = byte_letters()
        size = 1 + max(*model["vocab"].values(), *self.specials.values())
        self.tokens = np.full(size, "", dtype=object)
        for token, i in [*model["vocab"].items(), *self.specials.items()]:
            self.tokens[i] = token
        self.last_pieces, self.inner_pieces = (
            Memo(self._merge(m), most=100_000) for m in (self.last, self.inner))
        self.chunks = Memo(self._chunk, most=200_000)

    def pieces(self, word: str) -> list[str]:
        """Cut where two letters stand together in no token."""
        joined = self.joined
        cuts = [i for i in range(1, len(word)) if word[i - 1:i + 1] not in joined]
        if not cuts:
            return [word]
        return [word[a:b] for a, b in zip([0, *cuts], [*cuts, len(word)])]

    @staticmethod
    def _merge(model: models.BPE):
        return lambda piece: array("i", [t.id for t in model.tokenize(piece)]).tobytes()

    def _word(self, word: str) -> bytes:
        """A word in byte letters."""
        *inner, last = self.pieces(word)
        if not inner:
            return self.last_pieces[last]
        return b"".join([*map(self.inner_pieces.__getitem__, inner), self.last_pieces[last]])

    def _chunk(self, chunk: str) -> bytes:
        """A stretch of lower-case text without white space."""
        # visible ASCII characters are their own letters
        return b"".join([self._word(w if w.isascii() and w.isprintable() else "".join(map(self.letters.__getitem__, w.encode())))
                         for w in self.words.findall(chunk)])

    def encode(self, text: str) -> bytes:
        """The identifiers, as little-endian 32-bit integers."""
        if "<|" in text and self.special.search(text):
            return b"".join(np.array([self.specials[part]], "<i4").tobytes() if part in self.specials
                            else self.encode(part) for part in self.special.split(text) if part)
        if UNUSUAL.search(text):
            normal = self.library.normalizer.normalize_str(text)
            return b"".join(self._word(w) for w, _ in self.library.pre_tokenizer.pre_tokenize_str(normal))
        return b"".join(map(self.chunks.__getitem__, text.lower().split()))


@lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBpe:
    return WordBpe(path)


def default_path() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def id_lists(encoded: list[bytes]) -> pa.ListArray:
    offsets = np.zeros(len(encoded) + 1, np.int32)
    np.cumsum([len(b) // 4 for b in encoded], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(encoded), "<i4")))


def encode(docs: DataFrame, path: str | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id`` and ``ids``, the token identifiers of each whole text.

    Special tokens written in a text become their identifiers; none are added. A null or
    empty text has an empty list. Rows come back one for one, repeated ones too.
    """
    docs = texts(docs, id_column, text_column)
    path = path or default_path()

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(path)
        for part in parts:
            ids = id_lists([bpe.encode(t.as_py()) for t in part.column(1)])
            yield pa.RecordBatch.from_arrays([part.column(0), ids], ["doc_id", "ids"])

    return docs.mapInArrow(batches, f"doc_id {kind(docs, 'doc_id')}, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``encoded`` plus ``decoded``: the tokens of ``ids`` joined by spaces, special ones kept.

    The vocabulary has no decoder of its own, so word ends stay visible. An empty list
    gives the empty text, a null list null; an identifier outside the vocabulary is an error.
    """
    path = path or default_path()

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = pa.array(word_bpe(path).tokens, pa.string())
        for part in parts:
            ids = part.column(part.schema.get_field_index("ids"))
            named = pa.ListArray.from_arrays(ids.offsets, tokens.take(ids.values), mask=ids.is_null())
            yield pa.RecordBatch.from_arrays([*part.columns, pc.binary_join(named, " ")], [*part.schema.names, "decoded"])

    fields = ", ".join(f"`{c}` {kind(encoded, c)}" for c in encoded.columns)
    return encoded.mapInArrow(batches, f"{fields}, decoded string")


def op3_bpe(spark, sf_dir: str) -> DataFrame:
    both = decode(encode(table(spark, sf_dir, "documents")))
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
