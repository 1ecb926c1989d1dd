"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Each coordinate has its own learning rate, and L1 keeps a weight at exactly zero until its
gradients agree, so the model that is sent to the tasks is a short list of weights.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.llm.common import in_slices, kind, table, texts

WORD = re.compile(r"\w+")
FIRST, SECOND, SKIP = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


@dataclass(frozen=True)
class Ftrl:
    """``bits``: log2 of the number of hashed features. ``per_class``: at most so many labelled
    documents of each class are learnt from, those with the smallest hash of their identifier."""
    bits: int = 22
    per_class: int = 6_000
    epochs: int = 10
    alpha: float = 3.0
    beta: float = 1.0
    l1: float = 6.0
    l2: float = 0.1
    seed: int = 7


def features(text: str, bits: int) -> np.ndarray:
    """The distinct hashed features of a whole text: words, neighbouring pairs, and pairs with
    one word between them."""
    words = WORD.findall(text.lower())
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    grams = np.concatenate([h * FIRST, h[:-1] * FIRST + h[1:] * SECOND, h[:-2] * SKIP + h[2:] * SECOND])
    mixed = (grams ^ (grams >> np.uint64(29))) * SECOND
    return np.unique((mixed >> np.uint64(64 - bits)).astype(np.int32))


@dataclass(frozen=True)
class Model:
    """Weights that are not zero, by feature."""
    index: np.ndarray
    weight: np.ndarray
    bias: float
    bits: int

    def dense(self) -> np.ndarray:
        w = np.zeros(1 << self.bits, np.float32)
        w[self.index] = self.weight
        return w


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


def fit(rows: list[np.ndarray], labels: np.ndarray, rule: Ftrl) -> Model:
    """Passes over the rows in a seeded order, one update per row. Without rows every score is 0."""
    z, n = np.zeros(1 << rule.bits, np.float32), np.zeros(1 << rule.bits, np.float32)
    bias_z = bias_n = 0.0
    order = np.random.default_rng(rule.seed)

    def weights(z, n):
        return np.where(np.abs(z) <= rule.l1, 0.0, -(z - np.sign(z) * rule.l1) / (
            (rule.beta + np.sqrt(n)) / rule.alpha + rule.l2))

    def bias():
        return -bias_z / ((rule.beta + np.sqrt(bias_n)) / rule.alpha + rule.l2)

    for _ in range(rule.epochs):
        for i in order.permutation(len(rows)):
            at = rows[i]
            w, squares, b = weights(z[at], n[at]), n[at], bias()
            g = float(sigmoid(w.sum() + b) - labels[i])
            z[at] += g - (np.sqrt(squares + g * g) - np.sqrt(squares)) / rule.alpha * w
            n[at] += g * g
            bias_z += g - (np.sqrt(bias_n + g * g) - np.sqrt(bias_n)) / rule.alpha * b
            bias_n += g * g
    kept = np.flatnonzero(np.abs(z) > rule.l1).astype(np.int32)
    return Model(kept, weights(z[kept], n[kept]).astype(np.float32), float(bias()) if len(rows) else -35.0, rule.bits)


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the identifier as text falls in ``fold``; a null identifier is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def sample(labels: DataFrame, per_class: int) -> DataFrame:
    """At most ``per_class`` rows ``doc_id, label`` of labels 1 and of labels 0, in order of the
    hash of the identifier. Null labels and identifiers are left out, and an identifier with
    several labels counts as 1 if any is. Where the bound cuts one class, scores refer to the
    classes' shares in the sample."""
    one = labels.where("doc_id IS NOT NULL AND label IN (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))
    parts = [one.where(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for c in (0, 1)]
    return parts[0].union(parts[1])


def train(docs: DataFrame, labels: DataFrame, rule: Ftrl = Ftrl()) -> Model:
    """Learn from ``docs`` (``doc_id, text``) and ``labels`` (``doc_id, label``).

    The chosen identifiers are at most twice ``per_class``, so they are broadcast, and only
    the features of their texts come to the driver, where the updates run one after another.
    """
    chosen = sample(labels, rule.per_class)
    picked = texts(docs).join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])
    bits = rule.bits

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_slices(parts, 0):
            found = pa.array([features(t.as_py(), bits).tobytes() for t in part.column(0)], pa.binary())
            yield pa.RecordBatch.from_arrays([*part.columns[1:], found], ["doc_id", "label", "features"])

    rows = picked.select("text", "doc_id", "label").mapInArrow(
        batches, f"doc_id {kind(picked, 'doc_id')}, label int, features binary").toArrow()
    rows = rows.sort_by("doc_id")
    return fit([np.frombuffer(f.as_py(), np.int32) for f in rows["features"]], rows["label"].to_numpy(), rule)


def score(docs: DataFrame, model: Model, name: str = "score", text_column: str = "text") -> DataFrame:
    """``docs`` and the score of each whole text as column ``name``, which ``docs`` lacks; a null
    text is empty and scores as the bias alone."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    names, at = [*docs.columns, name], docs.columns.index(text_column)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        w = m.dense()
        for part in in_slices(parts, at):
            sums = np.array([w[features(t.as_py() or "", m.bits)].sum(dtype=np.float64) for t in part.column(at)])
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(sigmoid(sums + m.bias), pa.float64())], names)

    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    return docs.mapInArrow(batches, schema)


def known_labels(labels: DataFrame, name: str, folds: int, fold: int) -> DataFrame:
    """``doc_id, label`` of the labels that may be learnt from."""
    return labels.where(~held_out(F.col("doc_id"), folds, fold)).select("doc_id", F.col(name).cast("int").alias("label"))


FOLDS, FOLD = 5, 0


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, known_labels(table(spark, sf_dir, "labels"), "toxic", FOLDS, FOLD))
    return score(docs.select("doc_id", "text"), model).select("doc_id", held_out(F.col("doc_id"), FOLDS, FOLD).alias("held_out"), "score",
                                     (F.col("score") >= 0.5).cast("int").alias("predicted"))
