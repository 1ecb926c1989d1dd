"""Quality by positive-unlabelled learning.

Trusted positives and unlabelled text are enough: the share of positives among the
unlabelled is estimated, and the classifier minimises the unbiased risk that follows from
it, with the part that stands for the negatives kept from falling below zero.

Cut points, prior and risk are sums over all positives and all unlabelled documents: measures
are written once, and each step of Newton's method is one pass over them.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.common import kind, split_join, table, texts, written
from tidemark.llm.toxicity import held_out, known_labels, sigmoid

UPPER, DIGIT, SPACE, LETTER, END, SIGN = range(6)


def byte_classes() -> np.ndarray:
    """The class of each byte; bytes of other scripts count as letters."""
    kinds = np.full(256, LETTER)
    for b in range(128):
        c = chr(b)
        kinds[b] = (UPPER if c.isupper() else DIGIT if c.isdigit() else SPACE if c.isspace() else LETTER if c.isalpha()
                    else END if c in ".,;:?'\"()-" else SIGN)
    return kinds


CLASSES = byte_classes()
NAMES = ("length", "upper", "digit", "space", "end", "sign", "exclaim", "bar", "word_length", "short_words",
         "repeated_words", "distinct_words", "top_word", "marked_words", "line_length", "repeated_lines")


def measures(text: str) -> list[float]:
    """Shape measures of a whole text, in the order of ``NAMES``; all 0 for an empty one."""
    if not text:
        return [0.0] * len(NAMES)
    raw = text.encode("utf-8", "replace")
    bytes_ = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    shares = np.bincount(CLASSES, bytes_, minlength=6) / len(raw)
    words, lines = text.split(), [x for x in text.split("\n") if x]
    n = max(len(words), 1)
    top = max(Counter(words).values(), default=0)
    return [float(np.log1p(len(text))), shares[UPPER], shares[DIGIT], shares[SPACE], shares[END], shares[SIGN],
            bytes_[33] / len(raw), bytes_[124] / len(raw), sum(map(len, words)) / n,
            sum(len(w) <= 3 for w in words) / n, sum(a == b for a, b in zip(words, words[1:])) / n,
            len(set(words)) / n, top / n, sum(not w[-1].isalnum() and w[-1] not in ".,;:?'\"()-" for w in words) / n,
            float(np.log1p(len(text) / max(len(lines), 1))), 1 - len(set(lines)) / max(len(lines), 1)]


@dataclass(frozen=True)
class PuRule:
    """``passes`` bounds the steps of one fit; it ends before when a step would gain less than ``gain``."""
    bins: int = 12
    passes: int = 30
    gain: float = 1e-4
    l2: float = 1e-4


@dataclass(frozen=True)
class PuModel:
    """Cut points of each measure, a weight for each bin, and the estimated share of positives."""
    cuts: list[np.ndarray]
    weight: np.ndarray
    bias: float
    prior: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        return self.weight[one_hot(x, self.cuts)].sum(axis=1) + self.bias


def one_hot(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """For each row the numbers of its bins, one per measure."""
    starts = np.cumsum([0] + [len(c) + 1 for c in cuts[:-1]])
    return np.stack([np.searchsorted(c, x[:, j], side="left") + starts[j] for j, c in enumerate(cuts)], axis=1)


def class_prior(p: np.ndarray, u: np.ndarray, p_rows: np.ndarray | None = None, u_rows: np.ndarray | None = None) -> float:
    """The share of positives among the unlabelled, from scores of rows not learnt from.

    Above a score that only positives reach, unlabelled rows are as frequent as their share
    of positives allows; the cut whose ratio has the smallest upper bound is taken. Equal
    scores may be given once with their number of rows.
    """
    p_rows, u_rows = (np.ones(len(x)) if n is None else n for x, n in ((p, p_rows), (u, u_rows)))
    if not p_rows.sum() or not u_rows.sum():
        return 0.5
    (p, p_sum), (u, u_sum) = ((x[o], np.cumsum(n[o])) for x, n, o in ((p, p_rows, np.argsort(p)), (u, u_rows, np.argsort(u))))
    cuts = np.unique(p[np.searchsorted(p_sum, np.linspace(0, 0.8, 81) * p_sum[-1])])
    above_p, above_u = (1 - np.concatenate([[0.0], n])[np.searchsorted(x, cuts, side="left")] / n[-1]
                        for x, n in ((p, p_sum), (u, u_sum)))
    bound = (above_u + 1.5 / np.sqrt(u_sum[-1]) + 1.5 / np.sqrt(p_sum[-1])) / above_p
    best = int(np.argmin(bound))
    return float(np.clip(above_u[best] / above_p[best], 1e-3, 1 - 1e-3))


GRID = 16_384


def cut_points(rows: DataFrame, bins: int) -> list[np.ndarray]:
    """Quantiles of each measure over all rows, on a fine grid of its logarithm, and zero on its own."""
    counts = rows.select(F.posexplode("measures").alias("j", "v")).groupBy(
        "j", F.floor(F.log1p("v") * GRID).alias("place")).agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("j").orderBy("place")
    whole = Window.partitionBy("j")
    below = counts.withColumn("upto", F.sum("n").over(upto)).withColumn("all", F.sum("n").over(whole))
    # A place is a cut if a quantile lies in it.
    at = below.where(F.floor(F.col("upto") * bins / F.col("all")) > F.floor((F.col("upto") - F.col("n")) * bins / F.col("all")))
    found = [{0.0} for _ in NAMES]
    for r in at.where(F.col("upto") < F.col("all")).select("j", "place").collect():
        if r["place"]:
            found[r["j"]].add(float(np.expm1((r["place"] + 1) / GRID)))
    return [np.array(sorted(c)) for c in found]


def binned(rows: DataFrame, cuts: list[np.ndarray]) -> DataFrame:
    """``bins`` in place of ``measures``: the number of each measure's bin among all bins, two bytes each."""
    sent = rows.sparkSession.sparkContext.broadcast(cuts)
    kept = [c for c in rows.columns if c != "measures"]

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            x = np.array(part.column("measures").to_pylist(), dtype=float).reshape(-1, len(NAMES))
            bins = one_hot(x, sent.value).astype("<u2")
            yield pa.RecordBatch.from_arrays([pa.array([b.tobytes() for b in bins], pa.binary()), *[part.column(c) for c in kept]],
                                             ["bins", *kept])

    return rows.mapInArrow(batches, ", ".join(["bins binary", *[f"{c} {kind(rows, c)}" for c in kept]]))


def bins_of(part: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(part.column("bins").to_pylist()), "<u2").reshape(-1, len(NAMES)).astype(np.int64)


def moments(bins: np.ndarray, s: np.ndarray, d: int) -> list[np.ndarray]:
    """Sums of x, of s x and of s (1 - s) x x', where x is 1 at the row's ``bins`` (ascending) and at the last place.

    Only the places of ones are added up, so a row costs the pairs of its bins, not ``d`` squared.
    """
    at = np.column_stack([bins, np.full(len(bins), d - 1)])
    m, curve = at.shape[1], np.zeros(d * d)
    for i in range(m):
        pairs = at[:, i:i + 1] * d + at[:, i:]
        curve += np.bincount(pairs.ravel(), np.repeat(s * (1 - s), m - i), d * d)
    upper = curve.reshape(d, d)
    return [np.bincount(at.ravel(), minlength=d), np.bincount(at.ravel(), np.repeat(s, m), d),
            (upper + np.triu(upper, 1).T).ravel()]


def sums(rows: DataFrame, weights: list[tuple[int | None, np.ndarray]]) -> list[dict[str, tuple]]:
    """For each weights, of the rows of its half (all with none), and for ``pos`` and ``unl`` rows:
    count, sum of log(1 + e^f), of x, of s x and of s (1 - s) x x', where s is the sigmoid of f.

    A task gives one sum, 16 tasks unite them, and the driver gets 16 rows of a fixed size.
    """
    d = len(weights[0][1])
    width = 2 + 2 * d + d * d
    sent = rows.sparkSession.sparkContext.broadcast(weights)

    def passed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = sent.value
        total = np.zeros((len(weights), 2, width))
        for part in parts:
            bins = bins_of(part)
            half = part.column("half").to_numpy()
            kinds = [part.column(c).to_numpy(zero_copy_only=False) for c in ("pos", "unl")]
            for k, (own, w) in enumerate(weights):
                f = w[bins].sum(axis=1) + w[-1]
                s, loss = sigmoid(f), np.logaddexp(0, f)
                for c, of in enumerate(kinds):
                    pick = of if own is None else of & (half == own)
                    total[k, c] += np.concatenate([[pick.sum(), loss[pick].sum()], *moments(bins[pick], s[pick], d)])
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    def united(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(sent.value) * 2 * width)
        for part in parts:
            for each in part.column(0):
                total += np.frombuffer(each.as_buffer())
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    few = rows.mapInArrow(passed, "sums binary").repartition(16).mapInArrow(united, "sums binary").collect()
    total = sum(np.frombuffer(r["sums"]) for r in few).reshape(len(weights), 2, width)
    return [{c: (t[0], t[1], t[2:2 + d], t[2 + d:2 + 2 * d], t[2 + 2 * d:].reshape(d, d)) for c, t in zip(("pos", "unl"), two)}
            for two in total]


def risks(total: dict[str, tuple], w: np.ndarray, prior: float | None, l2: float) -> list[tuple]:
    """Value, gradient and curvature of the functions whose larger one is the risk.

    With a ``prior`` the risk is prior E_p[l(f)] + max(0, E_u[l(-f)] - prior E_p[l(-f)]) with the
    logistic loss l. It is the larger of its first term and the plain sum, whose terms in p join
    to -prior E_p[f]; both are convex. Without one, positives are told from unlabelled rows.
    """
    (n, lp, xp, sp, hp), (m, lu, _, su, hu) = total["pos"], total["unl"]
    size, ridge = 0.5 * l2 * (w @ w), l2 * np.eye(len(w))
    first = (lp - xp @ w) / n, (sp - xp) / n, hp / n
    if prior is None:
        each = [(first[0] + lu / m, first[1] + su / m, first[2] + hu / m)]
    else:
        each = [tuple(prior * t for t in first), (lu / m - prior * (xp @ w) / n, su / m - prior * xp / n, hu / m)]
    return [(value + size, slope + l2 * w, curve + ridge) for value, slope, curve in each]


def best_step(parts: list[tuple]) -> tuple[np.ndarray, float]:
    """The step that makes the larger of the quadratic models least, and what it should gain.

    It is the least point of the mixture of both whose least value is largest; that value is
    concave in the share, which is narrowed from both sides.
    """
    def mixed(share: float) -> tuple[float, np.ndarray]:
        value, slope, curve = (share * a + (1 - share) * b for a, b in zip(parts[0], parts[-1]))
        step = -np.linalg.solve(curve, slope)
        return value + slope @ step / 2, step

    low, high = (0.0, 1.0) if len(parts) > 1 else (1.0, 1.0)
    while high - low > 1e-9:
        third = (high - low) / 3
        if mixed(low + third)[0] < mixed(high - third)[0]:
            low += third
        else:
            high -= third
    bound, step = mixed((low + high) / 2)
    return step, float(max(value for value, _, _ in parts) - bound)


def descend(rows: DataFrame, d: int, halves: list[int | None], prior: float | None, rule: PuRule) -> list[np.ndarray]:
    """``d`` weights by Newton's method over ``binned`` rows, for each of ``halves``, all from the same passes.

    A step is halved where the risk would grow.
    """
    n = len(halves)
    base, trial, step, best, done = [np.zeros(d)] * n, [np.zeros(d)] * n, [np.zeros(d)] * n, [np.inf] * n, [False] * n
    for _ in range(rule.passes):
        for k, total in enumerate(sums(rows, list(zip(halves, trial)))):
            if done[k]:
                continue
            if not total["pos"][0] or not total["unl"][0]:
                done[k] = True
                continue
            parts = risks(total, trial[k], prior, rule.l2)
            value = max(part[0] for part in parts)
            if value <= best[k]:
                base[k], best[k] = trial[k], value
                step[k], gain = best_step(parts)
                done[k] = gain < rule.gain
            else:
                step[k] = step[k] / 2
            trial[k] = base[k] + step[k]
        if all(done):
            break
    return base


def out_of_half(rows: DataFrame, weights: list[np.ndarray]) -> float:
    """The class prior from scores of each half by the weights of the other, counted on a grid."""
    sent = rows.sparkSession.sparkContext.broadcast(weights)

    def scored(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = sent.value
        for part in parts:
            bins = bins_of(part)
            half = part.column("half").to_numpy()
            f = np.where(half == 0, *[w[bins].sum(1) + w[-1] for w in (weights[1], weights[0])])
            place = np.floor(np.clip(f, -30, 30) * 32).astype("int32")
            yield pa.RecordBatch.from_arrays(
                [pa.array(place), part.column("half"), part.column("pos"), part.column("unl")], ["place", "half", "pos", "unl"])

    found = rows.mapInArrow(scored, "place int, half int, pos boolean, unl boolean").groupBy("half", "place").agg(
        F.count_if("pos").alias("pos"), F.count_if("unl").alias("unl")).toPandas()
    priors = []
    for _, g in found.groupby("half"):
        place = g["place"].to_numpy("float64")
        priors.append(class_prior(place, place, g["pos"].to_numpy("float64"), g["unl"].to_numpy("float64")))
    return float(np.mean(priors)) if priors else 0.5


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the ``measures`` of each whole text; null texts are empty."""
    docs = texts(docs)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = pa.array([measures(t.as_py()) for t in part.column(1)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([part.column(0), found], ["doc_id", "measures"])

    return docs.mapInArrow(batches, f"doc_id {kind(docs, 'doc_id')}, measures array<double>")


def train(rows: DataFrame, positives: DataFrame, unlabelled: DataFrame, rule: PuRule = PuRule()) -> PuModel:
    """Learn from all ``measured`` rows whose ``doc_id`` is in ``positives`` or in ``unlabelled``.

    A document may be in both; null identifiers are in neither. Without rows of either kind,
    scores are a half. ``rows`` is best a written table, as each pass reads it.
    """
    marks = [ids.select("doc_id", F.lit(k == 0).alias("pos"), F.lit(k == 1).alias("unl"))
             for k, ids in enumerate((positives, unlabelled))]
    marks = marks[0].unionByName(marks[1]).where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max("pos").alias("pos"), F.max("unl").alias("unl"))
    used = written(split_join(rows, marks, ["doc_id"]).select(
        "measures", "pos", "unl", F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int").alias("half")), "quality")
    has = used.agg(F.count_if("pos").alias("pos"), F.count_if("unl").alias("unl")).first()
    if not has["pos"] or not has["unl"]:
        return PuModel([np.zeros(0)] * len(NAMES), np.zeros(len(NAMES)), 0.0, 0.5)
    cuts = cut_points(used, rule.bins)
    rows, d = written(binned(used, cuts), "quality-bins"), sum(len(c) + 1 for c in cuts) + 1
    prior = out_of_half(rows, descend(rows, d, [0, 1], None, rule))
    w = descend(rows, d, [None], prior, rule)[0]
    return PuModel(cuts, w[:-1], float(w[-1]), prior)


def score(rows: DataFrame, model: PuModel) -> DataFrame:
    """``doc_id, score``: the probability of being positive, for each of the ``measured`` rows."""
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            x = np.array(part.column(1).to_pylist(), dtype=float).reshape(-1, len(NAMES))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(sigmoid(sent.value.logits(x)))], ["doc_id", "score"])

    return rows.select("doc_id", "measures").mapInArrow(batches, f"doc_id {kind(rows, 'doc_id')}, score double")


FOLDS, FOLD = 4, 2


def op4_quality(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    known = known_labels(table(spark, sf_dir, "labels"), "quality", FOLDS, FOLD)
    web = docs.select("doc_id").where(~held_out(F.col("doc_id"), FOLDS, FOLD))
    rows = written(measured(docs), "measures")
    model = train(rows, known.where("label = 1"), web)
    return score(rows, model).select("doc_id", held_out(F.col("doc_id"), FOLDS, FOLD).alias("held_out"), "score",
                                     (F.col("score") >= 0.7).cast("int").alias("predicted"))
