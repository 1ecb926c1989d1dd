"""Spelling variants by a frequency-vector trie.

A word's vector counts its letters group by group. One inserted, deleted or replaced letter
adds at most one to one count and takes at most one from another, so a search through a trie
over successive counts may spend one surplus and one deficit, and the few leaves it reaches
hold the words to verify. The upper levels of the trie are the key by which Spark deals
words, copied to each subtree that their budget reaches; the lower levels are built and
walked inside a task, many words at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import ascii_lower, split_join, table, texts, written
from tidemark.llm.simhash import by_key
from tidemark.session import small_side

RUN = "[A-Za-zÀ-ÿ]"
LEAD = 8  # counts that fit the 64-bit key of the upper levels
WIDE = 48  # longer words are compared one by one


@dataclass(frozen=True)
class SpellingRule:
    """Words of ``least_length`` and ``least_count`` or more take part; a form has ``times`` the
    count of its variant. Letters fall into ``groups`` groups of even weight. The trie's upper
    levels are as many as bring a word's subtree to ``mean_subtree`` words in the mean; what
    still exceeds ``held`` words, or is asked for by more than ``asked``, is cut into units."""
    least_length: int = 7
    least_count: int = 2
    times: int = 10
    groups: int = 16
    mean_subtree: int = 4096
    held: int = 16_384
    asked: int = 65_536


def runs(docs: DataFrame, least_length: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, run``: each maximal run of at least ``least_length`` letters of each whole text,
    A-Z lower-cased. A null text has none."""
    found = F.regexp_extract_all("text", F.lit(f"({RUN}{{{least_length},}}+)"), F.lit(1))
    return texts(docs, id_column, text_column).select("doc_id", F.explode(found).alias("run")).select(
        "doc_id", ascii_lower(F.col("run")).alias("run"))


def misspelt(doc_id: Column, run: Column, every: int = 31) -> Column:
    """``run`` without one letter where ``every`` divides the checksum of identifier and run.
    A null identifier counts as an empty one."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = F.pmod(h, F.length(run).cast("long")).cast("int")
    return F.when(F.pmod(h, F.lit(every)) == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(
        run, at + 2, F.length(run)))).otherwise(run)


def counted(words: DataFrame, rule: SpellingRule) -> DataFrame:
    """``word, n`` of the words long and frequent enough; ``words`` has a row per occurrence."""
    return words.where(F.length("word") >= rule.least_length).groupBy("word").agg(
        F.count(F.lit(1)).alias("n")).where(F.col("n") >= rule.least_count)


def codes_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points of all words in a row, and each word's length."""
    return (np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4"),
            np.array([len(w) for w in words], np.int64))


def letter_groups(words: DataFrame, groups: int) -> dict[int, int]:
    """Each letter's group: from the most frequent letter on, each goes to the lightest group.
    The driver sees one row per letter, which the alphabet bounds."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        for part in parts:
            for letter, count in zip(*(x.tolist() for x in np.unique(codes_of(part.column(0).to_pylist())[0], return_counts=True))):
                seen[letter] = seen.get(letter, 0) + count
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())],
                                         ["letter", "count"])

    totals = words.select("word").mapInArrow(batches, "letter long, count long").groupBy("letter").agg(
        F.sum("count").alias("count")).collect()
    weight, group = [0] * groups, {}
    for r in sorted(totals, key=lambda r: (-r["count"], r["letter"])):
        group[r["letter"]] = lightest = weight.index(min(weight))
        weight[lightest] += r["count"]
    order = {g: place for place, g in enumerate(sorted(range(groups), key=lambda g: -weight[g]))}
    return {letter: order[g] for letter, g in group.items()}


def profiles(words: DataFrame, group: dict[int, int], groups: int) -> DataFrame:
    """``word, n, vector, lead``: the counts of each group, one byte each, and the first eight of
    them as one integer. A count above 255 stays 255, which no edit moves by more than one."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = np.zeros(1 + max(group, default=0), np.int64)
        of[list(group)] = list(group.values())
        for part in parts:
            if not part.num_rows:
                continue
            codes, lengths = codes_of(part.column(0).to_pylist())
            at = np.repeat(np.arange(len(lengths)), lengths) * groups + of[codes]
            counts = np.bincount(at, minlength=len(lengths) * groups).clip(max=255).astype(np.uint8).reshape(-1, groups)
            lead = np.zeros((len(counts), LEAD), np.uint8)
            lead[:, :min(LEAD, groups)] = counts[:, :LEAD]
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array([c.tobytes() for c in counts], pa.binary()),
                 pa.array(lead.view(">i8").ravel().astype(np.int64))], ["word", "n", "vector", "lead"])

    return words.select("word", "n").mapInArrow(batches, "word string, n long, vector binary, lead long")


def key_at(levels: int | Column) -> Column:
    """The first counts of ``lead``, as one integer."""
    shift = (F.lit(LEAD) - levels) * 8
    return F.call_function("shiftrightunsigned", F.col("lead"), shift.cast("int"))


def upper_levels(profiled: DataFrame, rule: SpellingRule) -> int:
    """How many counts make the key: the fewest whose subtrees are small enough in the mean."""
    most = min(LEAD, rule.groups)
    leads = profiled.groupBy("lead").agg(F.count(F.lit(1)).alias("words"))
    at = leads.withColumn("level", F.explode(F.sequence(F.lit(1), F.lit(most))))
    sizes = at.groupBy("level", key_at(F.col("level")).alias("key")).agg(F.sum("words").cast("double").alias("words"))
    means = sizes.groupBy("level").agg((F.sum(F.col("words") * F.col("words")) / F.sum("words")).alias("mean")).collect()
    return min((r["level"] for r in means if r["mean"] <= rule.mean_subtree), default=most)


def probes(rows: DataFrame, levels: int) -> DataFrame:
    """``rows`` copied to each subtree ``key`` that a budget of one surplus and one deficit
    reaches, with ``surplus`` and ``deficit``, what is left of it. A pair of subtrees is asked
    from the larger key only, and each asks itself."""
    places = range(levels)
    steps = [(None, None)] + [(None, i) for i in places] + [(j, i) for i in places for j in places if i < j]

    def one(place: int | None) -> int:
        return 0 if place is None else 1 << 8 * (levels - 1 - place)

    reach = F.array(*[F.struct(F.lit(one(up) - one(down)).cast("long").alias("add"), *[
        F.lit(8 * (levels - 1 - p) if p is not None else -1).alias(name) for name, p in (("up", up), ("down", down))])
        for up, down in steps])

    def count(place: Column) -> Column:
        return F.call_function("shiftrightunsigned", F.col("own"), place).bitwiseAND(F.lit(255))

    found = rows.withColumn("own", key_at(levels)).withColumn("step", F.explode(reach)).where(
        ((F.col("step.up") < 0) | (count(F.col("step.up")) < 255)) & (
            (F.col("step.down") < 0) | (count(F.col("step.down")) > 0)))
    return found.withColumn("key", F.col("own") + F.col("step.add")).withColumn(
        "surplus", (F.col("step.up") < 0).cast("int")).withColumn(
            "deficit", (F.col("step.down") < 0).cast("int")).drop("own", "step")


def dealt(profiled: DataFrame, levels: int, rule: SpellingRule) -> DataFrame:
    """Units ``key, unit_a, unit_b`` of words held (``role`` 0) and words that ask (1)."""
    leads = profiled.groupBy("lead").agg(F.count(F.lit(1)).alias("words"))
    holds = leads.groupBy(key_at(levels).alias("key")).agg(F.sum("words").alias("held"))
    asks = probes(leads, levels).groupBy("key").agg(F.sum("words").alias("asking"))
    keys = small_side(holds.join(asks, "key").select(
        "key", F.ceil(F.col("held") / rule.held).cast("int").alias("held_blocks"),
        F.ceil(F.col("asking") / rule.asked).cast("int").alias("asking_blocks")), 200_000)

    def block(count: str) -> Column:
        return F.pmod(F.xxhash64("word"), F.col(count).cast("long")).cast("int")

    def every(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    columns = ["key", "unit_a", "unit_b", "role", "word", "n", "vector", "surplus", "deficit"]
    held = profiled.withColumn("key", key_at(levels)).withColumn("surplus", F.lit(0)).withColumn("deficit", F.lit(0))
    held = split_join(held, keys, ["key"]).withColumn("unit_a", block("held_blocks")).withColumn(
        "unit_b", every("asking_blocks")).withColumn("role", F.lit(0))
    asked = split_join(probes(profiled, levels), keys, ["key"]).withColumn("unit_b", block("asking_blocks")).withColumn(
        "unit_a", every("held_blocks")).withColumn("role", F.lit(1))
    return held.select(*columns).union(asked.select(*columns))


def spans(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which span each place comes from, and the places ``first, first + 1, ...`` of all spans."""
    which = np.repeat(np.arange(len(first)), count)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + first[which]


class CountTrie:
    """A trie over rows of counts, the first column matched exactly. Rows are in sorted order."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts
        fresh = np.ones(len(counts), bool)
        fresh[1:] = False
        self.starts = []
        for level in range(counts.shape[1]):
            fresh[1:] |= counts[1:, level] != counts[:-1, level]
            self.starts.append(np.flatnonzero(fresh))
        self.ends = [np.append(s[1:], len(counts)) for s in self.starts]

    def walk(self, asked: np.ndarray, surplus: np.ndarray, deficit: np.ndarray,
             at_once: int = 1 << 17) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of an asking row and a held row whose counts lie within the budget, in blocks."""
        tops = self.counts[self.starts[0], 0]
        node = np.searchsorted(tops, asked[:, 0])
        q = np.flatnonzero((node < len(tops)) & (tops[np.minimum(node, len(tops) - 1)] == asked[:, 0]))
        stack = [(0, q, node[q], surplus[q], deficit[q])]
        while stack:
            level, q, node, up, down = stack.pop()
            if len(q) > at_once // 8:  # a part at a time bounds memory
                half = len(q) // 2
                stack += [(level, *(x[half:] for x in (q, node, up, down))), (level, *(x[:half] for x in (q, node, up, down)))]
                continue
            begin, end = self.starts[level][node], self.ends[level][node]
            if level + 1 == self.counts.shape[1]:
                which, row = spans(begin, end - begin)
                for at in range(0, len(row), at_once):
                    yield q[which[at:at + at_once]], row[at:at + at_once]
                continue
            below = self.starts[level + 1]
            first = np.searchsorted(below, begin)
            which, child = spans(first, np.searchsorted(below, end) - first)
            change = self.counts[below[child], level + 1].astype(np.int64) - asked[q[which], level + 1]
            up, down = up[which] - (change > 0), down[which] - (change < 0)
            ok = (np.abs(change) <= 1) & (up >= 0) & (down >= 0)
            if ok.any():
                stack.append((level + 1, q[which[ok]], child[ok], up[ok], down[ok]))


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one inserted, deleted or replaced code point tells ``a`` from ``b``."""
    if len(a) < len(b):
        a, b = b, a
    if a == b or len(a) - len(b) > 1:
        return False
    low, high = 0, len(b)  # length of the common start
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[:middle] == b[:middle] else (low, middle - 1)
    return a[low + 1:] == (b[low + 1:] if len(a) == len(b) else b[low:])


class Letters:
    """Words as rows of code points, to verify many pairs at once."""

    def __init__(self, words: np.ndarray):
        self.words, self.lengths = words, np.array([len(w) for w in words], np.int64)
        width = min(WIDE, int(self.lengths.max())) + 1
        self.rows = np.array(words, dtype=f"U{width}").view(np.uint32).reshape(len(words), width)
        self.rows = self.rows.astype(np.min_scalar_type(int(self.rows.max())))

    def near(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Whether words ``p`` and ``q`` are one edit apart."""
        longer = self.lengths[p] >= self.lengths[q]
        p, q = np.where(longer, p, q), np.where(longer, q, p)
        a, b = self.rows[p], self.rows[q]
        same, size = a == b, a.shape[1]
        start = np.where(same.all(axis=1), size, same.argmin(axis=1))
        replaced = (self.lengths[p] == self.lengths[q]) & ((~same).sum(axis=1) == 1)
        moved = a[:, 1:] != b[:, :-1]
        last = np.where(moved.any(axis=1), size - 2 - moved[:, ::-1].argmax(axis=1), -1)
        found = replaced | ((self.lengths[p] == self.lengths[q] + 1) & (last < start))
        for i in np.flatnonzero(self.lengths[p] > WIDE):
            found[i] = one_edit(self.words[p[i]], self.words[q[i]])
        return found


def unit_matches(unit: np.ndarray, role: np.ndarray, words: np.ndarray, n: np.ndarray, counts: np.ndarray,
                 surplus: np.ndarray, deficit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Over rows of some units: for each row how many words near it they hold, and the row of
    the most frequent of these, the first in code-point order of equal ones (-1: none)."""
    full = np.column_stack([unit, counts])
    held = np.flatnonzero(role == 0)
    held = held[np.lexsort(full[held].T[::-1])]
    asked = np.flatnonzero(role == 1)
    near, best = np.zeros(len(words), np.int64), np.full(len(words), -1, np.int64)
    if not len(held) or not len(asked):
        return near, best, asked
    letters, trie = Letters(words), CountTrie(full[held])
    rank = np.empty(len(words), np.int64)  # by falling n, then by word
    rank[np.lexsort((np.unique(words, return_inverse=True)[1], -n))] = np.arange(len(words))
    at_rank = np.argsort(rank)
    top = np.full(len(words), len(words), np.int64)
    for p, q in trie.walk(full[asked], surplus[asked], deficit[asked]):
        p, q = asked[p], held[q]
        # inside a subtree that asks itself each pair is met twice
        once = ~((surplus[p] == 1) & (deficit[p] == 1)) | (rank[p] < rank[q])
        p, q = p[once], q[once]
        for at in range(0, len(p), 1 << 15):
            a, b = p[at:at + (1 << 15)], q[at:at + (1 << 15)]
            ok = letters.near(a, b)
            for x, y in ((a[ok], b[ok]), (b[ok], a[ok])):
                near += np.bincount(x, minlength=len(words))
                np.minimum.at(top, x, rank[y])
    some = top < len(words)
    best[some] = at_rank[top[some]]
    return near, best, asked


def near_words(units: DataFrame, groups: int, levels: int, at_once: int = 50_000) -> DataFrame:
    """``word, near, best_n, best``: for a word in one unit the number of words near it there and
    the most frequent one. A unit gives one row per word, not its pairs."""
    keys = ["key", "unit_a", "unit_b"]
    units = units.repartition(*keys).sortWithinPartitions(*keys)

    def batches(arrived: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []

        def done() -> pa.RecordBatch:
            role, words, n, vector, surplus, deficit = (np.concatenate(c) for c in zip(*held))
            unit = np.repeat(np.arange(len(held)), [len(c[0]) for c in held])
            counts = np.frombuffer(b"".join(vector), np.uint8).reshape(-1, groups)[:, levels:]
            near, best, _ = unit_matches(unit, role, words, n, counts, surplus, deficit)
            some = np.flatnonzero(near)
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(words[some], pa.string()), pa.array(near[some]), pa.array(n[best[some]]),
                 pa.array(words[best[some]], pa.string())], ["word", "near", "best_n", "best"])

        for _, columns in by_key(arrived, len(keys)):
            held.append(columns)
            if sum(len(c[0]) for c in held) >= at_once:
                yield done()
        if held:
            yield done()

    return units.mapInArrow(batches, "word string, near long, best_n long, best string")


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for links ``word, form``: the last form that can be reached. Every round
    doubles the reach, so rounds grow with the logarithm of the longest chain. A form has a
    larger count than its word, so there are no circles."""
    reach = written(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        ahead = reach.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = written(split_join(reach, ahead, ["root"], "left"), "roots")
        reach = further.select("word", F.coalesce("next", "root").alias("root"))
        if not further.where("next is not null").count():
            return reach


def variants(words: DataFrame, rule: SpellingRule = SpellingRule()) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for distinct words ``word`` with counts ``n``.

    Two words are near if one inserted, deleted or replaced code point tells them apart. A
    word's form is its near word of largest count, the smallest in code-point order of equal
    ones, if that count is at least ``rule.times`` its own, else null; its root is the end of
    the chain of forms. A word without near words has ``n_near`` 0. Words may have any length
    and any letters; an empty table has no rows.
    """
    words = written(words.select("word", F.col("n").cast("long").alias("n")), "words")
    profiled = written(profiles(words, letter_groups(words, rule.groups), rule.groups), "profiles")
    levels = upper_levels(profiled, rule)
    found = near_words(dealt(profiled, levels, rule), rule.groups, levels)
    best = found.groupBy("word").agg(F.sum("near").alias("n_near"), F.min(F.struct(
        (-F.col("best_n")).alias("less"), F.col("best"))).alias("top"))
    is_form = -F.col("top.less") >= F.col("n") * rule.times
    every = written(words.join(best, "word", "left").select(
        "word", F.when(is_form, F.col("top.best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(is_form, -F.col("top.less")).alias("form_n")), "variants")
    ends = roots(every.where("form is not null"))
    return every.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, rule: SpellingRule = SpellingRule(), misspell_every: int | None = None,
                      id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``variants`` of the words of whole texts: runs of Latin letters, A-Z lower-cased. With
    ``misspell_every`` some occurrences lose a letter first, as ``misspelt`` says."""
    found = runs(docs, rule.least_length, id_column, text_column)
    word = misspelt(F.col("doc_id"), F.col("run"), misspell_every) if misspell_every else F.col("run")
    return variants(counted(found.select(word.alias("word")), rule), rule)


def op11_spelling(spark, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"), misspell_every=31)
