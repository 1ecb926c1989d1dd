"""Spelling variants against plain search."""

import random
import re
import zlib

import pytest

from tidemark.llm import spelling
from tidemark.llm.common import table

SMALL = "/root/testdata/sf0.001"


def edits(word):
    """All strings that one deletion gives, with its place."""
    return {(i, word[:i] + word[i + 1:]) for i in range(len(word))}


def expected(counts, times=10):
    """The definition, by shared deletions: near words share a shorter string, or one is it."""
    shorter, near = {}, {w: set() for w in counts}
    for w in counts:
        for i, s in edits(w):
            shorter.setdefault((i, s), set()).add(w)
            if s in counts:
                near[w].add(s)
                near[s].add(w)
    for same in shorter.values():
        for w in same:
            near[w] |= same - {w}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= times * counts[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n, len(near[w]), counts[form[w]] if form[w] else None) for w, n in counts.items())


def got(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def texts_to_counts(rows, every=31):
    counts = {}
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] = counts.get(run, 0) + 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def test_query_by_search(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, SMALL, "documents").collect()]
    assert got(spelling.op11_spelling(spark, SMALL)) == expected(texts_to_counts(rows))


@pytest.mark.parametrize("rule", [
    spelling.SpellingRule(mean_subtree=3, held=4, asked=6), spelling.SpellingRule(groups=3, mean_subtree=10),
    spelling.SpellingRule(times=2, held=40, mean_subtree=10 ** 9)])
def test_units_and_levels_lose_no_pair(spark, rule):
    draw = random.Random(3)
    base = ["".join(draw.choice("abéd") for _ in range(draw.randint(1, 9))) for _ in range(250)]
    base += ["x" * 300, "x" * 299, "x" * 301, "x" * 150 + "y" + "x" * 149, "abcabc" * 12, "abcabc" * 11 + "abcab", "中文字", "中文"]
    counts = {w: draw.choice([1, 2, 5, 10, 30, 100, 1000]) for w in sorted(set(base))}
    words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    assert got(spelling.variants(words, rule)) == expected(counts, rule.times)


def test_chains_ties_and_self(spark):
    counts = {"aaaaaaa": 1, "aaaaaab": 10, "aaaaabb": 100, "aaaabbb": 1000, "zzzzzzz": 10, "zzzzzzy": 1, "zzzzzzx": 10}
    rows = {r[0]: r for r in got(spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long")))}
    assert rows["aaaaaaa"][1:3] == ("aaaaaab", "aaaabbb")
    assert rows["zzzzzzy"][1:] == ("zzzzzzx", "zzzzzzx", 1, 2, 10)


def test_odd_rows(spark, odd, none):
    assert spelling.spelling_variants(none).count() == 0
    rule = spelling.SpellingRule(least_length=1, least_count=1)
    rows = odd.collect()
    counts = {}
    for r in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", r["text"] or ""):
            counts[run.lower()] = counts.get(run.lower(), 0) + 1
    assert got(spelling.spelling_variants(odd, rule)) == expected(counts)
    again = odd.withColumnRenamed("lang", "word").withColumnRenamed("score", "n")
    assert spelling.spelling_variants(again, misspell_every=31).columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_one_edit():
    assert spelling.one_edit("abc", "abd") and spelling.one_edit("abc", "abcd") and spelling.one_edit("bc", "abc")
    assert not spelling.one_edit("abc", "abc") and not spelling.one_edit("abc", "acb") and not spelling.one_edit("a", "abc")
