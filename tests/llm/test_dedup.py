"""Exact dedup, line dedup, SimHash and vectors against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import embeddings, exact_dedup, line_dedup, simhash
from tidemark.llm.common import components, in_units

from .helpers import ODD, by_links, pairs


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def expected_groups(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(lower(t), []).append(i)
    out = []
    for i, t in rows:
        ids = groups[lower(t)]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256(lower(t).encode()).hexdigest()))
    return out


def as_set(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


EXACT = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def test_exact_dedup_odd_rows(odd, none):
    assert as_set(exact_dedup.exact_dedup(odd), *EXACT) == sorted(expected_groups(ODD), key=repr)
    assert exact_dedup.exact_dedup(none).count() == 0


def test_chunks_of_one_hash_are_told_apart(spark):
    """With a hash that nearly all chunks share, identifiers still follow the bytes."""
    rng = random.Random(1)
    rows = [(i, "".join(rng.choice("abT s\n") for _ in range(rng.randint(0, 30)))) for i in range(150)]
    rows += [(1000 + i, t) for i, t in rows[:60]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = exact_dedup.exact_dedup(docs, chunk_hash=lambda c: F.length(c).cast("long") % 2,
                                  pattern=exact_dedup.cut_pattern(3, 8))
    assert as_set(got, *EXACT) == sorted(expected_groups(rows), key=repr)


def test_chunks_resume_after_an_edit(spark):
    rng = random.Random(2)
    text = " ".join("".join(rng.choice("abcdest") for _ in range(6)) for _ in range(2_000))
    docs = spark.createDataFrame([(1, text), (2, "An edit in front. " + text)], "doc_id long, body string")
    a, b = (set(r["recipe"]) for r in exact_dedup.chunk_recipes(docs, "body").orderBy("doc_id").collect())
    assert len(a & b) > 0.8 * len(a)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def expected_lines(rows, k, least):
    first = {}
    for i, t in rows:
        for pos, line in enumerate((t or "").split("\n")):
            if line.strip(" "):
                place = (i if i is not None else (1 << 63) - 1, pos)
                first[line] = min(first.get(line, place), place)
    long = [x for x in first if len(x) >= least]
    gone = {b for a in long for b in long if first[a] < first[b] and abs(len(a) - len(b)) <= k and edits(a, b) <= k}
    stay = {first[x] for x in first if x not in gone}
    return sorted(((i, "\n".join(line for pos, line in enumerate((t or "").split("\n")) if not line.strip(" ") or (
        i if i is not None else (1 << 63) - 1, pos) in stay)) for i, t in rows), key=repr)


@pytest.mark.parametrize("k", [1, 2, 3])
def test_line_dedup_finds_all_near_lines(spark, k):
    rng = random.Random(k)
    base = ["".join(rng.choice("abé😀 ") for _ in range(rng.randint(9, 16))) for _ in range(25)]

    def changed(line):
        line = list(line)
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(len(line))
            line[at:at + rng.randint(0, 1)] = rng.choice(["", "a", "é"])
        return "".join(line)

    rows = [(i, "\n".join(changed(rng.choice(base)) if rng.random() < 0.9 else " " for _ in range(6))) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = line_dedup.line_dedup(docs, k, least=8)
    assert as_set(got, "doc_id", "text") == expected_lines(rows, k, 8)


def test_line_dedup_odd_rows(odd, none):
    got = line_dedup.line_dedup(odd)
    assert got.columns == ["doc_id", "text", "lang", "score", "n_chars", "kept", "n_lines"]
    assert as_set(got, "doc_id", "text") == expected_lines(ODD, 2, 30)
    assert line_dedup.line_dedup(none).count() == 0


def test_keys_are_cut_from_a_form_of_fixed_width(spark):
    """The hashes are those of the characters, and no expression walks over a line for each of them."""
    lines = ["abcé😀f" * 9, "x" * 31, "short", "ä" * 30]
    key = line_dedup.keys(F.col("units"), F.col("size"), 2, 30)
    assert "length(" not in str(key)
    rows = spark.createDataFrame([(x, len(x)) for x in lines], "line string, size int")
    got = rows.withColumn("units", F.encode("line", "UTF-32")).select("line", key.alias("keys"))
    for line, hashes in got.collect():
        if len(line) < 30:
            assert hashes is None
            continue
        want = []
        for n, (less, i, shift) in enumerate([(0, 0, 0), (0, 1, 0), (0, 2, 0), *line_dedup.probes(2)]):
            size = len(line) - less
            small, more = divmod(size, 3)
            start, width = small * i + max(0, i - 3 + more) + shift, small + (i >= 3 - more)
            if size >= 30:
                want.append((n, i, size, line[start:start + width].encode("utf-32-be")))
        known = spark.createDataFrame(want, "n int, i int, size int, part binary")
        found = {r["n"]: r["h"] for r in known.select("n", F.xxhash64("i", "size", "part").alias("h")).collect()}
        assert hashes == [found.get(n) for n in range(15)]


def test_texts_meet_their_kept_lines_by_one_kind_of_join(odd):
    """A small table takes the join of a large one, so that its disk grows with the input."""
    plan = line_dedup.line_dedup(odd)._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_probes_are_those_of_the_scheme():
    assert len(line_dedup.probes(1)) == 4
    assert len(line_dedup.probes(2)) == 12


def fingerprint(text, n=3):
    words = re.findall(r"[^ \t-\r]+", lower(text))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + n]), 42) for i in range(max(1, len(words) - n + 1))]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_fingerprints(odd):
    got = {(r["doc_id"], r["fp"]) for r in simhash.fingerprints(odd).collect()}
    assert got == {(i, (f - (1 << 64)) if f >> 63 else f) for i, t in ODD for f in [fingerprint(t)]}


def test_gray_index_finds_all_pairs():
    rng = np.random.default_rng(3)
    for n in (1, 2, 40, 700):
        codes = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        codes[1::3] = codes[0] ^ (np.uint64(1) << rng.integers(0, 64, len(codes[1::3])).astype(np.uint64))
        codes = np.unique(codes)
        codes = codes[np.argsort(simhash.gray_rank(codes))]
        got = {(i, j) for a, b in simhash.GrayIndex(codes).pairs(3) for i, j in zip(a.tolist(), b.tolist())}
        near = np.bitwise_count(codes[:, None] ^ codes[None, :]) <= 3
        assert got == {(i, j) for i, j in zip(*map(np.ndarray.tolist, np.nonzero(np.triu(near, 1))))}


@pytest.mark.parametrize("rows_per_block", [2, 1024])
def test_near_links_connect_all(spark, rows_per_block):
    """A large group of near fingerprints, cut into many units, is one class still."""
    rng = np.random.default_rng(4)
    codes = [int(x) for x in rng.integers(0, 1 << 63, 30)]
    for _ in range(60):
        codes.append(codes[rng.integers(len(codes))] ^ (1 << int(rng.integers(63))) ^ (1 << int(rng.integers(63))))
    codes = sorted(set(codes))
    found = components(simhash.near_links(spark.createDataFrame([(c,) for c in codes], "fp long"), 3, rows_per_block))
    root = {r["node"]: r["root"] for r in found.collect()}
    want = by_links(len(codes), [(i, j) for i, j in pairs(len(codes)) if (codes[i] ^ codes[j]).bit_count() <= 3])
    assert [root.get(c, c) for c in codes] == [codes[w] for w in want]


def test_near_groups_odd_rows(odd, none):
    got = {(r["doc_id"], r["component_id"]) for r in simhash.near_groups(odd).collect()}
    assert {(1, 1), (2, 1), (3, 1), (4, 4), (9, 4), (None, 4)} <= got
    assert simhash.near_groups(odd).count() == len(ODD)
    assert simhash.near_groups(none).count() == 0


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(100, i) for i in range(101, 160)] + [(500, 500), (200, 150)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(found[i] == 1 for i in range(1, 61)) and all(found[i] == 100 for i in [*range(100, 160), 200])
    assert 500 not in found


def test_units_meet_every_pair_once_or_in_one_block(spark):
    rows = spark.range(57).select(F.lit(1).alias("k"), F.col("id"))
    cut = in_units(rows, ["k"], F.xxhash64("id"), 10).collect()
    units = {}
    for r in cut:
        units.setdefault((r["unit_a"], r["unit_b"]), set()).add(r["id"])
    assert all(any({i, j} <= u for u in units.values()) for i, j in pairs(57))
    assert max(map(len, units.values())) < 40


def vectors(spark, x, labels):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], l)
                                  for i, (v, l) in enumerate(zip(x, labels))], "vec_id long, embedding array<float>, label int")


@pytest.mark.parametrize("rows_per_block", [16, 1024])
def test_vectors_links_and_recall(spark, rows_per_block):
    rng = np.random.default_rng(6)
    centres = rng.standard_normal((60, 64))
    x = np.concatenate([centres, *[centres[:40] + s * rng.standard_normal((40, 64)) for s in (0.1, 0.3, 0.36, 0.4)],
                        centres[:1] + 0.2 * rng.standard_normal((80, 64)), np.repeat(centres[:1], 20, axis=0)])
    x = x.astype(np.float32)
    labels = rng.integers(0, 2, len(x))
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    near = (unit @ unit.T >= 0.93) & (labels[:, None] == labels[None, :]) & ~np.eye(len(x), dtype=bool)
    rule = embeddings.VectorRule(rows_per_block=rows_per_block)
    got = {r["vec_id"]: r for r in embeddings.near_vectors(vectors(spark, x, labels.tolist()), rule).collect()}
    linked = np.array([got[i]["n_links"] for i in range(len(x))])
    assert (linked <= near.sum(axis=1)).all()
    assert linked.sum() >= 0.98 * near.sum()
    want = by_links(len(x), zip(*map(np.ndarray.tolist, np.nonzero(near))))
    assert np.mean([got[i]["component_id"] == w for i, w in enumerate(want)]) > 0.97
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())


def test_vectors_that_link_with_nothing(spark):
    x = [[1, 2], [1, 2], None, None, [0, 0], [0, 0], [None, 1], [float("nan"), 1], [float("inf"), 1], [1, 2], [2, 4], [1, 2, 0],
         [], []]
    labels = [1, 1, 1, 1, 1, 1, 1, 1, 1, None, 1, 1, 1, 1]
    got = {r["vec_id"]: tuple(r)[1:] for r in embeddings.near_vectors(vectors(spark, x, labels)).collect()}
    assert [got[i] for i in (0, 1, 10)] == [(2, 0, True), (2, 0, False), (2, 0, False)]
    assert all(got[i] == (0, i, True) for i in range(len(x)) if i not in (0, 1, 10))
    assert embeddings.near_vectors(vectors(spark, x, labels).limit(0)).count() == 0


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(8)
    rule = embeddings.VectorRule()
    x = embeddings.units(rng.standard_normal((4_000, 64)))
    y = embeddings.units(x + 0.05 * rng.standard_normal(x.shape))
    bits, factor = embeddings.codes_of(x, rule)
    signs = (np.unpackbits(bits, axis=1) * 2.0 - 1) / 8
    estimate = ((y @ embeddings.rotation(64, rule.seed)) * signs).sum(axis=1) / factor
    error = estimate - (x * y).sum(axis=1)
    assert abs(error.mean()) < 0.005
    assert (np.abs(error) < rule.sigmas * np.sqrt((1 - factor ** 2) / (factor ** 2 * 63))).all()
