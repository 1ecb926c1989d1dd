"""Token files: exact round trips, checkpoints, order, damage."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import packing, token_files
from tidemark.llm.common import table
from tidemark.session import work_dir

SMALL = "/root/testdata/sf0.001"


def coder(ids, scale=20):
    counts = np.bincount(ids) if len(ids) else np.zeros(0, np.int64)
    some = np.flatnonzero(counts)
    return token_files.FrequencyTable(some, token_files.scaled(counts[some], scale), scale)


@pytest.mark.parametrize("n, span, lanes, every", [
    (0, 1, 16, 2), (1, 1, 16, 2), (2, 9, 4096, 128), (63, 5, 16, 1), (5_000, 300, 16, 3), (70_001, 50_000, 256, 7),
    (20_000, 1, 64, 5)])
def test_blocks_round_trip(n, span, lanes, every):
    draw = np.random.default_rng(n)
    ids = (span * draw.random(n) ** 4).astype("<u4")
    t = coder(ids)
    blob = token_files.encode_block(ids, t, lanes, every)
    assert np.array_equal(token_files.decode_block(blob, t), ids)
    for a, b in [(0, 1), (n // 3, n // 3 + 17), (n // 2, None), (n - 1, n + 5), (n, n), (n // 4, 3 * n // 4)]:
        assert np.array_equal(token_files.decode_block(blob, t, max(a, 0), b), ids[max(a, 0):b])


def test_size_is_near_the_entropy():
    ids = (3_000 * np.random.default_rng(1).random(1 << 20) ** 3).astype("<u4")
    p = np.bincount(ids) / len(ids)
    bits = -(p[p > 0] * np.log2(p[p > 0])).sum()
    assert len(token_files.encode_block(ids, coder(ids))) * 8 < 1.12 * bits * len(ids)


def test_damage_is_an_error():
    ids = np.arange(4_000, dtype="<u4") % 77
    t = coder(ids)
    blob = bytearray(token_files.encode_block(ids, t))
    with pytest.raises(ValueError):
        token_files.decode_block(bytes(blob), coder(ids[:100] // 2))
    blob[-5] ^= 1
    with pytest.raises(ValueError):
        token_files.decode_block(bytes(blob), t)
    with pytest.raises(ValueError):
        token_files.encode_block(np.array([78], "<u4"), t)


def test_frequencies_fill_the_table():
    for counts in ([1], [10 ** 12, 1, 1], list(range(1, 3_000))):
        found = token_files.scaled(np.array(counts), 20)
        assert found.sum() == 1 << 20 and found.min() >= 1


def test_query_by_the_library(spark):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    start, expected = 0, []
    for r in sorted(table(spark, SMALL, "documents").collect(), key=lambda r: r["doc_id"]):
        ids = np.array([*library.encode(r["text"] or "", add_special_tokens=False).ids, 2], "<u4")
        expected.append((r["doc_id"], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in token_files.op13_token_files(spark, SMALL).collect()) == expected


def test_order_cuts_and_spans(spark):
    draw = np.random.default_rng(2)
    sizes = [0, 1, 5, 1_000, 64, 65, 128, 3, 0, 40] * 6
    rows = [(int(i), draw.integers(0, 500, n).astype("<u4").tobytes()) for i, n in enumerate(sizes)]
    shuffled = [rows[i] for i in draw.permutation(len(rows))]
    df = spark.createDataFrame(shuffled, "doc_id long, ids binary").repartition(5)
    path = work_dir(spark, "files")
    token_files.write_tokens(df, path, block_ids=64)
    start, expected = 0, []
    for i, ids in rows:
        expected.append((i, start, len(ids) // 4, ids))
        start += len(ids) // 4
    got = token_files.read_tokens(spark, path).collect()
    assert sorted((r["doc_id"], r["start"], r["n_tokens"], bytes(r["ids"])) for r in got) == expected
    assert spark.read.parquet(f"{path}/blocks").where("n_ids > 64").count() == 0
    every = b"".join(ids for _, ids in rows)
    for first, last in ((0, 1), (3, 2_000), (1_111, 1_112), (5_000, 10 ** 9), (0, start)):
        found = sorted(tuple(r) for r in token_files.read_span(spark, path, first, last).collect())
        assert b"".join(bytes(i) for _, i in found) == every[4 * first:4 * last]
        assert not found or found[0][0] == first


def test_counts_are_made_of_many_identifiers(monkeypatch):
    """A count goes over the whole vocabulary: not once for each text."""
    draw = np.random.default_rng(4)
    values = [draw.integers(0, 50_000 if i % 7 else 9, i % 50).astype("<u4") for i in range(2_000)]
    calls, plain = [], np.bincount
    monkeypatch.setattr(np, "bincount", lambda *a, **k: calls.append(1) or plain(*a, **k))
    for at_once in (1, 1_000, 1 << 20):
        calls.clear()
        assert np.array_equal(token_files.counted(iter(values), at_once), plain(np.concatenate(values)))
        assert at_once == 1 or len(calls) <= sum(map(len, values)) // at_once + 1
    assert len(token_files.counted(iter([]))) == 0


def test_blocks_without_cut_documents_are_decoded_once(spark):
    """The pieces of cut documents come from blocks that hold some, not from all of them again."""
    path = work_dir(spark, "files")
    rows = [(i, np.arange(n, dtype="<u4").tobytes()) for i, n in enumerate([10, 10, 300, 10])]
    token_files.write_tokens(spark.createDataFrame(rows, "doc_id long, ids binary").coalesce(1), path, block_ids=64)
    got = token_files.read_tokens(spark, path)
    assert sorted((r["doc_id"], bytes(r["ids"])) for r in got.collect()) == rows
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 2 and plan.count("Filter exists(docs") == 1


def test_odd_rows(spark, odd, none):
    path = work_dir(spark, "files")
    token_files.write_tokens(packing.token_ids(odd, end_id=2).withColumnRenamed("x", "part"), path)
    got = sorted(token_files.read_tokens(spark, path).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted([r["doc_id"] for r in odd.collect()], key=lambda i: (i is not None, i or 0))
    assert [r["start"] for r in got] == np.cumsum([0] + [r["n_tokens"] for r in got[:-1]]).tolist()
    path = work_dir(spark, "files")
    token_files.write_tokens(packing.token_ids(none, end_id=2), path)
    assert token_files.read_tokens(spark, path).count() == 0 and token_files.read_span(spark, path, 0, 9).count() == 0
    path = work_dir(spark, "files")
    some = spark.createDataFrame([("b", None), ("a", b""), (None, None)], "doc_id string, ids binary")
    token_files.write_tokens(some, path)
    assert sorted((tuple(r) for r in token_files.read_tokens(spark, path).collect()), key=str) == [
        ("a", 0, 0, b""), ("b", 0, 0, b""), (None, 0, 0, b"")]


def test_rows_of_one_identifier_are_spread(spark):
    df = spark.range(4_000).selectExpr("CAST(7 AS LONG) doc_id", "X'0100000002000000' ids")
    path = work_dir(spark, "files")
    token_files.write_tokens(df, path)
    parts = [r["n_ids"] for r in spark.read.parquet(f"{path}/parts").collect()]
    assert sum(parts) == 8_000
    assert token_files.read_tokens(spark, path).selectExpr("count(DISTINCT start) n").first()["n"] == 4_000
