"""The stages, each on its own input, against brute force; every query's columns."""

import os
import re

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tidemark.llm import queries
from tidemark.llm.common import table
from tidemark.session import work_dir

from .helpers import ODD, by_links, pairs
from .test_dedup import expected_lines, fingerprint
from .test_text import SMALL, by_search

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def stored(spark, df, name):
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def test_stages_by_brute_force(spark):
    docs = table(spark, SMALL, "documents")
    columns = docs.columns
    for (name, stage), number in zip(corpus_pipeline.STAGES, (10, 2, 6, 5, 7)):
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = stored(spark, stage(spark, docs, SMALL), "stage")
        rows = docs.collect()
        if number != 7:
            assert docs.columns == columns, name
            after = {r["doc_id"]: r["text"] for r in rows}
            assert all(r["n_chars"] == len(r["text"]) for r in rows)
        if number == 10:
            clean = {r["doc_id"] for r in table(spark, SMALL, "labels").where("toxic = 0").collect()}
            assert before.keys() > after.keys() and clean <= after.keys()
            assert all(after[i] == before[i] for i in after)
        elif number == 2:
            assert sorted(after.items(), key=repr) == expected_lines(list(before.items()), 2, 30)
        elif number == 6:
            ids = sorted(before)
            codes = [fingerprint(before[i]) for i in ids]
            near = [(a, b) for a, b in pairs(len(ids)) if (codes[a] ^ codes[b]).bit_count() <= 3]
            assert sorted(after) == sorted({ids[r] for r in by_links(len(ids), near)})
        elif number == 5:
            assert after.keys() == before.keys()
            assert {i for i in after if after[i] != before[i]} == {i for i in before if by_search(before[i])}
            assert not any(by_search(t) for t in after.values())
        else:
            ids = {r["doc_id"]: None for r in rows}
            assert ids.keys() == before.keys()


def test_stages_take_odd_rows(spark, odd, none):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd, SMALL).columns == odd.columns, name
        assert stage(spark, none, SMALL).count() == 0, name
    lines = corpus_pipeline.drop_repeated_lines(spark, odd, SMALL)
    assert lines.count() == len(ODD)
    left = [r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, odd, SMALL).collect()]
    assert left.count(4) == 1 and not {2, 3, 9, None} & set(left)
    assert corpus_pipeline.redact_secrets(spark, odd, SMALL).count() == len(ODD)
    assert corpus_pipeline.pack_windows(spark, none, SMALL).count() == 0


def test_near_copies_move_texts_once(spark, odd):
    """The rows dealt to meet what stays are not dealt again to drop repeated ones."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = corpus_pipeline.drop_near_copies(spark, odd, SMALL)._jdf.queryExecution().executedPlan().toString()
        exchanges = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]
        assert "SortMergeJoin" in plan and exchanges and not any("mark" in line for line in exchanges), plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_run_gives_the_last_stage(spark):
    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(rows[0].asDict())


def test_queries_are_registered():
    names = entry.queries()
    assert "pipeline" in names and [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13
    assert queries.SQL.keys() <= names.keys()


NATIVE = ("op1_exact_dedup", "op2_line_dedup", "op5_secrets")


def test_native_operators_import_no_python_engines():
    for name in ("exact_dedup", "line_dedup", "secrets"):
        source = open(os.path.join(ROOT, "tidemark", "llm", f"{name}.py")).read()
        assert not re.search(r"import (numpy|pandas|pyarrow)|mapIn|applyIn|udf|\.rdd", source), name


@pytest.mark.parametrize("name", NATIVE)
def test_native_plans_have_no_python(spark, name):
    plan = queries.QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoop", plan)


def test_nothing_else_imports_the_subpackage():
    for folder in ("tidemark", "checks", "tests"):
        for where, _, files in os.walk(os.path.join(ROOT, folder)):
            if os.path.basename(where) == "llm":
                continue
            for f in files:
                if f.endswith(".py"):
                    assert not re.search(r"tidemark\.llm|corpus_pipeline", open(os.path.join(where, f)).read()), f
