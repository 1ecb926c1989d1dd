"""Exact document dedup by content-defined chunk recipes.

A text is cut where its own content says so, so equal passages give equal chunks wherever
they stand. Distinct chunks are compared byte by byte once and get verified identifiers; a
document is then its list of identifiers, and only these short lists are grouped. Chunk text
moves once, after duplicates have been merged in each task; whole texts never move.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import ascii_lower, table, written


def cut_pattern(least: int = 256, most: int = 2048) -> str:
    """A chunk ends, after ``least`` characters, at a line end or at a space after ``t`` or
    ``s``, else at ``most`` characters."""
    return rf"(?s).{{{least},{most - 1}}}?(?:\n|[ts] )|.{{1,{most}}}"


def chunk_recipes(docs: DataFrame, text: str, chunk_hash: Callable[[Column], Column] = F.xxhash64,
                  pattern: str | None = None) -> DataFrame:
    """``docs`` with ``recipe`` instead of the column ``text``: the ordered identifiers of its chunks.

    An identifier is the chunk's hash and its rank among the different chunks of that hash,
    which are told apart by their bytes. Only hashes that stand for several chunks need
    ranks above 0, so documents are joined to ranks only if there are such hashes. An empty
    text has an empty recipe. ``docs`` has no columns named ``chunks``, ``recipe`` or ``row``.
    """
    docs = docs.withColumn("chunks", F.regexp_extract_all(text, F.lit(pattern or cut_pattern()), F.lit(0)))
    distinct = docs.select(F.explode("chunks").alias("chunk")).distinct().withColumn("h", chunk_hash(F.col("chunk")))
    clashes = written(distinct.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"), "clashes")
    if clashes.isEmpty():
        plain = F.transform("chunks", lambda c: F.struct(chunk_hash(c).alias("h"), F.lit(1).alias("rank")))
        return docs.withColumn("recipe", plain).drop("chunks", text)
    by_bytes = Window.partitionBy("h").orderBy("chunk")
    ranks = written(distinct.join(clashes, "h").withColumn("rank", F.row_number().over(by_bytes)), "ranks")
    rows = written(docs.drop(text).withColumn("row", F.monotonically_increasing_id()), "chunked")
    placed = rows.select("row", F.posexplode("chunks").alias("pos", "chunk")).withColumn(
        "h", chunk_hash(F.col("chunk"))).join(ranks, ["h", "chunk"], "left")
    lists = placed.groupBy("row").agg(F.sort_array(F.collect_list(F.struct(
        "pos", "h", F.coalesce("rank", F.lit(1)).alias("rank")))).alias("placed"))
    return rows.drop("chunks").join(lists, "row", "left").withColumn("recipe", F.transform(
        F.coalesce("placed", F.array().cast(lists.schema["placed"].dataType)),
        lambda p: F.struct(p["h"].alias("h"), p["rank"].alias("rank")))).drop("placed", "row")


def exact_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                chunk_hash: Callable[[Column], Column] = F.xxhash64, pattern: str | None = None) -> DataFrame:
    """One row per document with the document that stays for its text.

    Texts are equal when identical after lower-casing A-Z; a null text counts as empty. Of
    equal texts the largest identifier stays; a null identifier stays only where a group has
    no other, and repeated rows of the identifier that stays are all marked kept. Other
    columns of ``docs`` are not read. A text that a large part of all rows share is counted
    in each task before it meets itself, and the join back is one that adaptive execution
    splits.

    Returns ``doc_id, keep_id, group_size, kept, text_sha256, n_chunks``.
    """
    body = docs.select(F.col(id_column).alias("doc_id"),
                       ascii_lower(F.coalesce(F.col(text_column), F.lit(""))).alias("body"))
    body = body.withColumn("text_sha256", F.sha2("body", 256))
    recipes = written(chunk_recipes(body, "body", chunk_hash, pattern), "recipes")
    # written, so that the join deals both sides anew and a recipe with very many rows can be split
    groups = written(recipes.groupBy("recipe").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "groups")
    return recipes.join(groups, "recipe").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256",
        F.size("recipe").alias("n_chunks"))


def op1_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents")).drop("n_chunks")


SQL = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
           FROM documents),
     g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(t) AS text_sha256
FROM d JOIN g USING (t)
"""
