"""From raw documents to training windows, in five stages.

Each stage takes what the one before kept, as a Parquet table, and all but the last return
the columns of ``documents``; other columns are carried along. Null texts count as empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import line_dedup, packing, secrets, simhash, toxicity
from tidemark.llm.common import free_name, table
from tidemark.session import work_dir


def with_text(docs: DataFrame, text) -> DataFrame:
    """``docs`` with another ``text``; ``n_chars`` follows it where there is such a column."""
    docs = docs.withColumn("text", text)
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if (
        "n_chars" in docs.columns) else docs


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score below a half stay. The model learns from the labels that its own
    query may learn from; without usable labels everything stays."""
    known = toxicity.known_labels(table(spark, sf_dir, "labels"), "toxic", toxicity.FOLDS, toxicity.FOLD)
    model = toxicity.train(docs, known)
    name = free_name(docs, "score")
    return toxicity.score(docs, model, name).where(F.col(name) < 0.5).drop(name)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand elsewhere first, exactly or within two edits, go. All documents stay,
    with an empty text where no line of theirs does; the next stage sees these as one group."""
    columns = docs.columns
    own = docs.select("doc_id", "text", F.struct(*[F.col(c) for c in columns]).alias("row"))
    clean = line_dedup.line_dedup(own)
    back = clean.select(*[F.col("row")[c].alias(c) for c in columns if c != "text"], "text")
    return with_text(back, F.col("text")).select(*columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of the documents that links connect the one with the smallest identifier stays, once if
    its row is repeated. Documents without identifier stay where their group has none. Links
    are those of ``op6_simhash``: fingerprints of three-word shingles within three bits."""
    groups = simhash.near_groups(docs.select("doc_id", "text"), limit=3, shingle=3)
    # plain keys without nulls: the rows dealt for the join are then dealt for the repeated ones too, and texts move once
    known, key = free_name(docs, "known"), free_name(docs, "key")

    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumn(known, F.col("doc_id").isNotNull()).withColumn(
            key, F.coalesce("doc_id", F.lit(0).cast(docs.schema["doc_id"].dataType)))

    first = keyed(groups.where(F.col("doc_id").eqNullSafe(F.col("component_id")))).select(known, key).distinct()
    mark = free_name(docs, "mark")
    docs = keyed(docs).join(first, [known, key], "left_semi").withColumn(mark, F.xxhash64("doc_id", "text"))
    return docs.dropDuplicates([known, key, mark]).drop(known, key, mark)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; all documents stay."""
    columns = docs.columns
    rows = docs.select(F.struct(*[F.col(c) for c in columns]).alias("row"),
                       F.coalesce("text", F.lit("")).alias("text")).withColumn("blob", secrets.blob_of(F.col("text")))
    ledger = secrets.Ledger(spark, work_dir(spark, "ledger"))
    found = secrets.with_spans(rows, secrets.find(rows.select("blob", "text"), ledger))
    back = found.select(*[F.col("row")[c].alias(c) for c in columns if c != "text"],
                        secrets.redacted(F.col("text"), F.col("spans")).alias("text"))
    return with_text(back, F.col("text")).select(*columns)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training windows of 2048 tokens; see ``packing.pack``."""
    return packing.pack_texts(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("SimHash near-dedup", drop_near_copies),
    ("secret scans", redact_secrets),
    ("packing", pack_windows),
]

#: A learnt classifier and tokens by a vocabulary file are beyond SQL; tests hold the stages
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_dir(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
