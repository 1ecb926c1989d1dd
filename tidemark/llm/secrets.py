"""Secret scans over an incremental blob ledger.

Every version of a text is a blob named by its SHA-256. The ledger, two Parquet tables in a
shared folder, says which (blob, rule, rule version) have been scanned and what was found.
A scan looks only at pairs the ledger lacks, reads each such blob once however many paths
hold it, and joins findings back to all paths. DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import split_join, table, written
from tidemark.session import work_dir


@dataclass(frozen=True)
class Rule:
    """A Java pattern; matches whose ``group`` has fewer than ``least`` characters are dropped
    after matching. A change to a rule needs a new ``version``."""
    name: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1


RULES = (
    Rule("assign", 1, r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 16),
    # runs are maximal, so asking for 32 at once finds the same as dropping shorter runs
    Rule("hex", 1, r"[0-9a-f]{32,}", 0, 32),
    Rule("pem", 1, r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0, 1),
)
BASE = ("assign", "access", "hex")


def matches(text: Column, rule: Rule) -> Column:
    """An array of the rule's matches in order: the gap before each, its length, its group's."""
    gaps = F.split(text, rule.pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    part = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else whole
    return F.transform(F.arrays_zip(gaps.alias("gap"), whole.alias("whole"), part.alias("part")), lambda m: F.struct(
        F.length(m["gap"]).alias("gap"), F.length(m["whole"]).alias("size"), F.length(m["part"]).alias("value")))


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``blob, kind, version, start, end`` of what the rules in ``todo`` find in ``blob, text,
    todo``; places count code points, ends are exclusive."""
    def hits_of(r: Rule) -> Column:
        named = F.transform(matches(F.col("text"), r), lambda m, i: F.struct(
            F.lit(r.name).alias("kind"), F.lit(r.version).alias("version"), F.lit(r.least).alias("least"), i.alias("i"),
            m["gap"].alias("gap"), m["size"].alias("size"), m["value"].alias("value")))
        return F.when(F.array_contains("todo", r.name) & F.col("text").rlike(r.pattern), named)

    hits = F.flatten(F.filter(F.array(*map(hits_of, rules)), lambda h: h.isNotNull()))
    rows = blobs.select("blob", F.explode(hits).alias("m")).select("blob", "m.*").where("size IS NOT NULL")
    so_far = Window.partitionBy("blob", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("end", F.sum(F.col("gap").cast("long") + F.col("size")).over(so_far))
    return rows.where("value >= least").select(
        "blob", "kind", "version", (F.col("end") - F.col("size")).alias("start"), "end")


class Ledger:
    """The tables ``scanned`` and ``findings`` below a shared folder."""

    SCANNED = "blob string, kind string, version int"
    FINDINGS = "blob string, kind string, version int, start long, `end` long"

    def __init__(self, spark, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def read(self, name: str, schema: str) -> DataFrame:
        """A table of the ledger, empty if nothing was ever written; a repeated batch adds nothing."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        there = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)
        if not there:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}").distinct()

    def add(self, name: str, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(f"{self.path}/{name}")


def find(blobs: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scan what the ledger lacks of ``blob, text``, and return ``blob, spans`` of the blobs in the
    ledger that hold anything, for the rules' present versions.

    ``blob`` names ``text``, and rows may repeat. ``spans`` are structs ``start, rank, kind,
    end`` in that order, ``rank`` being the rule's place in ``rules``. Findings are written
    before the pairs that were scanned, so a scan that is broken off is taken up again
    without loss.
    """
    wanted = F.array(*[F.struct(F.lit(r.name).alias("kind"), F.lit(r.version).alias("version")) for r in rules])
    pairs = blobs.select("blob").distinct().select("blob", F.explode(wanted).alias("r")).select("blob", "r.*")
    fresh = written(pairs.join(ledger.read("scanned", Ledger.SCANNED), ["blob", "kind", "version"], "left_anti"), "unseen")
    todo = fresh.groupBy("blob").agg(F.collect_set("kind").alias("todo"))
    once = blobs.groupBy("blob").agg(F.min("text").alias("text"))
    ledger.add("findings", scan_blobs(once.join(todo, "blob"), rules))
    ledger.add("scanned", fresh)
    now = F.array(*[F.struct(F.lit(r.name).alias("kind"), F.lit(r.version).alias("version"), F.lit(i).alias("rank"))
                    for i, r in enumerate(rules)])
    found = ledger.read("findings", Ledger.FINDINGS).withColumn("rank", F.get(F.filter(
        now, lambda r: (r["kind"] == F.col("kind")) & (r["version"] == F.col("version"))), F.lit(0))["rank"])
    return found.where("rank IS NOT NULL").groupBy("blob").agg(
        F.sort_array(F.collect_list(F.struct("start", "rank", "kind", "end"))).alias("spans"))


def blob_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def with_spans(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``rows`` with the ``spans`` of their ``blob``; an empty array where nothing was found."""
    empty = F.array().cast(found.schema["spans"].dataType)
    return split_join(rows, found, ["blob"], "left").withColumn("spans", F.coalesce("spans", empty))


def scan(versions: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scan ``path, text`` rows, every one a version of what stands under its path.

    Returns one row per row of ``versions``: ``path, blob, spans``. A null text is empty, and
    a null path is a path like others. See ``find`` for the spans.
    """
    versions = versions.select("path", F.coalesce("text", F.lit("")).alias("text")).withColumn("blob", blob_of(F.col("text")))
    paths = written(versions.select("path", "blob"), "paths")
    return with_spans(paths, find(versions.select("blob", "text"), ledger, rules))


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with every stretch that the sorted ``spans`` cover replaced by ``mark``."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def cut(done, s):
        return F.when(s["start"] >= done["at"], F.struct(
            F.concat(done["out"], F.substring(text, (done["at"] + 1).cast("int"), (s["start"] - done["at"]).cast("int")),
                     F.lit(mark)).alias("out"), s["end"].alias("at"))).otherwise(
            F.struct(done["out"].alias("out"), F.greatest(done["at"], s["end"]).alias("at")))

    return F.aggregate(spans, start, cut, lambda done: F.concat(
        done["out"], F.substring(text, (done["at"] + 1).cast("int"), F.length(text))))


def listed(spans: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op5_secrets(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("path"), "text")
    found = scan(docs, Ledger(spark, work_dir(spark, "ledger")))

    def of(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return found.select(F.col("path").alias("doc_id"), *map(of, BASE), F.sha2(listed(base), 256).alias("base_sha256"),
                        listed(F.col("spans")).alias("spans"))
