"""Scans, copies, dumps and restores of the message log."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from checks import views as v
from checks.registry import query
from tidemark.functions.identifiers import encode_key
from tidemark.operators import exchange, log, probes
from tidemark.session import kept, work_dir
from tidemark.sources import files, indexed_log, published

COLUMNS = 'topic, partition, "offset", key, event_id, value, "timestamp"'
START, END = "2024-01-10 00:00:00", "2024-01-20 12:00:00"
IN_RANGE = f"\"timestamp\" >= TIMESTAMP '{START}' AND \"timestamp\" < TIMESTAMP '{END}'"


def flat(df):
    return df.select("topic", "partition", "offset", F.hex("key").alias("key"), "value.event_id", "value.value",
                     "timestamp")


@query("log_scan", f"SELECT {COLUMNS} FROM v_log", "v_log")
def log_scan(spark, sf):
    return flat(log.scan_log(v.v_log(spark, sf)))


@query("to_log", """SELECT event_type AS topic, printf('%016X', user_id) AS key, event_id, ts AS "timestamp",
    true AS own_partition, true AS next_offset FROM events""")
def to_log(spark, sf):
    """All topics, keyed. SQL has no CRC, so each row says whether its partition is that of its
    key and whether its offset follows the one before it in time."""
    e = v.table(spark, sf, "events")
    out = log.to_log(e, F.col("event_type"), encode_key(F.col("user_id")), F.col("ts"), F.struct("event_id"), 3,
                     ties=[F.col("event_id")])
    place = F.row_number().over(Window.partitionBy("topic", "partition").orderBy("timestamp", "value.event_id")) - 1
    return out.select("topic", F.hex("key").alias("key"), "value.event_id", "timestamp",
                      (F.col("partition") == F.crc32("key") % 3).alias("own_partition"),
                      (F.col("offset") == place).alias("next_offset"))


@query("log_scan_range", f"SELECT {COLUMNS} FROM v_log WHERE {IN_RANGE}", "v_log")
def log_scan_range(spark, sf):
    return flat(log.scan_log(v.v_log(spark, sf), start=START, end=END))


@query("log_scan_exact", f"""SELECT {COLUMNS} FROM v_log WHERE "timestamp" =
    (SELECT min(ts) FROM events WHERE event_type = 'click')""", "v_log")
def log_scan_exact(spark, sf):
    first = v.table(spark, sf, "events").where("event_type = 'click'").agg(F.min("ts").alias("t"))
    return flat(log.scan_log(v.v_log(spark, sf), at=first.scalar()))


@query("log_latest", f"""SELECT {COLUMNS} FROM v_log
    QUALIFY row_number() OVER (PARTITION BY topic, partition ORDER BY "offset" DESC) = 1""", "v_log")
def log_latest(spark, sf):
    return flat(log.latest(v.v_log(spark, sf)))


@query("log_head", f"""SELECT {COLUMNS} FROM v_log WHERE "offset" < 5""", "v_log")
def log_head(spark, sf):
    return flat(log.head(v.v_log(spark, sf), 5))


@query("log_head_gaps", f"""SELECT {COLUMNS} FROM v_log WHERE event_id % 4 <> 0
    QUALIFY row_number() OVER (PARTITION BY topic, partition ORDER BY "offset") <= 5""", "v_log")
def log_head_gaps(spark, sf):
    """A compacted log, whose offsets have gaps."""
    return flat(log.head(v.v_log(spark, sf).where("value.event_id % 4 <> 0"), 5))


@query("log_tail", f"""SELECT {COLUMNS} FROM v_log WHERE partition = 1
    QUALIFY row_number() OVER (PARTITION BY topic ORDER BY "offset" DESC) <= 3""", "v_log")
def log_tail(spark, sf):
    return flat(log.tail(v.v_log(spark, sf), 3, partition=1))


@query("log_grep", f"""SELECT event_id, user_id, value, coalesce(tag, -1) AS tag, printf('%016X', user_id) AS key FROM v_log
    WHERE {IN_RANGE} AND (tag IS NULL OR tag = 3) ORDER BY "timestamp", topic, partition, "offset" LIMIT 100""", "v_log")
def log_grep(spark, sf):
    found = log.grep(v.v_log(spark, sf), filters={"tag": 3, "absent": "x"}, start=START, end=END, n=100, meta=True)
    return found.select("event_id", "user_id", "value", F.coalesce("tag", F.lit(-1)).alias("tag"), F.hex("key").alias("key"))


@query("log_grep_typed", f"""SELECT event_id, user_id, value, event_type AS kind, even FROM (
        SELECT *, topic AS event_type, event_id % 2 = 0 AS even FROM v_log)
    WHERE even AND value >= 2 AND value < 3 AND {IN_RANGE}""", "v_log")
def log_grep_typed(spark, sf):
    """A boolean, and a number that text would write in another way."""
    typed = v.v_log(spark, sf).withColumn("value", F.struct(
        "value.event_id", "value.user_id", "value.value", F.col("topic").alias("kind"),
        (F.col("value.event_id") % 2 == 0).alias("even"), (F.floor("value.value") * 5e14).alias("scaled")))
    return log.grep(typed, filters={"even": True, "scaled": 1e15}, start=START, end=END).drop("scaled")


@query("log_grep_key", f"""SELECT event_id, user_id, value, coalesce(tag, -1) AS tag FROM v_log WHERE user_id = 7 AND partition = 1
    AND {IN_RANGE}""", "v_log")
def log_grep_key(spark, sf):
    found = log.grep(v.v_log(spark, sf), key=encode_key(F.lit(7)), partition=1, start=START, end=END)
    return found.select("event_id", "user_id", "value", F.coalesce("tag", F.lit(-1)).alias("tag"))


@query("log_offsets", """SELECT topic, partition, min("offset") AS low, max("offset") + 1 AS high FROM v_log
    GROUP BY ALL""", "v_log")
def log_offsets(spark, sf):
    return log.offsets(v.v_log(spark, sf))


@query("log_describe", "SELECT topic, count(DISTINCT partition) AS partitions FROM v_log GROUP BY ALL", "v_log")
def log_describe(spark, sf):
    return log.describe(v.v_log(spark, sf))


@query("log_create_time", f"SELECT {COLUMNS} FROM v_log WHERE event_id % 10 <> 0", "v_log")
def log_create_time(spark, sf):
    stamped = v.v_log(spark, sf).withColumn(
        "timestampType", F.when(F.col("value.event_id") % 10 == 0, 1).otherwise(0))
    return flat(log.create_time_only(stamped))


@query("log_copy", f"""SELECT 'copied' AS topic, (user_id % 3)::INTEGER AS partition,
    row_number() OVER (PARTITION BY user_id % 3 ORDER BY "offset") - 1 AS "offset", key, event_id,
    "timestamp" FROM v_log WHERE topic = 'error' AND {IN_RANGE}""", "v_log")
def log_copy(spark, sf):
    source = log.scan_log(v.v_log(spark, sf), topic="error")
    return flat(log.copy_log(source, "copied", start=START, end=END)).drop("value")


@query("log_copy_topics", f"""SELECT 'copied' AS topic, partition,
    row_number() OVER (PARTITION BY partition ORDER BY "offset", topic) - 1 AS "offset", key, event_id, "timestamp"
    FROM v_log WHERE {IN_RANGE}""", "v_log")
def log_copy_topics(spark, sf):
    """All topics copied into one, which has each offset once."""
    return flat(log.copy_log(v.v_log(spark, sf), "copied", start=START, end=END)).drop("value")


@query("log_copy_repartitioned", """SELECT 'copied' AS topic, key, event_id, "timestamp", true AS own_partition,
    count(*) OVER () AS messages FROM v_log""", "v_log")
def log_copy_repartitioned(spark, sf):
    """The partition is a CRC of the key; that it is the same for all of a key is checked."""
    moved = log.copy_log(v.v_log(spark, sf), "copied", partitions=4)
    total = moved.agg(F.count(F.lit(1)).alias("n")).scalar()
    return moved.select(
        "topic", F.hex("key").alias("key"), "value.event_id", "timestamp",
        (F.col("partition") == F.crc32("key") % 4).alias("own_partition"), total.alias("messages"))


@query("log_dump_manifest", f"""SELECT 'error' AS name, TIMESTAMP '{START}' AS start_ts,
    max("timestamp") AS end_ts, count(*) AS messages, count(DISTINCT partition) AS partition_count,
    'error.' || strftime(TIMESTAMP '{START}', '%Y-%m-%dT%H:%M') || '--'
        || strftime(max("timestamp"), '%Y-%m-%dT%H:%M') AS file_name
    FROM v_log WHERE topic = 'error' AND "timestamp" >= TIMESTAMP '{START}'""", "v_log")
def log_dump_manifest(spark, sf):
    error = log.scan_log(v.v_log(spark, sf), topic="error")
    return log.manifest(error, "error", start=START).drop("config", "replication_factor")


@query("log_restore", f"""SELECT 'again' AS topic, partition,
    row_number() OVER (PARTITION BY partition ORDER BY "offset") - 1 AS "offset", key, event_id, value, "timestamp"
    FROM v_log WHERE topic = 'view' AND {IN_RANGE}""", "v_log")
def log_restore(spark, sf):
    """Dump a topic to files, then restore a time range of it under another name."""
    path = work_dir(spark, "dump")
    files.dump_log(log.scan_log(v.v_log(spark, sf), topic="view"), path, "view")
    return flat(files.restore_log(spark, path, topic="again", start=START, end=END))


@query("log_restore_topics", f"""SELECT topic, partition,
    row_number() OVER (PARTITION BY topic, partition ORDER BY "offset") - 1 AS "offset", key, event_id, value,
    "timestamp" FROM v_log WHERE {IN_RANGE}""", "v_log")
def log_restore_topics(spark, sf):
    """Dump all topics, then restore a time range of them under their own names."""
    path = work_dir(spark, "dump")
    files.dump_log(v.v_log(spark, sf), path, "all")
    return flat(files.restore_log(spark, path, start=START, end=END))


@query("log_written_scan", f"SELECT {COLUMNS} FROM v_log WHERE topic = 'purchase' AND {IN_RANGE}", "v_log")
def log_written_scan(spark, sf):
    """Write the log in folders by topic and date, then scan a pruned range."""
    path = work_dir(spark, "log")
    files.write_log(v.v_log(spark, sf), path)
    return flat(log.scan_log(files.read_log(spark, path), topic="purchase", start=START, end=END))


@query("table_append", """SELECT timebin, originasn_id, asn_id, hege, 4 AS af FROM v_hege_rows WHERE hege <> 0""",
       "v_hege v_hege_rows")
def table_append(spark, sf):
    """Append score rows to a dated table and read them back."""
    from tidemark.plans.scores import as_hegemony

    path = work_dir(spark, "scores")
    rows, _ = as_hegemony(v.v_hege(spark, sf), 4)
    files.append_table(rows, path, ["timebin", "originasn_id", "asn_id", "hege", "af"])
    return spark.read.parquet(path).drop("date")


@query("guarded_replace", """SELECT 'kept' AS which, o_orderkey AS id FROM orders
    WHERE (SELECT count(*) FROM orders WHERE o_orderkey % 3 = 0) - (SELECT count(*) FROM orders) <= -4000
    UNION ALL SELECT 'new', o_orderkey FROM orders WHERE o_orderkey % 3 = 0
    AND (SELECT count(*) FROM orders WHERE o_orderkey % 3 = 0) - (SELECT count(*) FROM orders) > -4000""")
def guarded_replace(spark, sf):
    old = v.table(spark, sf, "orders").select(F.lit("kept").alias("which"), F.col("o_orderkey").alias("id"))
    new = old.where("id % 3 = 0").withColumn("which", F.lit("new"))
    return log.replace_if_not_shrunk(new, old)


@query("probe_snapshot", """SELECT id, "offset", coalesce(address_v4, '') AS address_v4,
    coalesce(prefix_v4, '') AS prefix_v4, CASE WHEN placed THEN lon ELSE 0 END AS lon,
    CASE WHEN placed THEN lat ELSE 0 END AS lat FROM v_probe_archive
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY "offset" DESC) = 1""", "v_probe_archive")
def probe_snapshot(spark, sf):
    return flat_snapshot(probes.latest_snapshot(v.v_probe_archive(spark, sf), "id"))


def flat_snapshot(last):
    last = probes.probe_defaults(last)
    return last.select("id", "offset", "address_v4", "prefix_v4", F.col("coordinates")[0].alias("lon"),
                       F.col("coordinates")[1].alias("lat"))


@query("probe_filter", """SELECT id, lon, lat FROM v_probe WHERE asn_v4 IN (1, 2, 3, 5, 8, 13, 21, 34, 22, 27)
    AND country_code IN ('AA', 'CA', 'DA', 'FA', 'GA')
    AND (2 * 6371 * asin(sqrt(least(1, sin(radians(lat - 8) / 2) ** 2
            + cos(radians(lat)) * cos(radians(8)) * sin(radians(lon + 22) / 2) ** 2))) <= 900
      OR 2 * 6371 * asin(sqrt(least(1, sin(radians(lat - 27) / 2) ** 2
            + cos(radians(lat)) * cos(radians(27)) * sin(radians(lon + 3) / 2) ** 2))) <= 900)""", "v_probe")
def probe_filter(spark, sf):
    known = probes.probe_defaults(v.v_probe(spark, sf))
    picked = probes.filter_probes(known, asns=[1, 2, 3, 5, 8, 13, 21, 34, 22, 27],
                                  countries=["AA", "CA", "DA", "FA", "GA"],
                                  near=[(-22.0, 8.0), (-3.0, 27.0)], km=900)
    return picked.select("id", F.col("coordinates")[0].alias("lon"), F.col("coordinates")[1].alias("lat"))


@query("ok_only", "SELECT * FROM v_ixpfx WHERE status = 'ok'", "v_ixpfx")
def ok_only(spark, sf):
    return exchange.read_ok(v.v_ixpfx(spark, sf))


def _indexed(spark, sf):
    """The log appended in three batches, one of them twice, as a published log with an index."""
    whole, path = kept(v.v_log(spark, sf)), work_dir(spark, "indexed")
    third = F.least(F.floor(F.dayofmonth("timestamp") / 11), F.lit(2))
    for batch in (0, 1, 1, 2):
        indexed_log.append(whole.where(third == batch), path, "appends", batch)
    return path, whole.schema


@query("log_index_scan", f"SELECT {COLUMNS} FROM v_log", "v_log")
def log_index_scan(spark, sf):
    path, schema = _indexed(spark, sf)
    return flat(indexed_log.read(spark, path, schema))


@query("log_index_compacted", f"""SELECT {COLUMNS} FROM v_log
    QUALIFY row_number() OVER (PARTITION BY topic, partition ORDER BY "offset" DESC) <= 40""", "v_log")
def log_index_compacted(spark, sf):
    """The batches written as one, then the ends of all partitions."""
    path, schema = _indexed(spark, sf)
    indexed_log.compact(spark, path, schema)
    return flat(indexed_log.tail(spark, path, schema, 40, None))


@query("log_index_latest", f"""SELECT {COLUMNS} FROM v_log
    QUALIFY row_number() OVER (PARTITION BY topic, partition ORDER BY "offset" DESC) = 1""", "v_log")
def log_index_latest(spark, sf):
    path, schema = _indexed(spark, sf)
    return flat(indexed_log.latest(spark, path, schema))


@query("log_index_tail", f"""SELECT {COLUMNS} FROM v_log WHERE partition = 1
    QUALIFY row_number() OVER (PARTITION BY topic ORDER BY "offset" DESC) <= 3""", "v_log")
def log_index_tail(spark, sf):
    path, schema = _indexed(spark, sf)
    return flat(indexed_log.tail(spark, path, schema, 3, partition=1))


@query("log_index_head", f"""SELECT {COLUMNS} FROM v_log WHERE "offset" < 5""", "v_log")
def log_index_head(spark, sf):
    path, schema = _indexed(spark, sf)
    return flat(indexed_log.head(spark, path, schema, 5))


@query("log_index_offsets", """SELECT topic, partition, min("offset") AS low, max("offset") + 1 AS high FROM v_log
    GROUP BY ALL""", "v_log")
def log_index_offsets(spark, sf):
    return indexed_log.offsets(spark, _indexed(spark, sf)[0])


@query("log_index_seek", f"""SELECT {COLUMNS} FROM v_log WHERE "timestamp" >= TIMESTAMP '{END}'""", "v_log")
def log_index_seek(spark, sf):
    """From the offsets that the index gives for a time on, the messages at or after it."""
    path, schema = _indexed(spark, sf)
    start = indexed_log.seek(spark, path, END).withColumnRenamed("offset", "from_offset")
    found = indexed_log.read(spark, path, schema).join(F.broadcast(start), ["topic", "partition"])
    return flat(log.scan_log(found.where("offset >= from_offset"), start=END))


@query("log_copy_observed", f"""SELECT 'copied' AS topic, count(*) AS messages, count(*) AS stored FROM v_log
    WHERE {IN_RANGE}""", "v_log")
def log_copy_observed(spark, sf):
    """The count that the writing pass has seen, and what is stored."""
    path = work_dir(spark, "copy")
    written = files.write_log(log.copy_log(v.v_log(spark, sf), "copied", start=START, end=END), path)
    return files.read_log(spark, path).groupBy("topic").agg(
        F.lit(written.rows).cast("bigint").alias("messages"), F.count(F.lit(1)).alias("stored"))


@query("table_append_once", """SELECT timebin, originasn_id, asn_id, hege, 4 AS af FROM v_hege_rows WHERE hege <> 0""",
       "v_hege v_hege_rows")
def table_append_once(spark, sf):
    """Four batches appended, each of them twice, then written as one."""
    from tidemark.plans.scores import as_hegemony

    path, columns = work_dir(spark, "scores"), ["timebin", "originasn_id", "asn_id", "hege", "af"]
    rows = as_hegemony(v.v_hege(spark, sf), 4)[0].select(*columns)
    for batch in (0, 1, 0, 2, 3, 1, 2, 3):
        published.append_table_once(rows.where(F.col("asn_id") % 4 == batch), path, columns, "scores", batch)
    dated = rows.withColumn("date", F.to_date("timebin")).schema
    published.compact(spark, path, dated, ["date"])
    return published.read(spark, path, dated).drop("date")
