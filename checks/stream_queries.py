"""Streaming forms, run to the end of the given tables.

Each reads a table as a stream. The SQL covers the bins that the watermark has closed.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import views as v
from checks.event_queries import HISTORY, SPEC, SPEC_MEDIAN, anomaly_sql, flat_anomalies, flat_batches
from checks.log_queries import flat_snapshot
from checks.registry import SQL, query
from checks.score_queries import CONE, COUNTRY_SCORES
from tidemark.operators import bgp, hegemony, probes
from tidemark.plans import scores
from tidemark.session import kept, work_dir
from tidemark.streaming import bins, carried, detector, outages, records, registration, runs, snapshot

CLOSED = "timebin <= (SELECT max(timebin) FROM {0}) - INTERVAL 31 DAY"


@query("hegemony_cone_stream", f"""SELECT timebin, {CONE} AS conesize, 4 AS af, asn_id FROM v_hege_rows
    WHERE {CLOSED.format('v_hege_rows')} GROUP BY timebin, asn_id""", "v_hege v_hege_rows")
def hegemony_cone_stream(spark, sf):
    rows = hegemony.score_rows(v.v_hege(spark, sf, v.stream_table))
    return runs.drain(bins.cone_stream(rows, 4, "31 days"), "cones")


@query("moas_stream", f"SELECT timebin, prefix, moas FROM v_moas WHERE {CLOSED.format('v_moas')}",
       "v_prefix_rows v_moas")
def moas_stream(spark, sf):
    rows = scores.prefix_rows(v.v_hege_prefix(spark, sf, v.stream_table))
    return runs.drain(bins.moas_stream(rows, "31 days"), "moas")


@query("hegemony_rows_stream", "SELECT timebin, originasn_id, asn_id, hege, 4 AS af FROM v_hege_rows WHERE hege <> 0",
       "v_hege v_hege_rows")
def hegemony_rows_stream(spark, sf):
    return runs.drain(scores.as_hegemony(v.v_hege(spark, sf, v.stream_table), 4)[0], "scores")


def in_turn(spark, rows, by, run, n=3, part=None):
    """Write rows in ``n`` parts by equal ranges of ``by``, or by ``part(range)``; after each one start
    ``run(stream)``, which goes on from its checkpoint, and let it take what is there."""
    path = work_dir(spark, "turns")
    low, high = rows.agg(F.min(by), F.max(by)).first()
    at = F.floor((by - F.lit(low)) / F.lit(((high or 0) - (low or 0)) // n + 1))
    cut = rows.withColumn("_part", at if part is None else part(at))
    for k in range(n):
        cut.where(F.col("_part") == k).drop("_part").write.mode("append").parquet(path)
        run(runs.read_files(spark, path, rows.schema)).awaitTermination()


@query("anomalies_stream", anomaly_sql("mean_dev"), HISTORY)
def anomalies_stream(spark, sf):
    """State crosses batches and restarts."""
    series, path = v.v_series(spark, sf), work_dir(spark, "anomalies")
    found = lambda rows: detector.anomalies_stream(rows, SPEC)
    in_turn(spark, series, F.unix_micros("timestamp"),
            lambda stream: runs.start(found(stream), f"{path}/found", checkpoint=f"{path}/checkpoint"))
    return flat_anomalies(spark.read.parquet(f"{path}/found"))


@query("anomalies_stream_median", anomaly_sql("mad"), HISTORY)
def anomalies_stream_median(spark, sf):
    stream = v.v_series(spark, sf, v.stream_table)
    return flat_anomalies(runs.drain(detector.anomalies_stream(stream, SPEC_MEDIAN), "anomalies"))


def _followed(spark, sf, turns=1):
    """Bursts and reconnects are written as topics, read as streams and followed; in more turns,
    reconnections come in batches before and after their burst. A turn has as many files as it needs."""
    base = work_dir(spark, "outages")
    topics = {"bursts": (v.v_burst(spark, sf), "streamname"), "reconnects": (v.v_reconnect(spark, sf), "offset")}
    dealt = {name: topic.withColumn("_turn", F.pmod(F.xxhash64(by), F.lit(turns))) for name, (topic, by) in topics.items()}
    if turns > 1:
        dealt = {name: kept(topic) for name, topic in dealt.items()}
    for k in range(turns):
        for name, topic in dealt.items():
            topic.where(F.col("_turn") == k).drop("_turn").write.mode("append").parquet(f"{base}/topic-{name}")
        streams = [runs.read_files(spark, f"{base}/topic-{name}", topic.schema) for name, (topic, _) in topics.items()]
        outages.follow(*streams, f"{base}/stored").awaitTermination()
    return f"{base}/stored"


@query("disco_stream", SQL["disco_events"])
def disco_stream(spark, sf):
    return outages.current_events(spark, _followed(spark, sf))


@query("disco_lifecycle", SQL["disco_events"])
def disco_lifecycle(spark, sf):
    """Over several batches: inserts, updates and deletes of single events."""
    return outages.current_events(spark, _followed(spark, sf, 3))


@query("disco_lifecycle_probes", SQL["disco_probes"])
def disco_lifecycle_probes(spark, sf):
    known = probes.probe_defaults(v.v_probe(spark, sf))
    return outages.current_probes(spark, _followed(spark, sf, 3), known)


def _registered(spark, rows, by, plan, base, key):
    """Batches by ranges of ``by``, each of as many files as it needs; rows without it come first."""
    path = work_dir(spark, "registered")
    in_turn(spark, rows, F.col(by), lambda stream: registration.register_stream(stream, plan, base, path, key),
            part=lambda at: F.coalesce(at, F.lit(0)))
    return path, registration.registered(spark, path, base.schema)


def _named(rows, dim, ids, text):
    """The rows with the texts that their ids stand for."""
    for column, out in ids.items():
        rows = rows.join(dim.select(F.col("id").alias(column), text.alias(out)), column).drop(column)
    return rows


LOCATION = ["type", "name", "af"]


@query("delay_rows_stream", """SELECT make_timestamp(ts * 1000000) AS timebin, startpoint, endpoint, median, nbtracks,
    nbprobes, entropy, hop, nbrealrtts FROM v_delay""", "v_delay")
def delay_rows_stream(spark, sf):
    """Locations are registered while the stream runs; ids are read back as the texts they stand for."""
    rows, base = v.v_delay(spark, sf), v.v_location_dim(spark, sf)
    plan = scores.network_delay
    path, dim = _registered(spark, rows, "ts", plan, base, LOCATION)
    found = registration.result(spark, path, plan(rows.limit(0), base)[0].schema)
    return _named(found, dim, {"startpoint_id": "startpoint", "endpoint_id": "endpoint"},
                  F.concat("type", "name", F.lit("v"), "af"))


@query("delay_locations_stream", "SELECT type, name, af, 1::BIGINT AS ids, true AS own FROM v_delay_dim",
       "v_location_dim v_delay v_delay_seen v_delay_dim")
def delay_locations_stream(spark, sf):
    """Each location has one id, and no id stands for two."""
    _, dim = _registered(spark, v.v_delay(spark, sf), "ts", scores.network_delay, v.v_location_dim(spark, sf), LOCATION)
    shared = dim.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    return dim.join(shared, "id").groupBy(*LOCATION).agg(F.count(F.lit(1)).alias("ids"), (F.max("n") == 1).alias("own"))


@query("tr_hegemony_stream", "SELECT timebin, origin, dependency, hege, 4 AS af, nbsamples FROM v_tr_rows",
       "v_tr v_tr_rows")
def tr_hegemony_stream(spark, sf):
    rows, base = v.v_tr(spark, sf), v.v_location_dim(spark, sf)
    plan = lambda batch, known: scores.tr_hegemony(batch, 4, known)
    path, dim = _registered(spark, rows, "timestamp", plan, base, LOCATION)
    found = registration.result(spark, path, plan(rows.limit(0), base)[0].schema)
    return _named(found, dim, {"origin_id": "origin", "dependency_id": "dependency"}, F.concat("type", F.lit(":"), "name"))


def _countries(spark, sf):
    names = v.v_country_names(spark, sf)
    base = v.v_country_dim(spark, sf).withColumn("known", F.lit(True))
    plan = lambda batch, known: (
        scores.country_hegemony(batch, 4), scores.countries(batch, known.drop("known"), names))
    path, dim = _registered(spark, v.v_hege_country(spark, sf), "ts", plan, base, ["code"])
    return path, dim


@query("country_hegemony_stream", COUNTRY_SCORES.format("v_country"), "v_country")
def country_hegemony_stream(spark, sf):
    schema = scores.country_hegemony(v.v_hege_country(spark, sf), 4).schema
    return registration.result(spark, _countries(spark, sf)[0], schema)


@query("country_dim_stream", SQL["country_dim"])
def country_dim_stream(spark, sf):
    return _countries(spark, sf)[1]


@query("bgp_batches_stream", SQL["bgp_batches"])
def bgp_batches_stream(spark, sf):
    """Files end in the middle of records."""
    rows, path = v.v_bgp(spark, sf), work_dir(spark, "records")
    in_turn(spark, rows, F.col("pos"), lambda stream: records.batch_stream(bgp.bgp_elements(stream), path), n=4)
    return flat_batches(records.batched(spark, path, bgp.bgp_elements(rows), ended=True))


@query("valid_records_stream", SQL["valid_records"])
def valid_records_stream(spark, sf):
    rows, path = v.v_bgp(spark, sf), work_dir(spark, "valid")
    in_turn(spark, rows, F.col("pos"), lambda stream: records.valid_stream(stream, path), n=2)
    good, bad = (carried.result(spark, path, name, rows.schema).select("pos", "status", F.lit(kept).alias("kept"))
                 for name, kept in (("valid", True), ("rejects", False)))
    return good.unionByName(bad)


@query("visibility_stream", f"""SELECT timebin, prefix, originasn_id, max(nb_peers)::INTEGER AS nb_peers, peer_max,
    round(100.0 * max(nb_peers) / peer_max, 6) AS visibility FROM v_prefix_rows JOIN v_peer_max USING (timebin)
    WHERE {CLOSED.format('v_prefix_rows')} GROUP BY timebin, prefix, originasn_id, peer_max""", "v_prefix_rows v_peer_max")
def visibility_stream(spark, sf):
    """The most peers of earlier bins are known to later batches."""
    rows, path = v.v_hege_prefix(spark, sf), work_dir(spark, "visibility")
    in_turn(spark, rows, F.col("timestamp"),
            lambda stream: bins.visibility_stream(scores.prefix_rows(stream), path, "31 days"))
    return bins.visible(spark, path).withColumn("visibility", F.round("visibility", 6))


TURNS = """WITH r AS (SELECT timebin, originasn_id, asn_id, hege, n, ts, min(ts) OVER () AS low,
        (max(ts) OVER () - min(ts) OVER ()) // 3 + 1 AS width FROM (SELECT make_timestamp(ts * 1000000) AS timebin, *
        FROM (SELECT epoch(date_trunc('month', l_shipdate))::BIGINT AS ts, l_suppkey AS originasn_id, l_partkey AS asn_id,
            l_discount AS hege, l_linenumber AS n FROM lineitem))),
    p AS (SELECT *, CASE WHEN n = 7 THEN 2 ELSE (ts - low) // width END AS part FROM r),
    s AS (SELECT part, max(max(timebin)) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest
        FROM p GROUP BY part),
    found AS (SELECT p.*, coalesce(timebin <= newest - INTERVAL 31 DAY, false) AS late FROM p JOIN s USING (part)) """


def _late(spark, sf):
    """Rows in order of time, but for those of line 7, which all come in the last part."""
    path = work_dir(spark, "late")
    rows = v.table(spark, sf, "lineitem").select(
        F.timestamp_seconds(v.month_s("l_shipdate")).alias("timebin"), F.col("l_suppkey").alias("originasn_id"),
        F.col("l_partkey").alias("asn_id"), F.col("l_discount").alias("hege"), F.col("l_linenumber").alias("n"))
    in_turn(spark, rows, F.unix_seconds("timebin"), lambda stream: bins.lateness_stream(stream, path, "31 days"),
            part=lambda at: F.when(F.col("n") == 7, 2).otherwise(at))
    return path, rows.schema


@query("late_rows", TURNS + "SELECT timebin, originasn_id, asn_id, hege, n, late FROM found")
def late_rows(spark, sf):
    path, schema = _late(spark, sf)
    on_time, late = (carried.result(spark, path, name, schema) for name in ("on_time", "late"))
    return on_time.withColumn("late", F.lit(False)).unionByName(late.withColumn("late", F.lit(True)))


@query("complete_bins", TURNS + """SELECT timebin, asn_id, count(*) AS n, sum(CASE WHEN originasn_id NOT IN (0, -1)
    AND asn_id <> originasn_id AND hege <> 0 THEN 1 ELSE 0 END)::BIGINT AS conesize FROM found
    WHERE NOT late AND timebin <= (SELECT max(timebin) FROM found) - INTERVAL 31 DAY GROUP BY timebin, asn_id""")
def complete_bins(spark, sf):
    """Cones of the closed bins, of what was on time."""
    path, schema = _late(spark, sf)
    rows = bins.complete(spark, path, schema, "31 days")
    cones = hegemony.cone(rows, 4).select("timebin", "asn_id", "conesize")
    return rows.groupBy("timebin", "asn_id").agg(F.count(F.lit(1)).alias("n")).join(cones, ["timebin", "asn_id"])


def _snapshot(spark, sf):
    path, told = work_dir(spark, "snapshot"), work_dir(spark, "told")
    rows = v.v_probe_archive(spark, sf)
    tell = lambda changed, batch: changed.write.mode("overwrite").parquet(f"{told}/batch={batch}")
    in_turn(spark, rows, F.col("offset"),
            lambda stream: snapshot.snapshot_stream(stream, path, "id", ("offset",), observers=[tell]))
    return path, told, rows.schema


@query("probe_snapshot_stream", SQL["probe_snapshot"])
def probe_snapshot_stream(spark, sf):
    path, _, schema = _snapshot(spark, sf)
    snapshot.tidy(spark, path, schema, "id")
    return flat_snapshot(snapshot.current(spark, path, schema, "id"))
