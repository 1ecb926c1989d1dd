"""Detector, routing records, exchange points, outages, planning and scalar functions."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from checks import views as v
from checks.registry import query
from checks.sql_views import tagged
from tidemark import functions as fn
from tidemark.operators import bgp, detector, exchange, hegemony, mapping, outages, planning, probes
from tidemark.plans import mapped_tables

SPEC = detector.DetectorSpec(key=("user_id",), value="value", threshold=3.0, min_dev=0.01, granularity_min=480.0)
SPEC_MEDIAN = detector.DetectorSpec(
    key=("user_id",), value="value", threshold=3.0, min_dev=0.01, granularity_min=480.0, dev_metric="median")
HISTORY = "v_series v_scored v_stats v_dev"
FROM = "2024-01-20 00:00:00"


def anomaly_sql(dev: str, where: str = "true") -> str:
    score = f"(value - med) / (1.4826 * (0.01 + {dev}))"
    return (f'SELECT "timestamp", event_id, user_id, value, round({score}, 6) AS deviation FROM v_dev '
            f"WHERE abs({score}) > 3 AND {where}")


def flat_anomalies(df):
    return df.select("timestamp", "datapoint.event_id", "datapoint.user_id", "datapoint.value",
                     F.round("deviation", 6).alias("deviation"))


@query("rolling_mad", """SELECT event_id, n AS hist_n, round(med, 6) AS hist_median, round(mad, 6) AS hist_mad,
    round(mean_dev, 6) AS hist_mean_dev FROM v_dev""", HISTORY)
def rolling_mad(spark, sf):
    stats = detector.rolling_mad(v.v_series(spark, sf), SPEC)
    return stats.select("event_id", "hist_n", *[
        F.round(c, 6).alias(c) for c in ("hist_median", "hist_mad", "hist_mean_dev")])


@query("rolling_mad_dense", """SELECT event_id, len(h)::INTEGER AS hist_n, round(med, 6) AS hist_median,
    round(list_aggregate(list_transform(h, lambda x: abs(x - med)), 'median'), 6) AS hist_mad,
    round(list_aggregate(list_transform(h, lambda x: abs(x - med)), 'avg'), 6) AS hist_mean_dev
    FROM (SELECT *, list_aggregate(h, 'median') AS med FROM (SELECT *, list(value) OVER (PARTITION BY event_type
        ORDER BY epoch_us(ts) RANGE BETWEEN 259200000000 PRECEDING AND 1 PRECEDING) AS h FROM events))
    WHERE len(h) > 5.4""")
def rolling_mad_dense(spark, sf):
    """Few keys with long histories, which the index answers."""
    series = v.table(spark, sf, "events").select("event_id", "event_type", "value", F.col("ts").alias("timestamp"))
    stats = detector.rolling_mad(series, replace(SPEC, key=("event_type",)), dense_rows=20)
    return stats.select("event_id", "hist_n", *[
        F.round(c, 6).alias(c) for c in ("hist_median", "hist_mad", "hist_mean_dev")])


@query("anomalies_mean", anomaly_sql("mean_dev"), HISTORY)
def anomalies_mean(spark, sf):
    return flat_anomalies(detector.anomalies(v.v_series(spark, sf), SPEC))


@query("anomalies_median", anomaly_sql("mad"), HISTORY)
def anomalies_median(spark, sf):
    return flat_anomalies(detector.anomalies(v.v_series(spark, sf), SPEC_MEDIAN))


@query("anomalies_from", anomaly_sql("mean_dev", f"\"timestamp\" >= TIMESTAMP '{FROM}'"), HISTORY)
def anomalies_from(spark, sf):
    return flat_anomalies(detector.anomalies(v.v_series(spark, sf), SPEC, start=FROM))


@query("bgp_elements", """SELECT CASE WHEN collector LIKE '%rrc%' THEN 'ris' ELSE 'routeviews' END AS project, collector,
    CASE record_type WHEN 'updates' THEN 'update' ELSE 'rib' END AS type, pos, time,
    CASE record_type WHEN 'ribs' THEN 'R' ELSE elem_type END AS elem_type, peer_asn, peer_address AS next_hop, as_path,
    coalesce(array_to_string(communities, ' '), '') AS communities, prefix FROM v_bgp""", "v_bgp")
def bgp_elements(spark, sf):
    e = bgp.bgp_elements(v.v_bgp(spark, sf))
    f = F.col("element.fields")
    return e.select("project", "collector", "type", "pos", "time", F.col("element.type").alias("elem_type"),
                    "element.peer_asn", f["next-hop"].alias("next_hop"), f["as-path"].alias("as_path"),
                    F.array_join(f["communities"], " ").alias("communities"), f["prefix"].alias("prefix"))


@query("bgp_batches", """SELECT collector, record_type, min(pos) AS pos, time, count(*)::INTEGER AS size,
    string_agg(prefix, ' ' ORDER BY pos) AS prefixes FROM v_chunk
    GROUP BY collector, record_type, time, run, chunk""", "v_bgp v_run v_chunk")
def bgp_batches(spark, sf):
    return flat_batches(bgp.batch_records(bgp.bgp_elements(v.v_bgp(spark, sf))))


def flat_batches(b):
    return b.select("rec.collector", "record_type", "pos", "rec.time", F.size("elements").alias("size"),
                    F.array_join(F.transform("elements", lambda e: e["fields"]["prefix"]), " ").alias("prefixes"))


@query("bgp_records", """SELECT collector, hour AS time, hour - hour % 7200 AS dump_time, status,
    CASE WHEN hour % 7200 = 0 THEN 'start' ELSE 'middle' END AS dump_position, count(*)::INTEGER AS size,
    string_agg(prefix, ' ' ORDER BY pos) AS prefixes FROM v_bgp GROUP BY collector, record_type, hour, status""", "v_bgp")
def bgp_records(spark, sf):
    hour = F.col("time")
    raw = v.v_bgp(spark, sf, "hour").withColumn("dump_time", hour - hour % 7200).withColumn(
        "dump_position", F.when(hour % 7200 == 0, "start").otherwise("middle"))
    record = ("project", "collector", "type", "dump_time", "time", "status", "dump_position")
    r = bgp.bgp_records(bgp.bgp_elements(raw), record)
    return r.select("rec.collector", "rec.time", "rec.dump_time", "rec.status", "rec.dump_position",
                    F.size("elements").alias("size"),
                    F.array_join(F.transform("elements", lambda x: x["fields"]["prefix"]), " ").alias("prefixes"))


@query("bgp_flatten", """SELECT collector, time, peer_asn, prefix FROM v_bgp""", "v_bgp")
def bgp_flatten(spark, sf):
    b = bgp.flatten_records(bgp.batch_records(bgp.bgp_elements(v.v_bgp(spark, sf))))
    return b.select("rec.collector", "element.time", "element.peer_asn", "element.fields.prefix")


@query("bgp_topic_counts", """SELECT 'bgp_' || collector || '_' || record_type AS topic, count(*) AS n FROM v_bgp
    GROUP BY 1""", "v_bgp")
def bgp_topic_counts(spark, sf):
    return bgp.route_topic(v.v_bgp(spark, sf)).groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


@query("valid_records", "SELECT pos, status, status = 'valid' AS kept FROM v_bgp", "v_bgp")
def valid_records(spark, sf):
    good, bad = bgp.valid_records(v.v_bgp(spark, sf))
    return good.select("pos", "status", F.lit(True).alias("kept")).unionByName(
        bad.select("pos", "status", F.lit(False).alias("kept")))


@query("nonempty_records", """SELECT collector, hour AS time, count(*)::INTEGER AS size FROM v_bgp
    GROUP BY collector, hour HAVING count(*) FILTER (elem_type = 'W') > 0""", "v_bgp")
def nonempty_records(spark, sf):
    """Records of the withdrawals of an hour; hours without any are empty records."""
    rows = v.v_bgp(spark, sf, "hour")
    r = rows.groupBy("collector", "time").agg(
        F.count(F.lit(1)).cast("int").alias("size"),
        F.collect_list(F.when(F.col("elem_type") == "W", F.col("pos"))).alias("elements"))
    return bgp.nonempty(r).select("collector", "time", "size")


@query("dedup_first", """SELECT user_id AS id, event_id AS pos, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1""")
def dedup_first(spark, sf):
    e = v.table(spark, sf, "events").select(F.col("user_id").alias("id"), F.col("event_id").alias("pos"),
                                            "event_type", "value")
    return exchange.keep_first(e, "id", "pos")


@query("netixlan_project", """SELECT c_nationkey AS ix_id, c_name AS name, c_custkey AS netixlan_id, c_custkey % 64 AS asn,
    CASE WHEN c_custkey % 3 <> 0 THEN '10.1.0.' || c_custkey % 256 END AS ipaddr4,
    CASE WHEN c_custkey % 4 <> 0 THEN '2001:db8::' || lower(to_hex(c_custkey)) END AS ipaddr6 FROM customer""")
def netixlan_project(spark, sf):
    return exchange.netixlan_project(v.v_netixlan(spark, sf))


@query("ix_enrich", """SELECT ix.id AS ix_id, name, name_long, country, ixlan_id, p.id AS ixpfx_id, protocol, prefix
    FROM v_ixpfx p JOIN v_ixlan l ON ixlan_id = l.id JOIN v_ix ix ON l.ix_id = ix.id WHERE protocol IN ('IPv4', 'IPv6')""",
       "v_ix v_ixlan v_ixpfx")
def ix_enrich(spark, sf):
    return exchange.ix_enrich(v.v_ix(spark, sf), v.v_ixlan(spark, sf), v.v_ixpfx(spark, sf))[0]


@query("ix_rejects", """SELECT p.id AS ixpfx_id, ixlan_id, protocol, prefix,
    CASE WHEN protocol NOT IN ('IPv4', 'IPv6') THEN 'protocol' WHEN l.id IS NULL THEN 'ixlan' ELSE 'ix' END AS reason
    FROM v_ixpfx p LEFT JOIN v_ixlan l ON ixlan_id = l.id LEFT JOIN v_ix ix ON l.ix_id = ix.id
    WHERE protocol NOT IN ('IPv4', 'IPv6') OR l.id IS NULL OR ix.id IS NULL""", "v_ix v_ixlan v_ixpfx")
def ix_rejects(spark, sf):
    return exchange.ix_enrich(v.v_ix(spark, sf), v.v_ixlan(spark, sf), v.v_ixpfx(spark, sf))[1]


@query("disco_bursts", """SELECT streamtype, streamname, starttime, starttime AS endtime, avglevel, totalprobes,
    nbdiscoprobes, true AS ongoing FROM v_burst""", "v_order_probes v_burst")
def disco_bursts(spark, sf):
    return outages.burst_events(v.v_burst(spark, sf))


@query("disco_events", """SELECT streamtype, streamname, starttime, coalesce(last_end, starttime) AS endtime, avglevel,
    totalprobes, nbdiscoprobes, last_end IS NULL AS ongoing FROM v_burst LEFT JOIN v_ends USING (o_orderkey)
    WHERE NOT coalesce(short, false)""", "v_order_probes v_burst v_reconnect v_ends")
def disco_events(spark, sf):
    return outages.outage_events(v.v_burst(spark, sf), v.v_reconnect(spark, sf))


@query("disco_probes", """SELECT streamtype, streamname, b.starttime AS event_starttime, l_suppkey AS probe_id,
    make_timestamp(shipped * 1000000) AS starttime,
    CASE WHEN last_end IS NOT NULL AND l_suppkey % 2 = 0 THEN last_end + to_seconds(l_suppkey)
         ELSE make_timestamp(shipped * 1000000) END AS endtime,
    avglevel AS level, ipv4, prefixv4, lat, lon
    FROM v_burst b JOIN v_order_probes ON o_orderkey = l_orderkey JOIN v_probe ON id = l_suppkey
    LEFT JOIN v_ends USING (o_orderkey) WHERE NOT coalesce(short, false)""",
       "v_order_probes v_burst v_reconnect v_ends v_probe")
def disco_probes(spark, sf):
    known = probes.probe_defaults(v.v_probe(spark, sf))
    return outages.outage_probes(v.v_burst(spark, sf), v.v_reconnect(spark, sf), known)


@query("disco_unmatched", """SELECT streamtype, streamname, starttime, endtime, "offset" FROM v_reconnect
    WHERE lasted >= 300 AND o_orderkey NOT IN (SELECT o_orderkey FROM v_burst)""", "v_order_probes v_burst v_reconnect")
def disco_unmatched(spark, sf):
    return outages.unmatched_reconnects(v.v_burst(spark, sf), v.v_reconnect(spark, sf))


ASN_OK = "asn IS NOT NULL AND asn NOT LIKE 'AS%'"


@query("mapped_sink", f"""SELECT make_timestamp(ts * 1000000) AS timebin, deviation, af::BIGINT AS af,
    asn::BIGINT AS asn_id, scope AS originasn_id FROM v_alarms WHERE {ASN_OK}""", "v_alarms")
def mapped_sink(spark, sf):
    return mapping.map_rows(v.v_alarms(spark, sf), mapped_tables.score_alarms(4))[0]


@query("mapped_sink_rejects", f"""SELECT l_orderkey, deviation, CASE WHEN asn IS NULL THEN 'missing asn' ELSE 'bad asn' END
    AS reason FROM v_alarms WHERE NOT ({ASN_OK})""", "v_alarms")
def mapped_sink_rejects(spark, sf):
    return mapping.map_rows(v.v_alarms(spark, sf), mapped_tables.score_alarms(4))[1].select(
        "l_orderkey", "deviation", "reason")


@query("mapped_sink_locations", """SELECT make_timestamp(ts * 1000000) AS timebin, median / 1000 AS deviation,
    a.id AS startpoint_id, b.id AS endpoint_id FROM v_delay
    JOIN v_location_dim a ON startpoint = a.type || a.name || 'v' || a.af
    JOIN v_location_dim b ON endpoint = b.type || b.name || 'v' || b.af
    UNION ALL SELECT make_timestamp(ts * 1000000), median / 1000, a.id, e.id FROM v_delay
    JOIN v_location_dim a ON startpoint = a.type || a.name || 'v' || a.af
    JOIN (SELECT DISTINCT 100000 + (l_partkey % 50) AS id, 'CT' || l_partkey % 50 || ', FRv4' AS loc FROM lineitem) e
    ON endpoint = e.loc""", "v_delay v_location_dim")
def mapped_sink_locations(spark, sf):
    towns = v.table(spark, sf, "lineitem").select((F.col("l_partkey") % 50).alias("k")).distinct().select(
        (F.lit(100000) + F.col("k")).alias("id"), F.lit("CT").alias("type"),
        F.concat(F.col("k").cast("string"), F.lit(", FR")).alias("name"), F.lit(4).alias("af"))
    known = v.v_location_dim(spark, sf).unionByName(towns)
    return mapping.map_rows(v.v_delay_alarms(spark, sf), mapped_tables.delay_alarms(), known)[0]


@query("mapped_ranks", """SELECT make_timestamp(epoch(date_trunc('month', o_orderdate))::BIGINT * 1000000) AS timebin,
    'rtt' AS metric, o_custkey AS rank, 6::BIGINT AS af, o_totalprice AS mean, o_orderkey % 300 AS asn_id,
    o_orderkey % 50 AS nbsamples FROM orders WHERE o_orderkey % 6 <> 0""")
def mapped_ranks(spark, sf):
    return mapping.map_rows(v.v_ranks(spark, sf), mapped_tables.rank_deployment(6, "rtt"))[0]


@query("measurement_select", """SELECT id FROM v_measurements WHERE "interval" <= 3600 AND start_time <= 1700150000
    AND NOT ping AND af = 4 AND status = 2 AND first_hop = 1 AND (crowd IS NULL OR crowd > 100)""", "v_measurements")
def measurement_select(spark, sf):
    return planning.select_measurements(v.v_measurements(spark, sf), F.lit(1_700_150_000))


@query("cutoff_filter", """SELECT event_id, ts FROM events WHERE ts < TIMESTAMP '2024-01-15 06:00:00'""")
def cutoff_filter(spark, sf):
    end = F.lit("2024-01-15 06:00:00").cast("timestamp")
    return planning.cutoff(v.table(spark, sf, "events").select("event_id", "ts"), "ts", end)


@query("chunk_plan", """SELECT s_suppkey AS id, c AS chunk_start, c + 300 AS chunk_stop FROM supplier,
    unnest(generate_series(1704067200 + s_suppkey * 60, 1704070800 + s_suppkey * 100 - 1, 300)) t(c)""")
def chunk_plan(spark, sf):
    ids = v.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"))
    start, stop = F.lit(1_704_067_200) + F.col("id") * 60, F.lit(1_704_070_800) + F.col("id") * 100
    return planning.chunk_plan(ids, start, stop, 300)


@query("id_groups", """SELECT o_orderkey AS id, ((row_number() OVER (ORDER BY o_orderkey) - 1)
    // greatest(1, (SELECT count(*) FROM orders) // 8))::INTEGER AS worker FROM orders""")
def id_groups(spark, sf):
    return planning.id_groups(v.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id")), width=1000)


@query("default_windows", """SELECT event_id, CASE event_id % 4
      WHEN 0 THEN date_trunc('minute', ts) - INTERVAL 10 MINUTE
      WHEN 1 THEN time_bucket(INTERVAL 15 MINUTE, ts) - INTERVAL 30 MINUTE
      WHEN 2 THEN ts - CASE WHEN event_type = 'view' THEN INTERVAL 480 MINUTE ELSE INTERVAL 120 MINUTE END
      ELSE date_trunc('day', ts) END AS window_start,
    CASE event_id % 4 WHEN 0 THEN date_trunc('minute', ts) - INTERVAL 5 MINUTE
      WHEN 1 THEN time_bucket(INTERVAL 15 MINUTE, ts) - INTERVAL 15 MINUTE
      WHEN 2 THEN ts ELSE date_trunc('day', ts) + INTERVAL 1 DAY END AS window_end FROM events""")
def default_windows(spark, sf):
    k = F.col("event_id") % 4
    e = v.table(spark, sf, "events").select(
        "event_id", F.when(k == 0, "atlas").when(k == 1, "updates").when(k == 2, "ribs").otherwise("table").alias("kind"),
        F.when(F.col("event_type") == "view", "rrc04").otherwise("route-views2").alias("collector"),
        F.col("ts").alias("now"))
    return planning.default_windows(e).select("event_id", "window_start", "window_end")


EXPECTED = "(VALUES ('click'), ('view'), ('error'), ('signup'), ('purchase'), ('never'), ('skipped')) t(topic)"
FRESH = f"""fresh AS (SELECT topic, latest, max(latest) OVER () AS newest,
    topic <> 'skipped' AND (latest IS NULL OR epoch_us(max(latest) OVER ()) - epoch_us(latest) > 600000000) AS stale
    FROM {EXPECTED} LEFT JOIN (SELECT event_type AS topic, max(ts) AS latest FROM events GROUP BY 1) USING (topic))"""


def _fresh(spark, sf):
    log = v.table(spark, sf, "events").select(F.col("event_type").alias("topic"), F.col("ts").alias("timestamp"))
    names = ["click", "view", "error", "signup", "purchase", "never", "skipped"]
    expected = spark.createDataFrame([(n,) for n in names], "topic string")
    return planning.freshness(log, expected, ignore=["skipped"], max_lag_s=600)


@query("freshness", f"WITH {FRESH} SELECT topic, latest, newest, stale FROM fresh")
def freshness(spark, sf):
    return _fresh(spark, sf).select("topic", "latest", "newest", "stale")


@query("refetch_plan", f"""WITH {FRESH} SELECT topic, newest - INTERVAL 1 HOUR AS fetch_start,
    newest + INTERVAL 1 HOUR AS fetch_end FROM fresh WHERE stale""")
def refetch_plan(spark, sf):
    return planning.refetch_plan(_fresh(spark, sf))


@query("parse_ts_arg", """SELECT event_id, CASE event_id % 5 WHEN 0 THEN epoch(date_trunc('second', ts))::BIGINT * 1000
    WHEN 1 THEN epoch_us(ts) // 1000 WHEN 2 THEN epoch_ms(date_trunc('minute', ts)) ELSE -1 END AS ms FROM events""")
def parse_ts_arg(spark, sf):
    k = F.col("event_id") % 5
    text = (
        F.when(k == 0, F.unix_seconds("ts").cast("string")).when(k == 1, F.unix_millis("ts").cast("string"))
        .when(k == 2, fn.file_stamp(F.col("ts"))).when(k == 3, F.col("event_id").cast("string")).otherwise("soon"))
    return v.table(spark, sf, "events").select(
        "event_id", F.coalesce(fn.parse_ts(text), F.lit(-1)).alias("ms"))


@query("valid_asn", """SELECT text, TRY_CAST(trim(text) AS BIGINT) IS NOT NULL AS valid, count(*) AS n FROM v_texts
    GROUP BY ALL""", "v_texts")
def valid_asn(spark, sf):
    return v.v_texts(spark, sf).groupBy("text", fn.valid_asn(F.col("text")).alias("valid")).agg(
        F.count(F.lit(1)).alias("n"))


@query("tr_identifier", f"""SELECT scope, count(*) AS n, split_part(any_value({tagged('scope')}), ':', 1) AS type,
    substr(any_value({tagged('scope')}), 4) AS name FROM v_tr GROUP BY scope""", "v_tr")
def tr_identifier(spark, sf):
    grouped = v.v_tr(spark, sf).groupBy("scope").agg(F.count(F.lit(1)).alias("n"))
    k = fn.tr_identifier(F.col("scope"), 4)
    return grouped.select("scope", "n", k["type"].alias("type"), k["name"].alias("name"))


@query("parse_location", """SELECT type, name, af, count(*) AS n FROM (SELECT substr(endpoint, 1, 2) AS type,
    substr(endpoint, 3, len(endpoint) - 4) AS name, right(endpoint, 1)::INTEGER AS af FROM v_delay) GROUP BY ALL""",
       "v_delay")
def parse_location(spark, sf):
    return v.v_delay(spark, sf).select(fn.parse_location(F.col("endpoint")).alias("k")).groupBy(
        F.col("k.type"), F.col("k.name"), F.col("k.af")).agg(F.count(F.lit(1)).alias("n"))


@query("epoch_convert", """SELECT event_id, trunc(value * 1000)::BIGINT AS ms,
    make_timestamp(epoch(date_trunc('second', ts))::BIGINT * 1000000) AS at FROM events""")
def epoch_convert(spark, sf):
    return v.table(spark, sf, "events").select(
        "event_id", fn.epoch_ms(F.col("value")).alias("ms"), fn.from_epoch_s(fn.epoch_s(F.col("ts"))).alias("at"))


@query("encode_key", "SELECT o_orderkey, printf('%016X', o_orderkey * 1000003) AS key FROM orders")
def encode_key(spark, sf):
    return v.table(spark, sf, "orders").select(
        "o_orderkey", F.hex(fn.encode_key(F.col("o_orderkey") * 1000003)).alias("key"))
