"""Score tables, dimensions and prefix lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import views as v
from checks.registry import query
from checks.sql_views import cc
from tidemark import functions as fn
from tidemark.functions import network
from tidemark.functions.identifiers import with_family
from tidemark.operators import dimensions, hegemony, prefixes
from tidemark.plans import scores
from tidemark.session import kept

FROM_S, TO_S = 852076800, 946684800  # 1997-01-01 and 2000-01-01
CONE = ("count(*) FILTER (originasn_id <> 0 AND originasn_id <> asn_id AND hege <> 0)")
PREFIX_VIEWS = ("v_prefix_rows v_pairs v_roa v_rpki v_irr v_irr_status v_geo v_prefix_cc v_delegated_prefix "
                "v_prefix_del v_delegated_asn v_asn_del v_moas v_peer_max")


@query("payload_range", f"SELECT ts AS \"timestamp\", scope, asn, hege FROM v_hege WHERE ts >= {FROM_S} AND ts < {TO_S}",
       "v_hege")
def payload_range(spark, sf):
    return hegemony.payload_range(v.v_hege(spark, sf), "timestamp", FROM_S, TO_S).drop("nb_peers")


@query("hegemony_rows", f"""SELECT timebin, originasn_id, asn_id, hege, 4 AS af FROM v_hege_rows
    WHERE hege <> 0 AND epoch(timebin) >= {FROM_S} AND epoch(timebin) < {TO_S}""", "v_hege v_hege_rows")
def hegemony_rows(spark, sf):
    return scores.as_hegemony(v.v_hege(spark, sf), 4, FROM_S, TO_S)[0]


@query("hegemony_cone", f"SELECT timebin, {CONE} AS conesize, 4 AS af, asn_id FROM v_hege_rows GROUP BY timebin, asn_id",
       "v_hege v_hege_rows")
def hegemony_cone(spark, sf):
    return scores.as_hegemony(v.v_hege(spark, sf), 4)[1]


@query("hegemony_cone_distinct", """SELECT timebin, count(DISTINCT originasn_id) AS conesize, 4 AS af, asn_id
    FROM v_hege_rows WHERE originasn_id <> 0 AND originasn_id <> asn_id AND hege <> 0 GROUP BY timebin, asn_id""",
       "v_hege v_hege_rows")
def hegemony_cone_distinct(spark, sf):
    return hegemony.cone(hegemony.score_rows(v.v_hege(spark, sf)), 4, distinct=True)


@query("asn_set_expand", """SELECT make_timestamp(ts * 1000000) AS timebin,
    CASE WHEN scope = '-1' THEN 0 ELSE scope::BIGINT END AS originasn_id, unnest(asns) AS asn_id, hege
    FROM v_hege_set""", "v_hege_set")
def asn_set_expand(spark, sf):
    return hegemony.score_rows(v.v_hege_set(spark, sf), "ts")


@query("bin_stats", """SELECT count(DISTINCT scope) AS nb_messages, count(DISTINCT scope) AS nb_scopes,
    count(DISTINCT asn) AS nb_asns, count(*) AS nb_pairs, count(*) FILTER (scope = -1) AS global_graph_size
    FROM v_messages WHERE bin = TIMESTAMP '1997-03-01'""", "v_messages")
def bin_stats(spark, sf):
    return hegemony.bin_stats(v.v_messages(spark, sf), "1997-03-01")


@query("bin_scopes_by_partition", """SELECT (((scope % 3) + 3) % 3)::INTEGER AS partition,
    count(DISTINCT scope) AS nb_scopes FROM v_messages WHERE bin = TIMESTAMP '1997-03-01' GROUP BY 1""", "v_messages")
def bin_scopes_by_partition(spark, sf):
    return hegemony.bin_scopes_by_partition(v.v_messages(spark, sf), "1997-03-01")


@query("asn_register", """SELECT number, coalesce(d.name, '') AS name, coalesce(d.tartiflette, false) AS tartiflette,
    coalesce(d.disco, false) AS disco, coalesce(d.ashash, false) OR s.number IS NOT NULL AS ashash
    FROM v_asn_dim d FULL JOIN (SELECT originasn_id AS number FROM v_hege_rows UNION SELECT asn_id FROM v_hege_rows) s
    USING (number)""", "v_asn_dim v_hege v_hege_rows")
def asn_register(spark, sf):
    rows = hegemony.score_rows(v.v_hege(spark, sf))
    return dimensions.register_asns(v.v_asn_dim(spark, sf), rows, ["originasn_id", "asn_id"])


@query("asn_register_prefix", """SELECT number, coalesce(d.name, '') AS name,
    coalesce(d.tartiflette, false) AS tartiflette, coalesce(d.disco, false) AS disco, coalesce(d.ashash, false) AS ashash
    FROM v_asn_dim d FULL JOIN (SELECT originasn_id AS number FROM v_prefix_rows UNION SELECT asn_id FROM v_prefix_rows) s
    USING (number)""", "v_asn_dim v_prefix_rows")
def asn_register_prefix(spark, sf):
    rows = scores.prefix_rows(v.v_hege_prefix(spark, sf))
    return dimensions.register_asns(v.v_asn_dim(spark, sf), rows, ["originasn_id", "asn_id"], ashash=False)


@query("hegemony_asns", """SELECT number, coalesce(d.name, '') AS name, coalesce(d.tartiflette, false) AS tartiflette,
    coalesce(d.disco, false) AS disco, coalesce(d.ashash, false) OR s.number IS NOT NULL AS ashash
    FROM v_asn_dim d FULL JOIN (SELECT originasn_id AS number FROM v_hege_rows
        UNION SELECT asn_id FROM v_hege_rows) s USING (number)""", "v_asn_dim v_hege v_hege_rows")
def hegemony_asns(spark, sf):
    """AS 77 has only zero scores."""
    return scores.as_numbers(v.v_hege(spark, sf), v.v_asn_dim(spark, sf))


@query("prefix_asns", """SELECT number, coalesce(d.name, '') AS name, coalesce(d.tartiflette, false) AS tartiflette,
    coalesce(d.disco, false) AS disco, coalesce(d.ashash, false) AS ashash
    FROM v_asn_dim d FULL JOIN (SELECT originasn_id AS number FROM v_prefix_rows
        UNION SELECT asn_id FROM v_prefix_rows) s USING (number)""", "v_asn_dim v_prefix_rows")
def prefix_asns(spark, sf):
    return scores.prefix_numbers(v.v_hege_prefix(spark, sf), v.v_asn_dim(spark, sf))


def countries_sql(codes: str, special: str) -> str:
    return f"""SELECT {cc('n_nationkey')} AS code, n_name AS name, false AS tartiflette, false AS disco,
        true AS known FROM nation WHERE n_nationkey BETWEEN 5 AND 9
    UNION ALL SELECT cc, CASE cc {special} ELSE coalesce(n_name, cc) END, false, false,
        n_name IS NOT NULL OR cc IN ('EU', 'AP', 'ZZ')
    FROM (SELECT DISTINCT country_id AS cc FROM ({codes})) LEFT JOIN (SELECT {cc('n_nationkey')} AS code, n_name
        FROM nation WHERE n_nationkey < 20) ON cc = code
    WHERE cc NOT IN (SELECT {cc('n_nationkey')} FROM nation WHERE n_nationkey BETWEEN 5 AND 9)"""


REGIONS = "WHEN 'EU' THEN 'European Union' WHEN 'AP' THEN 'Asia-Pacific'"


@query("prefix_countries", countries_sql("SELECT country_id FROM v_prefix_rows JOIN v_prefix_cc USING (prefix) WHERE hege <> 0",
                                         f"{REGIONS} WHEN 'ZZ' THEN 'Unknown'"), PREFIX_VIEWS)
def prefix_countries(spark, sf):
    rows = scores.prefix_codes(v.v_hege_prefix(spark, sf), 4, v.v_geo(spark, sf))
    return scores.prefix_countries(rows, v.v_country_dim(spark, sf), v.v_country_names(spark, sf))


@query("country_dim", countries_sql("SELECT cc AS country_id FROM v_country", REGIONS), "v_country")
def country_dim(spark, sf):
    """One country has only zero scores."""
    return scores.countries(v.v_hege_country(spark, sf), v.v_country_dim(spark, sf), v.v_country_names(spark, sf))


@query("country_register", f"""SELECT {cc('n_nationkey')} AS code, n_name AS name, false AS tartiflette, false AS disco,
        true AS known FROM nation WHERE n_nationkey BETWEEN 5 AND 9
    UNION ALL SELECT cc, CASE cc WHEN 'EU' THEN 'European Union' WHEN 'AP' THEN 'Asia-Pacific' ELSE
        coalesce(n_name, cc) END, false, false, n_name IS NOT NULL
    FROM (SELECT DISTINCT cc FROM v_country) LEFT JOIN (SELECT {cc('n_nationkey')} AS code, n_name FROM nation
        WHERE n_nationkey < 20) ON cc = code
    WHERE cc NOT IN (SELECT {cc('n_nationkey')} FROM nation WHERE n_nationkey BETWEEN 5 AND 9)""", "v_country")
def country_register(spark, sf):
    codes = v.v_hege_country(spark, sf).select(F.col("cc").alias("code"))
    return dimensions.register_countries(v.v_country_dim(spark, sf), codes, v.v_country_names(spark, sf))


COUNTRY_SCORES = """SELECT timebin, cc AS country_id, asn AS asn_id, hege, 4 AS af,
    original_weight AS weight, lower(weight) AS weightscheme, transit_only AS transitonly FROM {}
    WHERE hege <> 0"""


@query("country_hegemony", COUNTRY_SCORES.format("v_country_scores"), "v_country_scores")
def country_hegemony(spark, sf):
    """Scores of all countries."""
    return scores.country_hegemony(v.v_hege_country(spark, sf, only_zero=None), 4)


@query("dim_register", f"""SELECT (SELECT max(number) FROM v_asn_dim) + row_number() OVER
        (ORDER BY substr(md5(k::VARCHAR), 1, 3), k) AS id, k AS number
    FROM (SELECT DISTINCT o_custkey AS k FROM orders) WHERE k NOT IN (SELECT number FROM v_asn_dim)
    UNION ALL SELECT number, number FROM v_asn_dim""", "v_asn_dim")
def dim_register(spark, sf):
    dim = v.v_asn_dim(spark, sf).select(F.col("number").alias("id"), "number")
    keys = v.table(spark, sf, "orders").select(F.col("o_custkey").alias("number"))
    return dimensions.register(dim, keys, ["number"])


@query("location_register", "SELECT id, type, name, af FROM v_delay_dim",
       "v_location_dim v_delay v_delay_seen v_delay_dim")
def location_register(spark, sf):
    keys = scores.endpoint_texts(v.v_delay(spark, sf), ["startpoint", "endpoint"], fn.parse_location)
    return dimensions.register(v.v_location_dim(spark, sf), keys, ["type", "name", "af"])


@query("delay_rows", """SELECT make_timestamp(ts * 1000000) AS timebin, a.id AS startpoint_id, b.id AS endpoint_id,
    median, nbtracks, nbprobes, entropy, hop, nbrealrtts FROM v_delay
    JOIN v_delay_dim a ON startpoint = a.type || a.name || 'v' || a.af
    JOIN v_delay_dim b ON endpoint = b.type || b.name || 'v' || b.af""",
       "v_location_dim v_delay v_delay_seen v_delay_dim")
def delay_rows(spark, sf):
    return scores.network_delay(v.v_delay(spark, sf), v.v_location_dim(spark, sf))[0]


@query("tr_hegemony", """SELECT timebin, a.id AS origin_id, b.id AS dependency_id, hege, 4 AS af, nbsamples
    FROM v_tr_rows JOIN v_tr_dim a ON origin = a.type || ':' || a.name
    JOIN v_tr_dim b ON dependency = b.type || ':' || b.name""", "v_location_dim v_tr v_tr_rows v_tr_seen v_tr_dim")
def tr_hegemony(spark, sf):
    return scores.tr_hegemony(v.v_tr(spark, sf), 4, v.v_location_dim(spark, sf))[0]


@query("lpm_country", """SELECT ip, coalesce(cc, 'ZZ') AS cc FROM v_addresses
    LEFT JOIN v_geo g ON addr - addr % (1::BIGINT << (32 - g.len)) = g.net
    QUALIFY row_number() OVER (PARTITION BY ip ORDER BY g.len DESC NULLS LAST) = 1""", "v_addresses v_geo")
def lpm_country(spark, sf):
    ips = v.v_addresses(spark, sf).distinct()
    return prefixes.longest_prefix(ips, "ip", v.v_geo(spark, sf), "cc")


@query("lpm_country_v6", """SELECT o_orderkey, coalesce(cc, 'ZZ') AS cc FROM (
        SELECT o_orderkey, o_custkey % 4096 AS third FROM orders)
    LEFT JOIN (SELECT ((p_partkey % 4096) >> (12 - p_size % 13)) << (12 - p_size % 13) AS third_net,
        12 - p_size % 13 AS free, p_size % 13 + 36 AS len, chr((65 + p_size % 26)::INT) || 'Y' AS cc, p_partkey
        FROM part QUALIFY row_number() OVER (PARTITION BY third_net, len ORDER BY p_partkey) = 1)
    ON (third >> free) << free = third_net
    QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY len DESC NULLS LAST) = 1""")
def lpm_country_v6(spark, sf):
    """Networks 2001:db8:n::/36 to /48, so that only the low 12 bits of n can differ."""
    geo = prefixes.prefix_table(v.v_geo6(spark, sf), "prefix", 6).groupBy("net", "len").agg(
        F.min_by("cc", "p_partkey").alias("cc"))
    return prefixes.longest_prefix(v.v_addresses6(spark, sf), "ip", geo, "cc", af=6).select("o_orderkey", "cc")


@query("ip_to_long", "SELECT ip, addr AS number, ip AS back FROM v_addresses", "v_addresses")
def ip_to_long(spark, sf):
    number = network.ip_to_long(F.col("ip"))
    return v.v_addresses(spark, sf).distinct().select("ip", number.alias("number"), network.long_to_ip(number).alias("back"))


@query("rov_status", """SELECT prefix, originasn_id, rpki_status, irr_status, descr
    FROM v_rpki JOIN v_irr_status USING (prefix, originasn_id)""",
       "v_prefix_rows v_pairs v_roa v_rpki v_irr v_irr_status")
def rov_status(spark, sf):
    pairs = kept(scores.prefix_rows(v.v_hege_prefix(spark, sf)).select("prefix", "originasn_id").distinct())
    checked = prefixes.with_status(pairs, *prefixes.origin_facts(pairs, v.v_roa(spark, sf)), "rpki_status")
    facts = prefixes.origin_facts(pairs, v.v_irr(spark, sf), ["descr"])
    return prefixes.with_status(checked, *facts, "irr_status", ["descr"])


@query("delegated_status", """SELECT prefix, originasn_id, delegated_prefix_status, delegated_asn_status
    FROM v_pairs JOIN v_prefix_del USING (prefix) JOIN v_asn_del USING (originasn_id)""",
       "v_prefix_rows v_pairs v_delegated_prefix v_prefix_del v_delegated_asn v_asn_del")
def delegated_status(spark, sf):
    pairs = scores.prefix_rows(v.v_hege_prefix(spark, sf)).select("prefix", "originasn_id").distinct()
    return prefixes.delegated(pairs, v.v_delegated_prefix(spark, sf), v.v_delegated_asn(spark, sf))


@query("moas", "SELECT timebin, prefix, moas FROM v_moas", "v_prefix_rows v_moas")
def moas(spark, sf):
    return hegemony.moas(scores.prefix_rows(v.v_hege_prefix(spark, sf)))


@query("peer_max", "SELECT timebin, peer_max FROM v_peer_max", "v_prefix_rows v_peer_max")
def peer_max(spark, sf):
    return hegemony.peer_max(scores.prefix_rows(v.v_hege_prefix(spark, sf)))


@query("prefix_hegemony", """SELECT timebin, prefix, originasn_id, asn_id, country_id, hege, rpki_status, irr_status,
    delegated_prefix_status, delegated_asn_status, 4 AS af, descr, round(100.0 * nb_peers / peer_max, 6) AS visibility,
    moas FROM v_prefix_rows JOIN v_rpki USING (prefix, originasn_id) JOIN v_irr_status USING (prefix, originasn_id)
    JOIN v_prefix_cc USING (prefix) JOIN v_prefix_del USING (prefix) JOIN v_asn_del USING (originasn_id)
    JOIN v_moas USING (timebin, prefix) JOIN v_peer_max USING (timebin) WHERE hege <> 0""", PREFIX_VIEWS)
def prefix_hegemony(spark, sf):
    out = scores.prefix_hegemony(
        v.v_hege_prefix(spark, sf), 4, v.v_geo(spark, sf), v.v_roa(spark, sf), v.v_irr(spark, sf),
        v.v_delegated_prefix(spark, sf), v.v_delegated_asn(spark, sf))
    return out.withColumn("visibility", F.round("visibility", 6))


@query("location_lookup", """SELECT startpoint, coalesce(d.id, -1) AS location_id, count(*) AS n
    FROM v_delay LEFT JOIN v_location_dim d ON startpoint = d.type || d.name || 'v' || d.af GROUP BY ALL""",
       "v_delay v_location_dim")
def location_lookup(spark, sf):
    found = dimensions.lookup_location(v.v_delay(spark, sf), "startpoint", v.v_location_dim(spark, sf), "location_id")
    return found.groupBy(
        with_family(F.col("startpoint")).alias("startpoint"), F.coalesce("location_id", F.lit(-1)).alias("location_id")
    ).agg(F.count(F.lit(1)).alias("n"))
