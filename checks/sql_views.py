"""The views of ``views`` as SQL text, joined into a WITH clause by ``with_views``."""

from __future__ import annotations

ONLY_ZERO = ("CASE WHEN l_partkey % 100 = 77 OR l_suppkey BETWEEN 76 AND 78 THEN 0::DOUBLE ELSE l_discount END AS hege")
PREFIX = "'10.' || ({c} // 256) % 256 || '.' || {c} % 256 || '.0/24'"


def month(c: str) -> str:
    return f"epoch(date_trunc('month', {c}))::BIGINT"


def cc(c: str) -> str:
    return f"CASE {c} WHEN 0 THEN 'EU' WHEN 1 THEN 'AP' ELSE chr((65 + {c} // 5)::INT) || chr((65 + {c} % 5)::INT) END"


def identifier(kind: str, a: str, b: str) -> str:
    return (f"CASE {kind} WHEN 1 THEN 'as|' || {a} WHEN 2 THEN 'ip|10.0.0.' || {a} WHEN 3 THEN 'ix|' || {a} "
            f"WHEN 4 THEN 'ix|' || {a} || ';as|' || {b} WHEN 5 THEN 'ix|' || {a} || ';as|0' "
            f"WHEN 6 THEN 'zz|' || {a} ELSE 'as|sa' || {a} END")


def tagged(text: str) -> str:
    """``TYPE:name`` of a tagged identifier, or null."""
    return (f"CASE WHEN {text} LIKE 'as|%' THEN 'AS:' || ltrim({text}, 'as|') "
            f"WHEN {text} LIKE 'ip|%' THEN 'IP:' || ltrim({text}, 'ip|') "
            f"WHEN {text} NOT LIKE 'ix|%' THEN NULL "
            f"WHEN {text} NOT LIKE '%;%' THEN 'IX:' || ltrim({text}, 'ix|') "
            f"WHEN split_part({text}, ';', 2) = 'as|0' THEN NULL "
            f"ELSE 'MB:' || ltrim(split_part({text}, ';', 1), 'ix|') || ';' || ltrim(split_part({text}, ';', 2), 'as|') END")


def registered(seen: str) -> str:
    """The location dimension with the keys of ``seen`` it lacked, numbered by hash bucket and key."""
    order = "substr(md5(concat_ws('|', type, name, af)), 1, 3), type, name, af"
    return f"""SELECT id, type, name, af FROM v_location_dim UNION ALL
        SELECT (SELECT max(id) FROM v_location_dim) + row_number() OVER (ORDER BY {order}), type, name, af
        FROM {seen} s ANTI JOIN v_location_dim USING (type, name, af)"""


def net(scale: int, length: str) -> str:
    addr = f"(167772160 + (p_partkey * {scale} % 65536) * 256)"
    return f"({addr} - {addr} % (1::BIGINT << (32 - {length})))"


VIEWS = {
    "v_log": """SELECT event_type AS topic, (user_id % 3)::INTEGER AS partition,
        row_number() OVER (PARTITION BY event_type, user_id % 3 ORDER BY ts, event_id) - 1 AS "offset",
        printf('%016X', user_id) AS key, event_id, user_id, value, props,
        CASE WHEN event_id % 5 <> 0 THEN user_id % 7 END AS tag, ts AS "timestamp" FROM events""",
    "v_series": 'SELECT event_id, user_id, value, ts AS "timestamp", epoch_us(ts) AS us FROM events',
    "v_scored": """SELECT *, 
        list(value) OVER (PARTITION BY user_id ORDER BY us RANGE BETWEEN 259200000000 PRECEDING AND 1 PRECEDING) AS h
        FROM v_series""",
    "v_stats": """SELECT *, len(h)::INTEGER AS n, list_aggregate(h, 'median') AS med,
        list_transform(h, lambda x: abs(x - list_aggregate(h, 'median'))) AS d FROM v_scored WHERE len(h) > 5.4""",
    "v_dev": """SELECT *, list_aggregate(d, 'median') AS mad, list_aggregate(d, 'avg') AS mean_dev FROM v_stats""",
    "v_hege": f"""SELECT {month('l_shipdate')} AS ts, (l_suppkey - 1)::VARCHAR AS scope,
        (l_partkey % 100)::VARCHAR AS asn, {ONLY_ZERO}, l_quantity::INTEGER AS nb_peers FROM lineitem""",
    "v_hege_rows": """SELECT make_timestamp(ts * 1000000) AS timebin,
        CASE WHEN scope = '-1' THEN 0 ELSE scope::BIGINT END AS originasn_id, asn::BIGINT AS asn_id, hege, nb_peers
        FROM v_hege""",
    "v_hege_set": f"""SELECT {month('l_shipdate')} AS ts, (l_suppkey - 1)::VARCHAR AS scope,
        CASE WHEN l_linenumber = 6 THEN [(l_partkey % 100), (l_partkey % 100 + 1)] ELSE [(l_partkey % 100)] END AS asns,
        l_discount AS hege FROM lineitem""",
    "v_prefix_rows": f"""SELECT make_timestamp({month('l_shipdate')} * 1000000) AS timebin,
        {PREFIX.format(c='l_partkey')} AS prefix, 167772160 + (l_partkey % 65536) * 256 AS net,
        unnest(CASE WHEN l_linenumber = 7 THEN [l_suppkey, l_suppkey + 1]
               WHEN l_suppkey = 0 THEN [0] ELSE [l_suppkey - 1] END) AS originasn_id,
        l_partkey % 100 AS asn_id, {ONLY_ZERO}, l_quantity::INTEGER AS nb_peers FROM lineitem""",
    "v_messages": """SELECT DISTINCT date_trunc('month', l_shipdate) AS bin, l_suppkey - 1 AS scope,
        l_partkey % 100 AS asn FROM lineitem""",
    "v_country": f"""SELECT make_timestamp({month('o_orderdate')} * 1000000) AS timebin, {cc('n_nationkey')} AS cc,
        o_custkey % 50 AS asn, CASE WHEN o_orderkey % 10 = 0 OR n_nationkey = 13 THEN 0.0 ELSE o_totalprice / 600000 END AS hege,
        o_totalprice AS original_weight, o_orderpriority AS weight, o_orderstatus = 'F' AS transit_only
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "v_country_scores": f"""SELECT make_timestamp({month('o_orderdate')} * 1000000) AS timebin, {cc('n_nationkey')} AS cc,
        o_custkey % 50 AS asn, CASE WHEN o_orderkey % 10 = 0 THEN 0.0 ELSE o_totalprice / 600000 END AS hege,
        o_totalprice AS original_weight, o_orderpriority AS weight, o_orderstatus = 'F' AS transit_only
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "v_asn_dim": """SELECT s_suppkey AS number, s_name AS name, true AS tartiflette, false AS disco,
        s_suppkey % 4 = 0 AS ashash FROM supplier WHERE s_suppkey % 2 = 0""",
    "v_location_dim": """SELECT s_suppkey + 1 AS id, 'AS' AS type, s_suppkey::VARCHAR AS name, 4 AS af
        FROM supplier WHERE s_suppkey % 2 = 0""",
    "v_bgp": """SELECT CASE WHEN event_type IN ('view', 'click') THEN 'rrc-' ELSE 'route-' END || event_type AS collector,
        CASE WHEN event_type = 'signup' THEN 'ribs' ELSE 'updates' END AS record_type, event_id AS pos,
        epoch(date_trunc('day', ts))::BIGINT AS time, epoch(date_trunc('hour', ts))::BIGINT AS hour,
        CASE WHEN event_id % 4 = 0 THEN 'W' ELSE 'A' END AS elem_type, user_id AS peer_asn,
        '10.0.' || (user_id // 256) % 256 || '.' || user_id % 256 AS peer_address,
        user_id || ' ' || event_id % 100 AS as_path,
        CASE WHEN event_id % 3 <> 0 THEN [event_type, props] END AS communities,
        '10.' || (event_id // 256) % 256 || '.' || event_id % 256 || '.0/24' AS prefix,
        CASE WHEN event_id % 13 = 0 THEN 'corrupted' ELSE 'valid' END AS status FROM events""",
    "v_run": """SELECT *, sum(CASE WHEN time = prev THEN 0 ELSE 1 END)
            OVER (PARTITION BY collector, record_type ORDER BY pos) AS run
        FROM (SELECT *, lag(time) OVER (PARTITION BY collector, record_type ORDER BY pos) AS prev FROM v_bgp)""",
    "v_chunk": """SELECT *, (row_number() OVER (PARTITION BY collector, record_type, run ORDER BY pos) - 1) // 20 AS chunk
        FROM v_run""",
    "v_ix": """SELECT r_regionkey AS id, r_name AS name, r_name || ' exchange' AS name_long,
        chr((65 + r_regionkey)::INT) || 'X' AS country FROM region WHERE r_regionkey < 4""",
    "v_ixlan": "SELECT n_nationkey AS id, n_regionkey AS ix_id FROM nation WHERE n_nationkey < 20",
    "v_ixpfx": f"""SELECT c_custkey AS id, c_nationkey AS ixlan_id,
        CASE WHEN c_mktsegment = 'FURNITURE' THEN 'IPX' WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'IPv4'
        ELSE 'IPv6' END AS protocol, {PREFIX.format(c='c_custkey')} AS prefix,
        CASE WHEN c_custkey % 17 = 0 THEN 'pending' ELSE 'ok' END AS status FROM customer""",
    "v_tr": f"""SELECT {month('l_shipdate')} AS ts, {identifier('l_linenumber', 'l_suppkey % 256', 'l_partkey % 100')} AS scope,
        {identifier('1 + (l_orderkey % 5)', 'l_partkey % 50', 'l_suppkey % 10')} AS asn,
        l_discount AS hege, l_quantity::INTEGER AS nb_peers FROM lineitem""",
    "v_tr_rows": f"""SELECT * FROM (SELECT make_timestamp((ts + 1814400) * 1000000) AS timebin, {tagged('scope')} AS origin,
        {tagged('asn')} AS dependency, hege, nb_peers AS nbsamples FROM v_tr WHERE nb_peers >= 10)
        WHERE origin IS NOT NULL AND dependency IS NOT NULL""",
    "v_tr_seen": """SELECT DISTINCT split_part(k, ':', 1) AS type, substr(k, 4) AS name, 4 AS af
        FROM (SELECT origin AS k FROM v_tr_rows UNION SELECT dependency FROM v_tr_rows)""",
    "v_delay": f"""SELECT {month('l_shipdate')} AS ts,
        'AS' || l_suppkey || CASE l_linenumber % 3 WHEN 1 THEN 'v6' ELSE 'v4' END AS startpoint,
        'CT' || l_partkey % 50 || ', FR' || CASE l_orderkey % 3 WHEN 1 THEN 'v6' ELSE 'v4' END AS endpoint,
        l_extendedprice AS median, l_linenumber AS nbtracks, l_quantity::INTEGER AS nbprobes, l_tax AS entropy,
        l_linenumber AS hop, (l_orderkey % 100)::INTEGER AS nbrealrtts FROM lineitem""",
    "v_delay_seen": """SELECT DISTINCT substr(loc, 1, 2) AS type, substr(loc, 3, len(loc) - 4) AS name,
        right(loc, 1)::INTEGER AS af FROM (SELECT startpoint AS loc FROM v_delay UNION SELECT endpoint FROM v_delay)""",
    "v_tr_dim": registered("v_tr_seen"),
    "v_delay_dim": registered("v_delay_seen"),
    "v_order_probes": """SELECT l_orderkey, l_suppkey, epoch(min(l_shipdate))::BIGINT AS shipped FROM lineitem
        GROUP BY ALL""",
    "v_burst": """SELECT lower(o_orderpriority) AS streamtype, o_orderkey::VARCHAR AS streamname, o_orderkey,
        o_orderdate AS starttime, o_totalprice AS avglevel, o_custkey AS totalprobes,
        (SELECT count(*) FROM v_order_probes p WHERE p.l_orderkey = o_orderkey)::INTEGER AS nbdiscoprobes
        FROM orders WHERE o_orderkey % 10 <> 9 AND o_orderkey IN (SELECT l_orderkey FROM lineitem)""",
    "v_reconnect": """SELECT lower(o_orderpriority) AS streamtype, o_orderkey::VARCHAR AS streamname, o_orderkey,
        o_orderdate AS starttime, o_orderdate + to_seconds((o_custkey % 20) * 60 + again * 600) AS endtime,
        (o_custkey % 20) * 60 + again * 600 AS lasted, o_orderkey * 2 + again AS "offset"
        FROM (SELECT *, unnest(CASE WHEN o_orderkey % 4 = 0 THEN [0, 1] ELSE [0] END) AS again FROM orders
              WHERE o_orderstatus <> 'O')""",
    "v_ends": """SELECT o_orderkey, bool_or(lasted < 300) AS short,
        arg_max(endtime, "offset") FILTER (lasted >= 300) AS last_end FROM v_reconnect GROUP BY 1""",
    "v_probe_archive": """SELECT user_id AS id, event_id AS "offset", 
        CASE WHEN user_id % 5 <> 0 THEN '10.2.0.' || user_id % 256 END AS address_v4,
        CASE WHEN user_id % 3 <> 0 THEN '10.2.' || user_id % 256 || '.0/24' END AS prefix_v4,
        user_id % 6 <> 0 AND user_id % 4 <> 1 AS placed,
        (user_id % 60)::DOUBLE - 30 + event_id AS lon, (user_id % 50)::DOUBLE AS lat,
        user_id % 40 AS asn_v4, chr((65 + user_id % 8)::INT) || 'A' AS country_code FROM events""",
    "v_probe": """SELECT s_suppkey AS id,
        CASE WHEN s_suppkey % 5 <> 0 THEN '10.2.0.' || s_suppkey % 256 ELSE '' END AS ipv4,
        CASE WHEN s_suppkey % 3 <> 0 THEN '10.2.' || s_suppkey % 256 || '.0/24' ELSE '' END AS prefixv4,
        CASE WHEN s_suppkey % 6 <> 0 AND s_suppkey % 4 <> 1 THEN (s_suppkey % 60)::DOUBLE - 30 ELSE 0 END AS lon,
        CASE WHEN s_suppkey % 6 <> 0 AND s_suppkey % 4 <> 1 THEN (s_suppkey % 50)::DOUBLE ELSE 0 END AS lat,
        s_suppkey % 40 AS asn_v4, chr((65 + s_suppkey % 8)::INT) || 'A' AS country_code
        FROM supplier WHERE s_suppkey % 7 <> 3""",
    "v_geo": f"""SELECT net, len, arg_min_null(cc, p_partkey) AS cc FROM (
        SELECT {net(3, '(p_size % 11 + 18)')} AS net, p_size % 11 + 18 AS len, p_partkey,
        CASE WHEN p_size <> 13 THEN chr((65 + p_size % 26)::INT) || 'Z' END AS cc FROM part) GROUP BY net, len""",
    "v_roa": f"""SELECT {net(1, '(p_size % 9 + 16)')} AS net, p_size % 9 + 16 AS len,
        p_size % 9 + 16 + p_size % 4 AS max_len, p_partkey % 100 AS asn FROM part""",
    "v_irr": f"""SELECT {net(5, '(p_size % 7 + 18)')} AS net, p_size % 7 + 18 AS len, 32 AS max_len, p_size AS asn,
        p_name AS descr FROM part""",
    "v_delegated_prefix": f"""SELECT net, len, min(status) AS status FROM (
        SELECT {net(9, '(p_size % 5 + 17)')} AS net, p_size % 5 + 17 AS len,
        CASE WHEN p_size % 2 = 0 THEN 'allocated' ELSE 'assigned' END AS status FROM part WHERE p_partkey % 2 = 0)
        GROUP BY ALL""",
    "v_delegated_asn": """SELECT s_suppkey * 3 AS lo, s_suppkey * 3 + 1 AS hi,
        CASE WHEN s_nationkey % 2 = 0 THEN 'allocated' ELSE 'available' END AS status FROM supplier""",
    "v_pairs": "SELECT DISTINCT prefix, net, originasn_id FROM v_prefix_rows",
    "v_pairs_stored": "SELECT DISTINCT prefix, net, originasn_id FROM v_prefix_rows WHERE hege <> 0",
    "v_rpki": """SELECT prefix, originasn_id, CASE WHEN r.net IS NULL THEN 'NotFound' WHEN bool_or(coalesce(
            r.asn = originasn_id AND 24 <= r.max_len, false)) OVER w THEN 'Valid' ELSE 'Invalid' END AS rpki_status
        FROM v_pairs p LEFT JOIN v_roa r ON r.len <= 24 AND p.net - p.net % (1::BIGINT << (32 - r.len)) = r.net
        WINDOW w AS (PARTITION BY prefix, originasn_id)
        QUALIFY row_number() OVER w = 1""",
    "v_irr_status": """SELECT prefix, originasn_id, CASE WHEN r.net IS NULL THEN 'NotFound'
            WHEN r.asn = originasn_id THEN 'Valid' ELSE 'Invalid' END AS irr_status, coalesce(r.descr, '') AS descr
        FROM v_pairs p LEFT JOIN v_irr r ON r.len <= 24 AND p.net - p.net % (1::BIGINT << (32 - r.len)) = r.net
        QUALIFY row_number() OVER (PARTITION BY prefix, originasn_id
            ORDER BY coalesce(r.asn = originasn_id, false) DESC, r.len DESC NULLS LAST, r.descr DESC) = 1""",
    "v_prefix_cc": """SELECT prefix, coalesce(cc, 'ZZ') AS country_id
        FROM (SELECT DISTINCT prefix, net AS addr FROM v_prefix_rows) p
        LEFT JOIN v_geo g ON p.addr - p.addr % (1::BIGINT << (32 - g.len)) = g.net
        QUALIFY row_number() OVER (PARTITION BY prefix ORDER BY g.len DESC NULLS LAST) = 1""",
    "v_prefix_del": """SELECT prefix, coalesce(status, 'NotFound') AS delegated_prefix_status
        FROM (SELECT DISTINCT prefix, net AS addr FROM v_prefix_rows) p
        LEFT JOIN v_delegated_prefix g ON p.addr - p.addr % (1::BIGINT << (32 - g.len)) = g.net
        QUALIFY row_number() OVER (PARTITION BY prefix ORDER BY g.len DESC NULLS LAST) = 1""",
    "v_asn_del": """SELECT originasn_id, coalesce(status, 'NotFound') AS delegated_asn_status
        FROM (SELECT DISTINCT originasn_id FROM v_prefix_rows) LEFT JOIN v_delegated_asn
        ON originasn_id BETWEEN lo AND hi""",
    "v_moas": """SELECT timebin, prefix, count(DISTINCT originasn_id) > 1 AS moas FROM v_prefix_rows GROUP BY ALL""",
    "v_peer_max": """SELECT timebin, greatest(max(most) OVER (ORDER BY timebin), 1) AS peer_max
        FROM (SELECT timebin, max(nb_peers) AS most FROM v_prefix_rows GROUP BY 1)""",
    "v_alarms": f"""SELECT l_orderkey, l_extendedprice / 1000 AS deviation, {month('l_shipdate')} AS ts,
        CASE WHEN l_linenumber = 7 THEN 6 ELSE 4 END AS af, l_suppkey - 1 AS scope,
        CASE l_linenumber WHEN 4 THEN '4200000000' WHEN 5 THEN 'AS' || l_partkey WHEN 6 THEN NULL
        ELSE (l_partkey % 100)::VARCHAR END AS asn FROM lineitem""",
    "v_texts": """SELECT l_orderkey, l_linenumber, l_suppkey, CASE l_linenumber WHEN 1 THEN ' ' || l_suppkey
        WHEN 2 THEN '{' || l_suppkey || ',7}' WHEN 3 THEN 'AS' || l_suppkey WHEN 4 THEN '' ELSE l_suppkey::VARCHAR END
        AS text FROM lineitem""",
    "v_addresses": """SELECT DISTINCT 10 * 16777216 + ((l_partkey * 3 // 256) % 256) * 65536
            + (l_partkey * 3 % 256) * 256 + (l_suppkey * 5 + l_linenumber) % 256 AS addr,
        '10.' || (l_partkey * 3 // 256) % 256 || '.' || l_partkey * 3 % 256 || '.'
            || (l_suppkey * 5 + l_linenumber) % 256 AS ip FROM lineitem""",
    "v_measurements": """SELECT p_partkey AS id, p_size * 120 AS "interval", 1700000000 + p_partkey * 100 AS start_time,
        p_partkey % 5 = 0 AS ping, CASE WHEN p_partkey % 7 = 0 THEN 6 ELSE 4 END AS af, p_partkey % 3 + 1 AS status,
        CASE WHEN p_partkey % 9 = 0 THEN 2 ELSE 1 END AS first_hop,
        CASE WHEN p_partkey % 11 <> 0 THEN p_size * 5 END AS crowd FROM part""",
}


def with_views(names: str, select: str) -> str:
    """``WITH`` the named views (in order) in front of a SELECT."""
    ctes = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in names.split())
    return f"WITH {ctes}\n{select}" if ctes else select
