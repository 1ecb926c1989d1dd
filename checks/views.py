"""The operators' inputs, derived from the given tables. ``sql_views`` defines the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.identifiers import encode_key
from tidemark.functions.network import ip_to_long, truncate
from tidemark.operators.log import to_log
from tidemark.streaming.runs import read_files


def _utc(spark: SparkSession, df: DataFrame) -> DataFrame:
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return df.select(*[
        F.col(c).cast("timestamp").alias(c) if t == "timestamp_ntz" else F.col(c) for c, t in df.dtypes])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, with its times as UTC timestamps."""
    return _utc(spark, spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same as a stream."""
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    return _utc(spark, read_files(spark, sf_dir, schema, glob=f"{name}.parquet"))


def month_s(column: str) -> Column:
    return F.unix_seconds(F.date_trunc("month", F.col(column)))


def v_log(spark, sf):
    e = table(spark, sf, "events")
    value = F.struct(
        "event_id", "user_id", "value", "props",
        F.when(F.col("event_id") % 5 != 0, F.col("user_id") % 7).alias("tag"))
    return to_log(e, F.col("event_type"), encode_key(F.col("user_id")), F.col("ts"), value, n=3,
                  ties=[F.col("event_id")], partition=F.col("user_id") % 3)


def v_series(spark, sf, read=table):
    return read(spark, sf, "events").select("event_id", "user_id", "value", F.col("ts").alias("timestamp"))


def only_zero() -> Column:
    """The score, 0 in every row that names AS 77, which must be registered all the same."""
    named = (F.col("l_partkey") % 100 == 77) | F.col("l_suppkey").between(76, 78)
    return F.when(named, 0.0).otherwise(F.col("l_discount"))


def v_hege(spark, sf, read=table):
    return read(spark, sf, "lineitem").select(
        month_s("l_shipdate").alias("timestamp"), (F.col("l_suppkey") - 1).cast("string").alias("scope"),
        (F.col("l_partkey") % 100).cast("string").alias("asn"), only_zero().alias("hege"),
        F.col("l_quantity").cast("int").alias("nb_peers"))


def v_hege_set(spark, sf):
    li = table(spark, sf, "lineitem")
    asn = F.when(F.col("l_linenumber") == 6, F.concat(
        F.lit("{"), (F.col("l_partkey") % 100).cast("string"), F.lit(",x,"),
        (F.col("l_partkey") % 100 + 1).cast("string"), F.lit("}")))
    return li.select(
        month_s("l_shipdate").alias("ts"), (F.col("l_suppkey") - 1).cast("string").alias("scope"),
        F.coalesce(asn, (F.col("l_partkey") % 100).cast("string")).alias("asn"), F.col("l_discount").alias("hege"))


def prefix_text(column: str) -> Column:
    return F.concat(F.lit("10."), F.expr(f"({column} div 256) % 256").cast("string"), F.lit("."),
                    (F.col(column) % 256).cast("string"), F.lit(".0/24"))


def v_hege_prefix(spark, sf, read=table):
    supp = F.col("l_suppkey")
    origin = F.when(F.col("l_linenumber") == 7, F.concat(
        F.lit("{"), supp.cast("string"), F.lit(","), (supp + 1).cast("string"), F.lit("}"))
    ).otherwise((supp - 1).cast("string"))
    return read(spark, sf, "lineitem").select(
        month_s("l_shipdate").alias("timestamp"),
        F.concat(prefix_text("l_partkey"), F.lit("_"), origin).alias("scope"),
        (F.col("l_partkey") % 100).cast("string").alias("asn"), only_zero().alias("hege"),
        F.col("l_quantity").cast("int").alias("nb_peers"))


def v_messages(spark, sf):
    """One message per bin and scope with its map of scores."""
    li = table(spark, sf, "lineitem").select(
        F.date_trunc("month", "l_shipdate").alias("timestamp"), (F.col("l_suppkey") - 1).alias("scope"),
        (F.col("l_partkey") % 100).cast("string").alias("asn"), F.col("l_discount").alias("hege"))
    each = li.groupBy("timestamp", "scope", "asn").agg(F.max("hege").alias("hege"))
    return each.groupBy("timestamp", "scope").agg(
        F.map_from_entries(F.collect_list(F.struct("asn", "hege"))).alias("scope_hegemony")).select(
        "timestamp", F.col("scope").cast("string").alias("scope"), "scope_hegemony",
        F.pmod(F.col("scope"), F.lit(3)).cast("int").alias("partition"), F.col("scope").alias("offset"))


def country_code(column: str) -> Column:
    k = F.col(column)
    letter = lambda c: F.char(F.lit(65) + c)
    return F.when(k == 0, "EU").when(k == 1, "AP").otherwise(
        F.concat(letter(F.expr(f"{column} div 5")), letter(k % 5)))


def v_hege_country(spark, sf, only_zero=13):
    """Country scores; the nation ``only_zero``, if any, has none but zeros."""
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    nation = table(spark, sf, "nation")
    zero = F.col("o_orderkey") % 10 == 0
    if only_zero is not None:
        zero = zero | (F.col("n_nationkey") == only_zero)
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, customer.c_nationkey == nation.n_nationkey)
        .select(
            month_s("o_orderdate").alias("ts"), country_code("n_nationkey").alias("cc"),
            (F.col("o_custkey") % 50).cast("string").alias("asn"),
            F.when(zero, 0.0).otherwise(F.col("o_totalprice") / 600000).alias("hege"),
            F.col("o_totalprice").alias("original_weight"), F.col("o_orderpriority").alias("weight"),
            (F.col("o_orderstatus") == "F").alias("transit_only"))
    )


def v_country_names(spark, sf):
    return table(spark, sf, "nation").where("n_nationkey < 20").select(
        country_code("n_nationkey").alias("code"), F.col("n_name").alias("name"))


def v_country_dim(spark, sf):
    return table(spark, sf, "nation").where("n_nationkey between 5 and 9").select(
        country_code("n_nationkey").alias("code"), F.col("n_name").alias("name"),
        F.lit(False).alias("tartiflette"), F.lit(False).alias("disco"))


def v_asn_dim(spark, sf):
    return table(spark, sf, "supplier").where("s_suppkey % 2 = 0").select(
        F.col("s_suppkey").alias("number"), F.col("s_name").alias("name"), F.lit(True).alias("tartiflette"),
        F.lit(False).alias("disco"), (F.col("s_suppkey") % 4 == 0).alias("ashash"))


def v_location_dim(spark, sf):
    return table(spark, sf, "supplier").where("s_suppkey % 2 = 0").select(
        (F.col("s_suppkey") + 1).alias("id"), F.lit("AS").alias("type"),
        F.col("s_suppkey").cast("string").alias("name"), F.lit(4).alias("af"))


def v_bgp(spark, sf, time_unit="day"):
    e = table(spark, sf, "events")
    kind, eid, uid = F.col("event_type"), F.col("event_id"), F.col("user_id")
    peer = F.concat(F.lit("10.0."), F.expr("(user_id div 256) % 256").cast("string"), F.lit("."),
                    (uid % 256).cast("string"))
    return e.select(
        F.concat(F.when(kind.isin("view", "click"), "rrc-").otherwise("route-"), kind).alias("collector"),
        F.when(kind == "signup", "ribs").otherwise("updates").alias("record_type"),
        eid.alias("pos"), F.unix_seconds(F.date_trunc(time_unit, "ts")).alias("time"),
        F.when(eid % 4 == 0, "W").otherwise("A").alias("elem_type"), uid.alias("peer_asn"),
        peer.alias("peer_address"), peer.alias("next_hop"),
        F.concat_ws(" ", uid.cast("string"), (eid % 100).cast("string")).alias("as_path"),
        F.when(eid % 3 != 0, F.array(kind, "props")).alias("communities"),
        prefix_text("event_id").alias("prefix"),
        F.when(eid % 13 == 0, "corrupted").otherwise("valid").alias("status"))


def v_ix(spark, sf):
    return table(spark, sf, "region").where("r_regionkey < 4").select(
        F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"),
        F.concat("r_name", F.lit(" exchange")).alias("name_long"),
        F.concat(F.char(F.lit(65) + F.col("r_regionkey")), F.lit("X")).alias("country"))


def v_ixlan(spark, sf):
    return table(spark, sf, "nation").where("n_nationkey < 20").select(
        F.col("n_nationkey").alias("id"), F.col("n_regionkey").alias("ix_id"))


def v_ixpfx(spark, sf):
    seg = F.col("c_mktsegment")
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("ixlan_id"),
        F.when(seg == "FURNITURE", "IPX").when(seg.isin("BUILDING", "MACHINERY"), "IPv4")
        .otherwise("IPv6").alias("protocol"),
        prefix_text("c_custkey").alias("prefix"),
        F.when(F.col("c_custkey") % 17 == 0, "pending").otherwise("ok").alias("status"))


def v_netixlan(spark, sf):
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("ix_id"), F.col("c_name").alias("name"),
        (F.col("c_custkey") % 64).alias("asn"),
        F.when(F.col("c_custkey") % 3 != 0, F.concat(F.lit("10.1.0."), (F.col("c_custkey") % 256).cast("string"))
               ).alias("ipaddr4"),
        F.when(F.col("c_custkey") % 4 != 0, F.concat(F.lit("2001:db8::"), F.lower(F.hex("c_custkey")))
               ).alias("ipaddr6"))


def _identifier(kind: str, a: str, b: str) -> Column:
    k, a, b = F.expr(kind), F.expr(a).cast("string"), F.expr(b).cast("string")
    return (
        F.when(k == 1, F.concat(F.lit("as|"), a)).when(k == 2, F.concat(F.lit("ip|10.0.0."), a))
        .when(k == 3, F.concat(F.lit("ix|"), a)).when(k == 4, F.concat(F.lit("ix|"), a, F.lit(";as|"), b))
        .when(k == 5, F.concat(F.lit("ix|"), a, F.lit(";as|0"))).when(k == 6, F.concat(F.lit("zz|"), a))
        .otherwise(F.concat(F.lit("as|sa"), a)))


def v_tr(spark, sf):
    return table(spark, sf, "lineitem").select(
        month_s("l_shipdate").alias("timestamp"),
        _identifier("l_linenumber", "l_suppkey % 256", "l_partkey % 100").alias("scope"),
        _identifier("1 + (l_orderkey % 5)", "l_partkey % 50", "l_suppkey % 10").alias("asn"),
        F.col("l_discount").alias("hege"), F.col("l_quantity").cast("int").alias("nb_peers"))


def v_delay(spark, sf):
    def suffix(expr):
        return F.when(F.expr(f"{expr} % 3 = 0"), "v4").when(F.expr(f"{expr} % 3 = 1"), "v6").otherwise("")

    return table(spark, sf, "lineitem").select(
        month_s("l_shipdate").alias("ts"),
        F.concat(F.lit("AS"), F.col("l_suppkey").cast("string"), suffix("l_linenumber")).alias("startpoint"),
        F.concat(F.lit("CT"), (F.col("l_partkey") % 50).cast("string"), F.lit(", FR"), suffix("l_orderkey")
                 ).alias("endpoint"),
        F.col("l_extendedprice").alias("median"), F.col("l_linenumber").alias("nb_tracks"),
        F.col("l_quantity").cast("int").alias("nb_probes"), F.col("l_tax").alias("entropy"),
        (F.col("l_linenumber") + 0.5).alias("hop"), (F.col("l_orderkey") % 100).cast("int").alias("nb_real_rtts"))


def _order_probes(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_orderkey", "l_suppkey").agg(
        F.min(F.unix_seconds("l_shipdate")).alias("shipped"))


def v_burst(spark, sf):
    probes = _order_probes(spark, sf).groupBy("l_orderkey").agg(
        F.map_from_entries(F.collect_list(F.struct("l_suppkey", "shipped"))).alias("probelist"))
    return table(spark, sf, "orders").where("o_orderkey % 10 <> 9").join(
        probes, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.col("o_orderpriority").alias("streamtype"), F.col("o_orderkey").alias("streamname"),
        F.unix_seconds("o_orderdate").alias("starttime"), F.col("o_totalprice").alias("level"),
        F.col("o_custkey").alias("totalprobes"), "probelist")


def v_reconnect(spark, sf):
    """Closed orders reconnect, some of them twice with different ends."""
    orders = table(spark, sf, "orders").where("o_orderstatus <> 'O'").withColumn(
        "again", F.explode(F.when(F.col("o_orderkey") % 4 == 0, F.array(F.lit(0), F.lit(1))
                                  ).otherwise(F.array(F.lit(0)))))
    start = F.unix_seconds("o_orderdate")
    orders = orders.withColumn("endtime", start + (F.col("o_custkey") % 20) * 60 + F.col("again") * 600)
    probes = _order_probes(spark, sf).where("l_suppkey % 2 = 0").groupBy("l_orderkey").agg(
        F.collect_list("l_suppkey").alias("back"))
    joined = orders.join(probes, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    back = F.coalesce("back", F.array().cast("array<bigint>"))
    return joined.select(
        F.col("o_orderpriority").alias("streamtype"), F.col("o_orderkey").alias("streamname"),
        start.alias("starttime"), "endtime",
        F.map_from_arrays(back, F.transform(back, lambda p: F.col("endtime") + p)).alias("reconnectedprobes"),
        (F.col("o_orderkey") * 2 + F.col("again")).alias("offset"))


def _probe(df, key, n):
    k = F.col(key)
    lon = F.when(k % 4 != 1, (k % 60).cast("double") - 30 + n)
    return df.select(
        k.alias("id"), n.alias("offset"),
        F.when(k % 5 != 0, F.concat(F.lit("10.2.0."), (k % 256).cast("string"))).alias("address_v4"),
        F.when(k % 3 != 0, F.concat(F.lit("10.2."), (k % 256).cast("string"), F.lit(".0/24"))).alias("prefix_v4"),
        F.when(k % 6 != 0, F.struct(F.array(lon, (k % 50).cast("double")).alias("coordinates"))).alias("geometry"),
        (k % 40).alias("asn_v4"), F.concat(F.char(F.lit(65) + k % 8), F.lit("A")).alias("country_code"))


def v_probe_archive(spark, sf):
    return _probe(table(spark, sf, "events"), "user_id", F.col("event_id"))


def v_probe(spark, sf):
    s = table(spark, sf, "supplier").where("s_suppkey % 7 <> 3")
    return _probe(s, "s_suppkey", F.lit(0).cast("bigint"))


def _net(scale: int, length: Column) -> Column:
    addr = F.lit(10 * 256 ** 3).cast("bigint") + (F.col("p_partkey") * scale % 65536) * 256
    return truncate(addr, length, 4)


def v_geo(spark, sf):
    p = table(spark, sf, "part")
    length = (F.col("p_size") % 11 + 18).cast("int")
    cc = F.when(F.col("p_size") != 13, F.concat(F.char(F.lit(65) + F.col("p_size") % 26), F.lit("Z")))
    return p.select(_net(3, length).alias("net"), length.alias("len"), "p_partkey", cc.alias("cc")).groupBy(
        "net", "len").agg(F.min_by("cc", "p_partkey").alias("cc"))


def v_roa(spark, sf):
    p = table(spark, sf, "part")
    length = (F.col("p_size") % 9 + 16).cast("int")
    return p.select(
        _net(1, length).alias("net"), length.alias("len"), (length + F.col("p_size") % 4).alias("max_len"),
        (F.col("p_partkey") % 100).alias("asn"))


def v_irr(spark, sf):
    p = table(spark, sf, "part")
    length = (F.col("p_size") % 7 + 18).cast("int")
    return p.select(
        _net(5, length).alias("net"), length.alias("len"), F.lit(32).alias("max_len"),
        F.col("p_size").cast("bigint").alias("asn"), F.col("p_name").alias("descr"))


def v_delegated_prefix(spark, sf):
    p = table(spark, sf, "part").where("p_partkey % 2 = 0")
    length = (F.col("p_size") % 5 + 17).cast("int")
    return p.select(
        _net(9, length).alias("net"), length.alias("len"),
        F.when(F.col("p_size") % 2 == 0, "allocated").otherwise("assigned").alias("status")).groupBy(
        "net", "len").agg(F.min("status").alias("status"))


def v_delegated_asn(spark, sf):
    return table(spark, sf, "supplier").select(
        (F.col("s_suppkey") * 3).alias("lo"), (F.col("s_suppkey") * 3 + 1).alias("hi"),
        F.when(F.col("s_nationkey") % 2 == 0, "allocated").otherwise("available").alias("status"))


def v_addresses(spark, sf):
    """An IPv4 address per order line."""
    return table(spark, sf, "lineitem").select(F.concat(
        F.lit("10."), F.expr("((l_partkey * 3) div 256) % 256").cast("string"), F.lit("."),
        F.expr("(l_partkey * 3) % 256").cast("string"), F.lit("."),
        F.expr("(l_suppkey * 5 + l_linenumber) % 256").cast("string")).alias("ip"))


def v_addresses6(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.concat(F.lit("2001:db8:"), F.lower(F.hex(F.col("o_custkey") % 4096)), F.lit("::"),
                 F.lower(F.hex(F.col("o_orderkey") % 65536))).alias("ip"))


def v_geo6(spark, sf):
    """Networks 2001:db8:<n>::/len with lengths 36 to 48."""
    p = table(spark, sf, "part")
    length = (F.col("p_size") % 13 + 36).cast("int")
    text = F.concat(F.lit("2001:db8:"), F.lower(F.hex(F.col("p_partkey") % 4096)), F.lit("::/"), length.cast("string"))
    return p.select(text.alias("prefix"), "p_partkey",
                    F.concat(F.char(F.lit(65) + F.col("p_size") % 26), F.lit("Y")).alias("cc"))


def v_measurements(spark, sf):
    p, k = table(spark, sf, "part"), F.col("p_partkey")
    return p.select(
        k.alias("id"), (F.col("p_size") * 120).alias("interval"),
        (F.lit(1_700_000_000) + k * 100).alias("start_time"),
        F.when(k % 5 == 0, "ping").otherwise("traceroute").alias("type"),
        F.when(k % 7 == 0, 6).otherwise(4).alias("af"), (k % 3 + 1).cast("int").alias("status"),
        F.when(k % 9 == 0, 2).otherwise(1).alias("first_hop"),
        F.when(k % 11 != 0, F.col("p_size") * 5).alias("participant_count"))


def v_alarms(spark, sf):
    """Score alarms as messages: mostly a nested datapoint, some with fields of their own."""
    li = table(spark, sf, "lineitem")
    n = F.col("l_linenumber")
    text = F.when(n == 5, F.concat(F.lit("AS"), F.col("l_partkey").cast("string"))).when(
        n != 6, (F.col("l_partkey") % 100).cast("string"))
    return li.select(
        "l_orderkey", (F.col("l_extendedprice") / 1000).alias("deviation"),
        F.when(n == 7, F.lit(6)).alias("af"), F.when(n == 4, F.lit("4200000000")).alias("asn"),
        F.struct(month_s("l_shipdate").alias("timestamp"), (F.col("l_suppkey") - 1).cast("string").alias("scope"),
                 text.alias("asn")).alias("datapoint"))


def v_delay_alarms(spark, sf):
    d = v_delay(spark, sf)
    return d.select(F.struct("ts", "startpoint", "endpoint", "median").alias("datapoint"),
                    (F.col("median") / 1000).alias("deviation"))


def v_ranks(spark, sf):
    return table(spark, sf, "orders").select(
        month_s("o_orderdate").alias("timestamp"), F.col("o_custkey").cast("int").alias("rank"),
        F.col("o_totalprice").alias("mean"), (F.col("o_orderkey") % 300).alias("asn"),
        F.when(F.col("o_orderkey") % 6 != 0, (F.col("o_orderkey") % 50).cast("int")).alias("num_samples"))


def v_texts(spark, sf):
    """Origins as text: numbers, padded numbers, sets, and words."""
    n = F.col("l_linenumber")
    k = F.col("l_suppkey").cast("string")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", n.alias("l_linenumber"), "l_suppkey",
        F.when(n == 1, F.concat(F.lit(" "), k)).when(n == 2, F.concat(F.lit("{"), k, F.lit(",7}")))
        .when(n == 3, F.concat(F.lit("AS"), k)).when(n == 4, F.lit("")).otherwise(k).alias("text"))
