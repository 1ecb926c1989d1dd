from datetime import datetime

import pytest
from pyspark.sql import functions as F

from checks.registry import QUERIES, SQL
from checks import score_queries  # noqa: F401
from conftest import SMALL, rows
from tidemark.functions.network import address, address_part, length_part, long_to_ip
from tidemark.operators import dimensions, hegemony, prefixes
from tidemark.plans import mapped_tables, scores
from tidemark.operators.mapping import MapSpec, map_rows

SCORE = "timestamp bigint, scope string, asn string, hege double"


def test_cone(spark):
    df = spark.createDataFrame([
        (0, "1", "10", 0.5), (0, "2", "10", 0.5), (0, "2", "10", 0.5),  # three messages
        (0, "1", "11", 0.0),  # only a zero score
        (0, "-1", "12", 0.5), (0, "0", "12", 0.5),  # only the global graph
        (0, "13", "13", 0.5),  # only itself
        (60, "1", "{20,21}", 0.5)], SCORE)
    stored, cones = scores.as_hegemony(df, 4)
    assert rows(cones, "conesize", "asn_id") == [(0, 11), (0, 12), (0, 13), (1, 20), (1, 21), (3, 10)]
    assert stored.count() == 8 and stored.where("originasn_id = -1").count() == 0
    assert rows(hegemony.cone(hegemony.score_rows(df), 4, distinct=True), "conesize", "asn_id") == [
        (1, 20), (1, 21), (2, 10)]


PREFIX = "timestamp bigint, scope string, asn string, hege double, nb_peers int"


def prefix_result(spark, data):
    geo = spark.createDataFrame([(10 << 24, 8, "AA")], "net bigint, len int, cc string")
    roa = spark.createDataFrame([(10 << 24, 24, 24, 1)], "net bigint, len int, max_len int, asn bigint")
    irr = spark.createDataFrame([(10 << 24, 8, 8, 1, "big"), (10 << 24, 16, 32, 2, "two")],
                                "net bigint, len int, max_len int, asn bigint, descr string")
    blocks = spark.createDataFrame([(10 << 24, 9, "assigned")], "net bigint, len int, status string")
    asns = spark.createDataFrame([(1, 1, "allocated")], "lo bigint, hi bigint, status string")
    return scores.prefix_hegemony(spark.createDataFrame(data, PREFIX), 4, geo, roa, irr, blocks, asns)


def test_prefix_scores(spark):
    out = prefix_result(spark, [
        (0, "10.0.0.0/24_1", "7", 0.5, 4), (0, "10.0.0.0/24_2", "7", 0.0, 5),
        (60, "10.0.0.0/24_{1,2}", "8", 0.5, 3), (120, "11.0.0.0/24_-1", "8", 0.5, 8)])
    got = rows(out, F.unix_seconds("timebin"), "originasn_id", "country_id", "rpki_status", "irr_status", "descr",
               "delegated_prefix_status", "delegated_asn_status", "visibility", "moas")
    assert got == [
        (0, 1, "AA", "Valid", "Invalid", "two", "assigned", "allocated", 80.0, True),
        (60, 1, "AA", "Valid", "Invalid", "two", "assigned", "allocated", 60.0, True),
        (60, 2, "AA", "Invalid", "Valid", "two", "assigned", "NotFound", 60.0, True),
        (120, 0, "ZZ", "NotFound", "NotFound", "", "NotFound", "NotFound", 100.0, False)]


def test_peer_max_never_falls(spark):
    df = spark.createDataFrame([(datetime(2024, 1, d), n) for d, n in ((1, 5), (2, 3), (3, 8))],
                               "timebin timestamp, nb_peers int")
    assert rows(hegemony.peer_max(df), "peer_max") == [(5,), (5,), (8,)]


def net(text):
    a, b, c, d = map(int, text.split("."))
    return ((a * 256 + b) * 256 + c) * 256 + d


def test_longest_prefix(spark):
    table = spark.createDataFrame(
        [(net("10.0.0.0"), 8, "AA"), (net("10.1.0.0"), 16, "BB"), (net("10.1.2.0"), 24, "CC"),
         (net("10.9.0.0"), 16, None)], "net bigint, len int, cc string")
    df = spark.createDataFrame([("10.1.2.3",), ("10.1.9.9",), ("10.2.0.0/16",), ("11.0.0.1",), ("10.9.1.1",), ("bad",)],
                               "ip string")
    assert rows(prefixes.longest_prefix(df, "ip", table, "cc"), "ip", "cc") == sorted([
        ("10.1.2.3", "CC"), ("10.1.9.9", "BB"), ("10.2.0.0/16", "AA"), ("11.0.0.1", "ZZ"), ("10.9.1.1", "ZZ"),
        ("bad", "ZZ")])


def test_origin_validation(spark):
    roa = spark.createDataFrame([(net("10.0.0.0"), 16, 20, 1), (net("10.0.0.0"), 8, 8, 2)],
                                "net bigint, len int, max_len int, asn bigint")
    pairs = [("10.0.0.0/16", 2), ("10.0.0.0/24", 1), ("10.0.0.0/20", 1), ("11.0.0.0/24", 1), ("10.0.0.0/8", 2)]
    df = spark.createDataFrame(pairs, "prefix string, originasn_id bigint")
    got = {(r.prefix, r.originasn_id): r.s for r in prefixes.validate_origin(df, roa, "s").collect()}
    assert [got[p] for p in pairs] == ["Invalid", "Invalid", "Valid", "NotFound", "Valid"]


def test_prefix_lookup_equals_brute_force(spark):
    import random
    random.seed(3)
    table = {}
    for _ in range(300):
        length = random.choice([8, 12, 15, 16, 20, 23, 24, 28, 32])
        base = (10 << 24) + random.getrandbits(24)
        table[(base - base % 2 ** (32 - length), length)] = f"C{len(table)}"
    addresses = sorted({(10 << 24) + random.getrandbits(24) for _ in range(500)})

    def best(a):
        hits = [(n, cc) for (b, n), cc in table.items() if a - a % 2 ** (32 - n) == b]
        return max(hits)[1] if hits else "ZZ"

    t = spark.createDataFrame([(b, n, cc) for (b, n), cc in table.items()], "net bigint, len int, cc string")
    df = spark.createDataFrame([(a,) for a in addresses], "a bigint").withColumn("ip", long_to_ip(F.col("a")))
    assert rows(prefixes.longest_prefix(df, "ip", t, "cc"), "a", "cc") == [(a, best(a)) for a in addresses]


def test_asn_blocks_across_cells(spark):
    blocks = spark.createDataFrame([(1000, 5000, "x"), (2048, 2048, "y")], "lo bigint, hi bigint, status string")
    keys = spark.createDataFrame([(999,), (1000,), (2048,), (5000,), (5001,)], "n bigint")
    assert rows(prefixes.asn_block_status(keys, "n", blocks, "s")) == [
        (999, "NotFound"), (1000, "x"), (2048, "y"), (5000, "x"), (5001, "NotFound")]


def test_traceroute_scores(spark):
    dim = spark.createDataFrame([(5, "AS", "1", 4)], "id bigint, type string, name string, af int")
    df = spark.createDataFrame([
        (0, "as|1", "as|2", 0.0, 10), (0, "as|1", "as|2", 0.5, 9), (0, "as|1", "ix|3;as|0", 0.5, 10)], PREFIX)
    out, full = scores.tr_hegemony(df, 4, dim)
    assert rows(out, F.unix_seconds("timebin"), "origin_id", "dependency_id", "hege") == [(1814400, 5, 6, 0.0)]
    assert rows(full, "id", "name") == [(5, "1"), (6, "2")]


def test_register_is_stable(spark):
    dim = spark.createDataFrame([(3, "a")], "id bigint, k string")
    keys = spark.createDataFrame([(c,) for c in "abcdeab"], "k string")
    once = dimensions.register(dim, keys, ["k"])
    assert sorted(r.id for r in once.collect()) == [3, 4, 5, 6, 7]
    assert rows(dimensions.register(once, keys, ["k"])) == rows(once)


def test_countries(spark):
    dim = spark.createDataFrame([("AA", "Aland", False, False)],
                                "code string, name string, tartiflette boolean, disco boolean")
    codes = spark.createDataFrame([("AA",), ("BB",), ("EU",), ("QQ",), ("ZZ",)], "code string")
    names = spark.createDataFrame([("BB", "Beland")], "code string, name string")
    special = {**dimensions.REGION_NAMES, **dimensions.UNKNOWN_COUNTRY}
    got = dimensions.register_countries(dim, codes, names, special)
    assert rows(got, "code", "name", "known") == [
        ("AA", "Aland", True), ("BB", "Beland", True), ("EU", "European Union", True), ("QQ", "QQ", False),
        ("ZZ", "Unknown", True)]


def test_mapping(spark):
    spec = MapSpec("t", "out", ("n", "loc", "m"), ("int", "atlas_location", "str"), ("n", "at", "m"), {"m": "d"})
    dim = spark.createDataFrame([(1, "AS", "5", 4)], "id bigint, type string, name string, af int")
    df = spark.createDataFrame([
        ("1", None, ("2", "AS5")),  # top level wins
        (None, None, ("3", "AS5v4")),  # from the datapoint
        (None, None, (None, "AS5")),  # missing
        ("x", None, ("4", "AS5")),  # bad int; the datapoint is not tried
        ("6", "AS9", (None, None)),  # unknown location
    ], "n string, at string, datapoint struct<n: string, at: string>")
    ok, bad = map_rows(df, spec, dim)
    assert rows(ok) == [(1, 1, "d"), (3, 1, "d")]
    assert rows(bad, "reason") == [("bad at",), ("bad n",), ("missing n",)]
    assert ok.count() + bad.count() == df.count()


def test_all_mappings_are_declared():
    specs = mapped_tables.all_specs()
    assert len(specs) == 15 and len({s.topic for s in specs}) == 15
    with pytest.raises(ValueError):
        MapSpec("t", "x", ("a",), ("int", "int"), ("a",))


def test_a_busy_prefix_is_not_multiplied(spark):
    """250 prefixes below one network that has 300 entries."""
    roa = spark.range(300).select(F.lit(10 << 24).cast("bigint").alias("net"), F.lit(8).alias("len"),
                                  F.lit(24).alias("max_len"), (F.col("id") + 1).alias("asn"))
    pairs = spark.range(250).select(F.format_string("10.%d.0.0/16", "id").alias("prefix"),
                                    F.when(F.col("id") % 2 == 0, 7).otherwise(9999).cast("bigint").alias("originasn_id"))
    got = prefixes.origin_status(pairs, roa, "status")
    assert rows(got.groupBy("status").count()) == [("Invalid", 125), ("Valid", 125)]
    owned = roa.withColumnRenamed("asn", "originasn_id")
    met = prefixes.covering(pairs, address(address_part(F.col("prefix")), 4), F.lit(16), owned, 4, ["originasn_id"])
    assert met.count() == 125


@pytest.mark.parametrize("af", [4, 6])
@pytest.mark.parametrize("broadcast_rows", [0, 10 ** 6])
def test_covering_equals_brute_force(spark, af, broadcast_rows):
    """Nested and equal networks, 0.0.0.0/0, the last address, keys without a network, both ways."""
    import ipaddress
    import random
    random.seed(af)
    width, kind = (32, ipaddress.IPv4Network) if af == 4 else (128, ipaddress.IPv6Network)
    top = 10 << (width - 8)

    def some(n):
        base = top + (random.getrandbits(8) << (width - 20)) + random.getrandbits(4)
        return base >> (width - n) << (width - n)

    nets = [(some(n), n) for n in random.choices([0, 8, 12, 14, 20, width - 2, width], k=120)]
    nets += [((1 << width) - 1, width), (1 << (width - 1), 1), (0, 1)]
    entries = [(str(kind(x)), random.randint(1, 3), i) for i, x in enumerate(nets)]
    keys = [(str(kind((some(width), n), strict=False)), random.randint(1, 3)) for n in random.choices([9, 16, 24, width], k=80)]
    keys += [(str(kind(((1 << width) - 1, width))), 1), (str(kind((0, width))), 2), ("x/8", 1)]
    keys = sorted(set(keys))

    def parsed(text):
        try:
            return kind(text)
        except ValueError:
            return None

    table = prefixes.prefix_table(spark.createDataFrame(entries, "p string, origin int, entry int"), "p", af)
    df = spark.createDataFrame(keys, "prefix string, origin int")
    addr, length = address(address_part(F.col("prefix")), af), length_part(F.col("prefix"), af)
    for on in ([], ["origin"]):
        want = sorted((k, o, e) for k, o in keys for p, own, e in entries
                      if parsed(k) and parsed(k).subnet_of(kind(p)) and (not on or o == own))
        part = table if on else table.drop("origin")
        got = prefixes.covering(df, addr, length, part, af, on, broadcast_rows)
        assert rows(got, "prefix", "origin", "entry") == want


def test_one_network_covers_all(spark):
    """The network of all addresses over many keys: one row a key, whichever task it is in."""
    table = spark.createDataFrame([(0, 0, "all")], "net bigint, len int, cc string")
    keys = spark.range(100_000).select(long_to_ip(F.col("id") * 42_949).alias("ip"))
    at = address(F.col("ip"), 4)
    assert prefixes.covering(keys, at, F.lit(32), table, 4, broadcast_rows=0).count() == 100_000


def test_times_out_of_range_are_rejected(spark):
    spec = MapSpec("t", "out", ("at",), ("datetime",), ("at",))
    ok, bad = map_rows(spark.createDataFrame([(1e18,), (1e300,), (float("nan"),), (12.0,), (None,)], "at double"), spec)
    assert rows(ok.select(F.unix_seconds("at"))) == [(12,)]
    assert rows(bad, "reason") == [("bad at",), ("bad at",), ("bad at",), ("missing at",)]


def test_numbers_that_only_score_zero_are_registered(spark):
    dim = spark.createDataFrame([], "number bigint, name string, tartiflette boolean, disco boolean, ashash boolean")
    df = spark.createDataFrame([(0, "5", "6", 0.0, 1), (0, "7", "8", 0.5, 1)],
                               "timestamp bigint, scope string, asn string, hege double, nb_peers int")
    assert rows(scores.as_numbers(df, dim), "number", "ashash") == [(n, True) for n in (5, 6, 7, 8)]
    by_prefix = df.withColumn("scope", F.concat(F.lit("10.0.0.0/8_"), "scope"))
    assert rows(scores.prefix_numbers(by_prefix, dim), "number", "ashash") == [(n, False) for n in (5, 6, 7, 8)]
    country = spark.createDataFrame([("AA", 0.0), ("BB", 1.0)], "cc string, hege double")
    known = spark.createDataFrame([], "code string, name string, tartiflette boolean, disco boolean")
    names = spark.createDataFrame([("AA", "Aland"), ("BB", "Beland")], "code string, name string")
    assert rows(scores.countries(country, known, names), "code", "name") == [("AA", "Aland"), ("BB", "Beland")]


def test_no_country_is_left_out_of_the_scores(spark, tmp_path):
    spark.createDataFrame([(1, 7, datetime(2024, 1, 5), 60000.0, "HIGH", "F"), (10, 7, datetime(2024, 1, 5), 9.0, "LOW", "O")],
                          "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz, o_totalprice double, "
                          "o_orderpriority string, o_orderstatus string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(7, 13)], "c_custkey bigint, c_nationkey int").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(13, "X")], "n_nationkey int, n_name string").write.parquet(f"{tmp_path}/nation.parquet")
    found = QUERIES["country_hegemony"](spark, str(tmp_path))
    assert rows(found, "country_id", "asn_id", "hege") == [("CD", 7, 0.1)]
    assert "= 13" not in SQL["country_hegemony"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_origins_that_no_entry_names_are_left_out_before_lookups(spark):
    keys = spark.createDataFrame([("10.0.0.0/24", 1), ("10.0.0.0/24", 2), ("10.0.0.0/24", None)], "prefix string, originasn_id bigint")
    table = spark.createDataFrame([(167772160, 8, 1, "x"), (167772160, 16, 1, "y"), (167772160, 16, None, "z")],
                                  "net bigint, len int, originasn_id bigint, what string")
    at = address(address_part(F.col("prefix")), 4)
    for broadcast_rows in (0, 100):
        found = prefixes.covering(keys, at, F.lit(24), table, 4, ["originasn_id"], broadcast_rows)
        assert rows(found, "originasn_id", "len", "what") == [(1, 8, "x"), (1, 16, "y")]
    assert "LeftSemi" in plan_of(found)


def test_validation_reads_the_scores_once(spark):
    plan = plan_of(QUERIES["rov_status"](spark, SMALL))
    assert "lineitem.parquet" not in plan  # only the written pairs are read again


def test_country_codes_need_no_validation_and_no_peers(spark):
    df = spark.createDataFrame(
        [(0, "10.0.0.0/24_1", 0.5), (0, "10.0.1.0/24_1", 0.0), (0, "11.0.0.0/24_2", 0.5), (10 ** 18, "12.0.0.0/24_2", 0.5),
         (0, "13.0.0.0/8_2", 0.1)], "timestamp bigint, scope string, hege double").withColumn(
        "asn", F.lit("7")).withColumn("nb_peers", F.lit(3))
    geo = spark.createDataFrame([(167772160, 8, "AA"), (167772160, 24, None), (218103808, 16, "BB"), (201326592, 8, "CC")],
                                "net bigint, len int, cc string")
    assert rows(scores.prefix_codes(df, 4, geo), "prefix", "country_id") == [
        ("10.0.0.0/24", "ZZ"), ("11.0.0.0/24", "ZZ"), ("13.0.0.0/8", "BB")]
    roa = spark.createDataFrame([], "net bigint, len int, max_len int, asn bigint, descr string")
    blocks = spark.createDataFrame([], "net bigint, len int, status string")
    asns = spark.createDataFrame([], "lo bigint, hi bigint, status string")
    whole = scores.prefix_hegemony(df, 4, geo, roa, roa, blocks, asns)
    assert rows(whole.select("prefix", "country_id").distinct()) == rows(scores.prefix_codes(df, 4, geo))
    assert "Window" not in plan_of(QUERIES["prefix_countries"](spark, SMALL))


def test_the_longest_prefix_sorts_no_row_per_length(spark):
    table = spark.createDataFrame([(167772160, 8, "b"), (167772160, 8, "a"), (167772160, 16, None), (None, 8, "z")],
                                  "net bigint, len int, cc string")
    ips = spark.createDataFrame([("10.0.0.1",), ("10.1.0.1",), ("11.0.0.1",), ("no",), (None,)], "ip string")
    found = prefixes.best_match(ips, "ip", table, "cc")
    assert rows(found) == [("10.0.0.1", None), ("10.1.0.1", "b")]
    assert "SortAggregate" not in plan_of(found)
