import ipaddress
import random

from pyspark.sql import functions as F

from conftest import rows
from tidemark import functions as fn
from tidemark.functions import network
from tidemark.operators import hegemony


def one(spark, values, fn_):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(values)], "i int, x string")
    return [r.y for r in df.select("i", fn_(F.col("x")).alias("y")).orderBy("i").collect()]


def test_parse_ts(spark):
    got = one(spark, ["1609459200", "1609459200000", "2021-01-01T00:00", "123", "soon", "2021-13-01T00:00"], fn.parse_ts)
    assert got == [1609459200000, 1609459200000, 1609459200000, None, None, None]


def test_valid_asn(spark):
    assert one(spark, ["12", " 12 ", "{1,2}", "AS5", "", "-1", None], fn.valid_asn) == [
        True, True, False, False, False, True, False]


def test_as_sets(spark):
    df = spark.createDataFrame([("{64500,64501}",), ("7",), ("{1,x}",)], "o string")
    assert rows(hegemony.expand_as_set(df, "o")) == [(1,), (7,), (64500,), (64501,)]


def test_split_scope(spark):
    got = one(spark, ["10.0.0.0/24_{64500,64501}", "10.0.0.0/24_5_6", "plain"], fn.split_scope)
    assert [tuple(x) for x in got] == [
        ("10.0.0.0/24", "{64500,64501}"), ("10.0.0.0/24", "5_6"), ("plain", "")]


def test_tagged_identifiers(spark):
    got = one(spark, ["as|1", "ip|::1", "ix|12", "ix|12;as|7", "ix|12;as|0", "zz|1", "ix|1;as|2;as|3"],
              lambda c: fn.tr_identifier(c, 4))
    assert [x and tuple(x) for x in got] == [
        ("AS", "1", 4), ("IP", "::1", 4), ("IX", "12", 4), ("MB", "12;7", 4), None, None, None]


def test_locations(spark):
    got = one(spark, ["AS123", "AS123v6", "CTParis, FRv4"], fn.parse_location)
    assert [tuple(x) for x in got] == [("AS", "123", 4), ("AS", "123", 6), ("CT", "Paris, FR", 4)]


def test_keys_and_times(spark):
    assert one(spark, ["1", "258", "-1"], lambda c: F.hex(fn.encode_key(c.cast("bigint")))) == [
        "0000000000000001", "0000000000000102", "FFFFFFFFFFFFFFFF"]
    assert one(spark, ["1.9999", "12.5"], lambda c: fn.epoch_ms(c.cast("double"))) == [1999, 12500]


def test_ipv4(spark):
    texts = ["0.0.0.0", "10.1.2.3", "255.255.255.255", "256.1.1.1", "1.2.3", "a.b.c.d", "", None]
    assert one(spark, texts, fn.ip_to_long) == [0, 167838211, 4294967295, None, None, None, None, None]


def test_ipv6_against_ipaddress(spark):
    random.seed(1)
    good = ["::", "::1", "2001:db8::", "2001:DB8::8:800:200c:417a", "1:2:3:4:5:6:7:8", "::ffff:10.1.2.3",
            "1::8", "1:2:3:4:5:6:7::", "fe80::1:0:0:1"]
    for _ in range(40):
        good.append(str(ipaddress.IPv6Address(random.getrandbits(128) & random.getrandbits(128))))
        good.append(ipaddress.IPv6Address(random.getrandbits(64) << 40).exploded)
    bad = ["1:2:3", "1::2::3", "12345::", "g::", "10.0.0.1", "1:2:3:4:5:6:7:8:9", "", ":", "1:2:3:4:5:6:7:8::", None]
    half = 1 << 63
    want = [tuple(h - half for h in divmod(int(ipaddress.IPv6Address(x)), 1 << 64)) for x in good]
    assert one(spark, good + bad, network.ipv6_longs) == [*want, *[None] * len(bad)]


def test_ipv6_networks_against_ipaddress(spark):
    random.seed(2)
    cases = [(random.getrandbits(128), n) for n in (0, 1, 2, 31, 63, 64, 65, 100, 127, 128) for _ in range(6)]
    cases += [((1 << 128) - 1, n) for n in (0, 1, 64, 65, 128)] + [((1 << 64) - 1, 128), ((1 << 64) - 1, 64)]
    half = 1 << 63

    def pair(x):
        return tuple(h - half for h in divmod(x, 1 << 64)) if x < 1 << 128 else None

    want = []
    for x, n in cases:
        net = x >> (128 - n) << (128 - n)
        want.append((pair(net), pair(net + (1 << (128 - n)))))
    df = spark.createDataFrame([(i, str(ipaddress.IPv6Address(x)), n) for i, (x, n) in enumerate(cases)],
                               "i int, ip string, n int")
    net = network.truncate(network.ipv6_longs(F.col("ip")), F.col("n"), 6)
    got = df.select("i", net.alias("net"), network.after(net, F.col("n"), 6).alias("end")).orderBy("i").collect()
    assert [(tuple(r["net"]), r["end"] and tuple(r["end"])) for r in got] == want
