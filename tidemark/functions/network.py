"""Addresses and prefixes as numbers.

IPv4 networks are a BIGINT and a length. IPv6 networks are two BIGINTs, ``high`` and ``low``, each
with its first bit turned over, so that signed numbers stand in the order of the addresses.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidemark.functions.binding import bound

IPV4_TEXT = r"^(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(\.(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$"
WIDTH = {4: 32, 6: 128}
FIRST_BIT = -(1 << 63)


def address_part(prefix: Column) -> Column:
    return F.substring_index(prefix, "/", 1)


def length_part(prefix: Column, af: int = 4) -> Column:
    return F.when(F.instr(prefix, "/") > 0, F.substring_index(prefix, "/", -1).try_cast("int")
                  ).otherwise(F.lit(WIDTH[af]))


def ip_to_long(ip: Column) -> Column:
    """An IPv4 address as a number; null for other text."""
    number = F.aggregate(F.split(ip, r"\."), F.lit(0).cast("bigint"),
                         lambda total, octet: total * 256 + octet.try_cast("bigint"))
    return F.when(ip.rlike(IPV4_TEXT), number)


def long_to_ip(number: Column) -> Column:
    return F.concat_ws(".", *[F.shiftright(number, 8 * i).bitwiseAND(F.lit(255)).cast("string")
                              for i in (3, 2, 1, 0)])


def _groups(half: Column) -> Column:
    return F.when(half == "", F.array().cast("array<string>")).otherwise(F.split(half, ":"))


def _plain_groups(text: Column) -> Column:
    """Write a trailing IPv4 address as two groups."""
    tail = F.regexp_extract(text, r"[0-9.]+$", 0)
    as_groups = bound(ip_to_long(tail), lambda n: F.concat(
        F.lower(F.hex(F.shiftright(n, 16))), F.lit(":"), F.lower(F.hex(n.bitwiseAND(F.lit(65535))))))
    head = F.regexp_extract(text, r"^(.*?)[0-9.]+$", 1)
    return F.when(F.instr(text, ".") > 0, F.concat(head, as_groups)).otherwise(text)


def _all_groups(halves: Column) -> Column:
    """The eight groups of an address split at ``::``, or null if it is none."""
    def filled(left, right):
        return bound(F.lit(8) - F.size(left) - F.size(right), lambda gap: F.when(
            gap >= 1, F.concat(left, F.array_repeat(F.lit("0"), gap.cast("int")), right)))

    both = bound(_groups(F.get(halves, F.lit(0))), lambda left: bound(
        _groups(F.get(halves, F.lit(1))), lambda right: filled(left, right)))
    return F.when(F.size(halves) == 1, _groups(F.get(halves, F.lit(0)))).when(F.size(halves) == 2, both)


def ipv6_longs(ip: Column) -> Column:
    """An IPv6 address as a struct of two BIGINTs; null for other text.

    ``::`` stands for as many zero groups as are missing, and the last two groups may be
    written as an IPv4 address.
    """
    def half(digits, start):
        return F.conv(F.substring(digits, start, 16), 16, -10).cast("bigint").bitwiseXOR(F.lit(FIRST_BIT))

    def longs(groups):
        good = (F.size(groups) == 8) & F.forall(groups, lambda g: g.rlike("^[0-9a-f]{1,4}$"))
        digits = F.array_join(F.transform(groups, lambda g: F.lpad(g, 4, "0")), "")
        return F.when(good, bound(digits, lambda d: F.struct(half(d, 1).alias("high"), half(d, 17).alias("low"))))

    return bound(_plain_groups(F.lower(ip)), lambda text: bound(
        _all_groups(F.split(text, "::")), longs))


def _cut(half: Column, bits: Column) -> Column:
    """The first ``bits`` bits of one half, the others 0; ``bits`` may lie outside 0 to 64."""
    mask = F.call_function("shiftleft", F.lit(-1).cast("bigint"), F.lit(64) - bits)
    plain = half.bitwiseXOR(F.lit(FIRST_BIT))
    return F.when(bits >= 64, half).when(bits <= 0, F.lit(FIRST_BIT)).otherwise(
        plain.bitwiseAND(mask).bitwiseXOR(F.lit(FIRST_BIT)))


def address(ip: Column, af: int) -> Column:
    return ip_to_long(ip) if af == 4 else ipv6_longs(ip)


def truncate(addr: Column, length: Column, af: int) -> Column:
    """The network of ``addr`` at ``length`` bits."""
    if af == 4:
        block = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.lit(32) - length)
        return addr - F.pmod(addr, block)
    return F.when(addr.isNotNull(), F.struct(
        _cut(addr.getField("high"), length).alias("high"), _cut(addr.getField("low"), length - 64).alias("low")))


def _filled(half: Column, bits: Column) -> Column:
    """The first ``bits`` bits of one half, the others 1."""
    mask = F.call_function("shiftleft", F.lit(-1).cast("bigint"), F.lit(64) - bits)
    plain = half.bitwiseXOR(F.lit(FIRST_BIT))
    return F.when(bits >= 64, half).when(bits <= 0, F.lit(-1 - FIRST_BIT)).otherwise(
        plain.bitwiseOR(F.bitwise_not(mask)).bitwiseXOR(F.lit(FIRST_BIT)))


def after(net: Column, length: Column, af: int) -> Column:
    """The first address beyond a network; null beyond the last of all."""
    if af == 4:
        end = net + F.call_function("shiftleft", F.lit(1).cast("bigint"), F.lit(32) - length)
        return F.when(end < 1 << 32, end)
    high, low = _filled(net.getField("high"), length), _filled(net.getField("low"), length - 64)
    one = F.lit(1).cast("bigint")
    stays = F.try_add(low, one).isNotNull()
    end = F.struct(F.when(stays, high).otherwise(F.try_add(high, one)).alias("high"),
                   F.coalesce(F.try_add(low, one), F.lit(FIRST_BIT)).alias("low"))
    return F.when(end.getField("high").isNotNull(), end)
