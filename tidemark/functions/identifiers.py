"""AS numbers, AS sets, scopes, tagged identifiers and measurement endpoints."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidemark.functions.binding import bound

# The type codes of tagged identifiers.
AS, IP, EXCHANGE, MEMBER = "AS", "IP", "IX", "MB"


def asn(text: Column) -> Column:
    """The number in ``text``, or null where it is none."""
    return F.trim(text.cast("string")).try_cast("bigint")


def valid_asn(text: Column) -> Column:
    return asn(text).isNotNull()


def as_set_members(text: Column) -> Column:
    """The members of ``{a,b}`` as an array; a plain number is an array of itself."""
    return F.split(F.translate(text.cast("string"), "{}", ""), ",")


def global_scope(scope: Column) -> Column:
    """The number of a scope; the whole graph is written both as -1 and as 0, here 0."""
    number = asn(scope)
    return F.when(number == -1, 0).otherwise(number)


def split_scope(scope: Column) -> Column:
    """``prefix_origin`` cut at its first underscore."""
    parts = F.split(scope, "_", 2)
    return F.struct(F.get(parts, F.lit(0)).alias("prefix"),
                    F.coalesce(F.get(parts, F.lit(1)), F.lit("")).alias("origin"))


def tr_identifier(text: Column, af: int) -> Column:
    """``(type, name, af)`` of a tagged identifier, or null where it is invalid.

    A tag is taken off as a set of characters, so ``as|sa1`` is named ``1``. An exchange
    member whose AS is 0 is invalid.
    """
    def named(kind, name):
        return F.struct(F.lit(kind).alias("type"), name.alias("name"), F.lit(af).alias("af"))

    def member(parts):
        port, owner = F.ltrim(parts[0], F.lit("ix|")), F.ltrim(parts[1], F.lit("as|"))
        return F.when((F.size(parts) == 2) & (owner != "0"), named(MEMBER, F.concat_ws(";", port, owner)))

    def parsed(t):
        return (
            F.when(t.startswith("as|"), named(AS, F.ltrim(t, F.lit("as|"))))
            .when(t.startswith("ip|"), named(IP, F.ltrim(t, F.lit("ip|"))))
            .when(~t.startswith("ix|"), F.lit(None))
            .when(F.instr(t, ";") > 0, bound(F.split(t, ";"), member))
            .otherwise(named(EXCHANGE, F.ltrim(t, F.lit("ix|"))))
        )

    return bound(text, parsed)


def with_family(location: Column) -> Column:
    """A location name always ends in its address family; v4 is assumed."""
    return F.when(F.right(location, F.lit(2)).isin("v4", "v6"), location).otherwise(
        F.concat(location, F.lit("v4")))


def parse_location(location: Column) -> Column:
    """``(type, name, af)`` of a location such as ``AS123v6`` or ``CTParis, FRv4``."""
    full = with_family(location)
    return F.struct(
        F.substring(full, 1, 2).alias("type"),
        F.substring(full, F.lit(3), F.greatest(F.length(full) - 4, F.lit(0))).alias("name"),
        F.right(full, F.lit(1)).cast("int").alias("af"),
    )


def location_name(kind: Column, name: Column, af: Column) -> Column:
    return F.concat(kind, name, F.lit("v"), af.cast("string"))


def encode_key(number: Column) -> Column:
    """A message key: the number in eight bytes, big end first."""
    return F.unhex(F.lpad(F.hex(number.cast("bigint")), 16, "0"))
