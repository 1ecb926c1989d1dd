"""Score tables per time bin: AS, prefix, country and traceroute scores, and delays."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.clock import from_epoch_s
from tidemark.functions.identifiers import asn as asn_number, parse_location, split_scope, tr_identifier
from tidemark.functions.network import WIDTH, address, address_part, length_part
from tidemark.operators import dimensions, hegemony, prefixes
from tidemark.session import kept, small_side

TR_SHIFT_S = 21 * 24 * 3600  # Fixed value: traceroute scores are stamped three weeks early.

PREFIX_COLUMNS = [
    "timebin", "prefix", "originasn_id", "asn_id", "country_id", "hege", "rpki_status", "irr_status",
    "delegated_prefix_status", "delegated_asn_status", "af", "descr", "visibility", "moas",
]


def as_hegemony(df: DataFrame, af: int, start: int | None = None, end: int | None = None,
                time_col: str = "timestamp") -> tuple[DataFrame, DataFrame]:
    """``(scores, cones)``. Zero scores count for the cones but are not stored."""
    rows = hegemony.score_rows(df, time_col, start, end)
    stored = rows.where(F.col("hege") != 0).withColumn("af", F.lit(af))
    return stored, hegemony.cone(rows, af)


def as_numbers(df: DataFrame, asns: DataFrame, start: int | None = None, end: int | None = None,
               time_col: str = "timestamp") -> DataFrame:
    """The AS numbers with all that AS scores name, also those that only ever score zero."""
    return dimensions.register_asns(asns, hegemony.score_rows(df, time_col, start, end), ["originasn_id", "asn_id"])


def prefix_numbers(df: DataFrame, asns: DataFrame, start: int | None = None, end: int | None = None) -> DataFrame:
    """The AS numbers with all that prefix scores name, zero scores included; flags stay."""
    return dimensions.register_asns(asns, prefix_rows(df, start, end), ["originasn_id", "asn_id"], ashash=False)


def prefix_countries(rows: DataFrame, known: DataFrame, names: DataFrame) -> DataFrame:
    """The countries with those of stored prefix scores, the unknown one too."""
    special = dimensions.REGION_NAMES | dimensions.UNKNOWN_COUNTRY
    return dimensions.register_countries(known, rows.select(F.col("country_id").alias("code")), names, special)


def countries(df: DataFrame, known: DataFrame, names: DataFrame) -> DataFrame:
    """The countries with all that country scores name, also those that only ever score zero."""
    return dimensions.register_countries(known, df.select(F.col("cc").alias("code")), names)


def prefix_rows(df: DataFrame, start: int | None = None, end: int | None = None) -> DataFrame:
    """One typed row per origin of a prefix score, zero scores included."""
    scope = split_scope(F.col("scope"))
    typed = hegemony.payload_range(df, "timestamp", start, end).select(
        from_epoch_s(F.col("timestamp")).alias("timebin"), scope.getField("prefix").alias("prefix"),
        scope.getField("origin").alias("_origin"), asn_number(F.col("asn")).alias("asn_id"),
        F.col("hege").cast("double").alias("hege"), F.col("nb_peers").cast("int").alias("nb_peers"))
    each = hegemony.expand_as_set(typed, "_origin", "originasn_id").drop("_origin")
    return each.withColumn("originasn_id", F.when(F.col("originasn_id") == -1, 0).otherwise(F.col("originasn_id")))


def _entries(kind: str, table: DataFrame, value: str | None = None, origins: bool = False) -> DataFrame:
    null = F.lit(None)
    return table.select(
        "net", F.col("len").cast("int").alias("len"), F.lit(kind).alias("kind"),
        (F.col(value) if value else null).cast("string").alias("value"),
        (F.col("max_len") if origins else null).cast("int").alias("max_len"),
        (F.col("asn") if origins else null).cast("bigint").alias("asn"))


def prefix_facts(pairs: DataFrame, geo: DataFrame, rpki: DataFrame, irr: DataFrame, prefix_blocks: DataFrame,
                 af: int) -> tuple[DataFrame, DataFrame]:
    """What the tables say of each prefix of ``pairs`` (``prefix, originasn_id``), and of its valid origins.

    The networks of each prefix meet those of all four tables in one join, a row for each
    network and table, and the networks of each pair those entries that name its origin.
    Country and delegation go by the longest network that covers the prefix's address,
    validation by those that cover the prefix.
    """
    entries = (
        _entries("geo", geo, "cc")
        .unionByName(_entries("delegated", prefix_blocks, "status"))
        .unionByName(_entries("rpki", rpki, origins=True))
        .unionByName(_entries("irr", irr, "descr", origins=True))
    )
    text, kind = F.col("prefix"), F.col("kind")
    at = address(address_part(text), af)
    networks = entries.groupBy("net", "len", "kind").agg(F.max("value").alias("value"))
    each = pairs.select("prefix").distinct().withColumn("_plen", length_part(text, af))
    found = prefixes.covering(each, at, F.lit(WIDTH[af]), networks, af)
    found = found.where(kind.isin("geo", "delegated") | (F.col("len") <= F.col("_plen")))

    def longest(which: str):
        return F.max_by("value", F.when(kind == which, F.struct("len", "value")))

    by_prefix = found.groupBy("prefix").agg(
        longest("geo").alias("_cc"), longest("delegated").alias("_delegated"), longest("irr").alias("_any_descr"),
        F.max(kind == "rpki").alias("_rpki"), F.max(kind == "irr").alias("_irr"))
    owned = entries.where(kind.isin("rpki", "irr")).groupBy(
        "net", "len", F.col("asn").alias("originasn_id"), "kind", "max_len").agg(F.max("value").alias("value"))
    own = prefixes.covering(pairs.withColumn("_plen", length_part(text, af)), at, F.col("_plen"), owned, af, ["originasn_id"])
    by_origin = own.where(F.col("_plen") <= F.col("max_len")).groupBy("prefix", "originasn_id").agg(
        F.max(kind == "rpki").alias("_rpki_ok"), F.max(kind == "irr").alias("_irr_ok"), longest("irr").alias("_descr"))
    return by_prefix, by_origin


def _status(covered: str, ok: str) -> Column:
    return (F.when(F.col(ok), prefixes.VALID).when(F.col(covered), prefixes.INVALID)
            .otherwise(prefixes.NOT_FOUND))


def prefix_hegemony(df: DataFrame, af: int, geo: DataFrame, rpki: DataFrame, irr: DataFrame,
                    prefix_blocks: DataFrame, asn_blocks: DataFrame, start: int | None = None,
                    end: int | None = None) -> DataFrame:
    """Prefix scores with country, validation, delegation, visibility and multiple origins.

    Origins and peers are taken over all rows of a bin, zero scores included. One pass
    reduces the rows to one per bin, prefix and origin, the only table that is written; the
    peers, the pairs to look up and all that depends on them come from it. How small sides
    are joined is left to adaptive execution, which goes by their bytes.
    """
    rows = prefix_rows(df, start, end)
    stored = rows.where(F.col("hege") != 0)
    seen = kept(rows.groupBy("timebin", "prefix", "originasn_id").agg(F.max("nb_peers").alias("_most")))
    bins = seen.groupBy("timebin", "prefix").agg(
        (F.min("originasn_id") != F.max("originasn_id")).alias("moas"), F.max("_most").alias("_most"))
    peers = hegemony.peer_max(seen.select("timebin", F.col("_most").alias("nb_peers")))
    pairs = seen.select("prefix", "originasn_id").distinct()
    by_prefix, by_origin = prefix_facts(pairs, geo, rpki, irr, prefix_blocks, af)
    by_asn = prefixes.asn_block_status(seen, "originasn_id", asn_blocks, "delegated_asn_status")
    per_bin = bins.drop("_most").join(peers, "timebin").join(by_prefix, "prefix", "left")
    return (
        stored.join(per_bin, ["timebin", "prefix"])
        .join(by_origin, ["prefix", "originasn_id"], "left")
        .join(by_asn, "originasn_id", "left")
        .select(
            "timebin", "prefix", "originasn_id", "asn_id",
            F.coalesce("_cc", F.lit(prefixes.UNKNOWN_COUNTRY)).alias("country_id"), "hege",
            _status("_rpki", "_rpki_ok").alias("rpki_status"), _status("_irr", "_irr_ok").alias("irr_status"),
            F.coalesce("_delegated", F.lit(prefixes.NOT_FOUND)).alias("delegated_prefix_status"),
            F.coalesce("delegated_asn_status", F.lit(prefixes.NOT_FOUND)).alias("delegated_asn_status"),
            F.lit(af).alias("af"),
            F.coalesce(F.when(F.col("_irr_ok"), F.col("_descr")).otherwise(F.col("_any_descr")), F.lit("")
                       ).alias("descr"),
            hegemony.visibility(F.col("nb_peers"), F.col("peer_max")).alias("visibility"), "moas")
        .select(*PREFIX_COLUMNS)
    )


def prefix_codes(df: DataFrame, af: int, geo: DataFrame, start: int | None = None, end: int | None = None) -> DataFrame:
    """``prefix, country_id`` of each prefix that ``prefix_hegemony`` stores, looked up once and without its other columns."""
    stored = prefix_rows(df, start, end).where((F.col("hege") != 0) & F.col("timebin").isNotNull() & F.col("prefix").isNotNull())
    table = geo.select("net", "len", F.col("cc").cast("string").alias("country_id"))
    return prefixes.longest_prefix(stored.select("prefix").distinct(), "prefix", table, "country_id", af=af)


def country_hegemony(df: DataFrame, af: int) -> DataFrame:
    return df.where(F.col("hege") != 0).select(
        from_epoch_s(F.col("ts")).alias("timebin"), F.col("cc").alias("country_id"),
        asn_number(F.col("asn")).alias("asn_id"), F.col("hege").cast("double").alias("hege"),
        F.lit(af).alias("af"), F.col("original_weight").alias("weight"),
        F.lower("weight").alias("weightscheme"), F.col("transit_only").alias("transitonly"))


def endpoint_texts(rows: DataFrame, columns: Sequence[str], parse: Callable[[Column], Column]) -> DataFrame:
    """The distinct texts of some columns with their ``type``, ``name`` and ``af``.

    Texts that cannot be parsed are left out. Only distinct texts are parsed.
    """
    texts = rows.select(F.explode(F.array(*columns)).alias("text")).distinct()
    parsed = texts.withColumn("_k", parse(F.col("text")))
    return parsed.where(F.col("_k").isNotNull()).select("text", "_k.*")


def with_ids(rows: DataFrame, dim: DataFrame, ids: Mapping[str, str], parse: Callable[[Column], Column],
             may_fail: bool = False) -> tuple[DataFrame, DataFrame]:
    """Register the endpoints named in ``ids`` (text column -> id column) and look them up.

    Returns the rows with both ids and the dimension. Rows meet their ids by text, one
    string key per endpoint. Where ``parse`` may fail, rows with an invalid endpoint are
    left out and do not register the other one.
    """
    texts = kept(endpoint_texts(rows, list(ids), parse))
    if may_fail:
        valid = small_side(texts.select("text"))
        good = rows
        for text in ids:
            good = good.join(valid.select(F.col("text").alias(text)), text, "left_semi")
        used = good.select(F.explode(F.array(*ids)).alias("text")).distinct()
        texts = kept(texts.join(used, "text", "left_semi"))
    full = kept(dimensions.register(dim, texts, ["type", "name", "af"]))
    known = small_side(texts.join(full, ["type", "name", "af"]).select("text", "id"))
    for text, out in ids.items():
        rows = rows.join(known.select(F.col("text").alias(text), F.col("id").alias(out)), text)
    return rows, full


def tr_hegemony(df: DataFrame, af: int, dim: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(rows, identifiers)`` of traceroute scores with enough peers. Zero scores are kept."""
    enough = df.where(F.col("nb_peers") >= hegemony.MIN_SAMPLES)
    ids = {"scope": "origin_id", "asn": "dependency_id"}
    rows, full = with_ids(enough, dim, ids, lambda text: tr_identifier(text, af), may_fail=True)
    return rows.select(
        from_epoch_s(F.col("timestamp") + TR_SHIFT_S).alias("timebin"), "origin_id", "dependency_id",
        F.col("hege").cast("double").alias("hege"), F.lit(af).alias("af"), F.col("nb_peers").alias("nbsamples")), full


def network_delay(df: DataFrame, dim: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(rows, locations)``."""
    rows, full = with_ids(df, dim, {"startpoint": "startpoint_id", "endpoint": "endpoint_id"}, parse_location)
    return rows.select(
        from_epoch_s(F.col("ts")).alias("timebin"), "startpoint_id", "endpoint_id", "median",
        F.col("nb_tracks").alias("nbtracks"), F.col("nb_probes").alias("nbprobes"), "entropy",
        F.col("hop").cast("int").alias("hop"), F.col("nb_real_rtts").alias("nbrealrtts")), full
