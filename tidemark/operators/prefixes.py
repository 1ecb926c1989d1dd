"""Prefix lookups by a sorted forward fill.

A table of a counted, bounded size is broadcast. A larger one is flattened into disjoint
ranges; distinct keys and ranges are sorted together, and each key takes the range that began
last (``covering``). Neither way needs a range join or a cross product.

Tables have ``net`` and ``len``, with ``net`` as ``functions.network`` writes it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.network import WIDTH, address, address_part, after, length_part, truncate
from tidemark.session import kept, small_side

# The origin validation states of RFC 6811.
VALID, INVALID, NOT_FOUND = "Valid", "Invalid", "NotFound"
UNKNOWN_COUNTRY = "ZZ"

ASN_BLOCK = 1024
BROADCAST_NETWORKS = 500_000


def prefix_table(df: DataFrame, prefix: str, af: int = 4) -> DataFrame:
    """Replace a text prefix by ``net`` and ``len``."""
    length = length_part(F.col(prefix), af)
    net = truncate(address(address_part(F.col(prefix)), af), length, af)
    return df.select(net.alias("net"), length.alias("len"), *[c for c in df.columns if c != prefix])


def chains(nets: DataFrame, lengths: Sequence[int], af: int, on: Sequence[str]) -> DataFrame:
    """``nets`` (``net, len, *on, _rows``) as disjoint ranges: where each begins, ``_at``, with the
    networks that cover all of it, ``_chain``. A range ends where the next one begins."""
    starts = nets.select(*on, F.col("net").alias("_at"))
    ends = nets.select(*on, after(F.col("net"), F.col("len"), af).alias("_at")).where(F.col("_at").isNotNull())
    points = starts.union(ends).distinct()
    each = points.withColumn("len", F.explode(F.array(*map(F.lit, lengths)))).withColumn(
        "net", truncate(F.col("_at"), F.col("len"), af))
    key = ["net", "len", *on]
    # with the mark both sides are dealt anew, so that a short network that covers many can be split
    met = each.withColumn("_mark", F.xxhash64(*key)).join(nets.withColumn("_mark", F.xxhash64(*key)), ["_mark", *key], "left")
    return met.groupBy(*on, "_at").agg(F.collect_list(
        F.when(F.col("_rows").isNotNull(), F.struct("len", "net", "_rows"))).alias("_chain"))


def covering(keys: DataFrame, addr: Column, longest: Column, table: DataFrame, af: int,
             on: Sequence[str] = (), broadcast_rows: int = BROADCAST_NETWORKS) -> DataFrame:
    """Each key with every table row whose network covers it; keys without one are absent.

    ``on`` names further columns in which key and row must agree. The rows of one network and
    ``on`` go with it as a list, so reduce the table to few of them first.

    The networks are counted first. Up to ``broadcast_rows`` of them are broadcast, and a key
    looks its network up at each length that occurs, without a shuffle. Beyond that the table
    becomes disjoint ranges (``by_ranges``). Both give the same rows.
    """
    rest = [c for c in table.columns if c not in ("net", "len", *on)]
    nets = kept(table.where(F.col("net").isNotNull() & F.col("len").isNotNull()).groupBy("net", "len", *on).agg(
        F.collect_list(F.struct(*rest)).alias("_rows")))
    sizes = {r["len"]: r["count"] for r in nets.groupBy("len").count().collect()}  # at most 129 lengths
    lengths = sorted(sizes)
    if not lengths:
        none = keys.where(F.lit(False))
        return none.join(table, list(on)) if on else none.crossJoin(table.limit(0))
    if on:  # most keys may name nothing that the table names: they are left out before a row per length is made
        keys = keys.join(small_side(nets.select(*on).distinct()), list(on), "left_semi")
    named = [*on, *[k for k in keys.columns if k not in on]]
    if sum(sizes.values()) <= broadcast_rows:
        key = ["net", "len", *on]
        at = keys.withColumn("_at", addr).withColumn("_max", longest).withColumn(
            "len", F.explode(F.array(*map(F.lit, lengths)))).where(F.col("len") <= F.col("_max"))
        met = at.withColumn("net", truncate(F.col("_at"), F.col("len"), af)).join(F.broadcast(nets), key)
        return met.select("net", "len", *named, F.explode("_rows").alias("_row")).select("net", "len", *named, "_row.*")
    met = by_ranges(keys, addr, longest, nets, lengths, af, on)
    each = met.select("_key", "_net", F.explode("_net._rows").alias("_row"))
    return each.select("_net.net", "_net.len", *[F.col("_key")[c].alias(c) for c in named], "_row.*")


def by_ranges(keys: DataFrame, addr: Column, longest: Column, nets: DataFrame, lengths: Sequence[int], af: int,
              on: Sequence[str]) -> DataFrame:
    """``_key, _net``: each key, as a struct, with each network that covers it.

    Disjoint ranges and keys are sorted together. The last range at or before a key is carried
    forward inside each sorted bucket, and from bucket to bucket as one row per bucket. A key
    stays one row, however many lengths there are, and a short network is no join key of keys.
    """
    # kept, so that addresses are parsed once and not again for the bounds of the ranges
    as_keys = kept(keys.select(*on, addr.alias("_at"), F.struct(*keys.columns).alias("_key"), longest.alias("_max")))
    mixed = as_keys.where(F.col("_at").isNotNull()).unionByName(chains(nets, lengths, af, on), allowMissingColumns=True)
    order = [*on, "_at", F.col("_key").isNotNull()]  # a range stands before the keys at its start
    sorted_ = kept(mixed.repartitionByRange(*order).withColumn("_bucket", F.spark_partition_id()))
    of_range = F.when(F.col("_key").isNull(), F.struct(*on, "_chain"))
    last = sorted_.groupBy("_bucket").agg(
        F.max_by(of_range, F.when(F.col("_key").isNull(), F.struct(*on, "_at"))).alias("_range"))
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)  # a row per bucket
    before = last.select("_bucket", F.last("_range", ignorenulls=True).over(earlier).alias("_before"))
    so_far = Window.partitionBy("_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = sorted_.withColumn("_range", F.last(of_range, ignorenulls=True).over(so_far)).where(F.col("_key").isNotNull())
    met = filled.join(before, "_bucket").withColumn("_range", F.coalesce("_range", "_before"))
    for c in on:
        met = met.where(F.col(c) == F.col("_range").getField(c))
    return met.select("_key", F.explode(F.filter(F.col("_range._chain"), lambda n: n["len"] <= F.col("_max"))).alias("_net"))


def best_match(keys: DataFrame, ip: str, table: DataFrame, value: str, af: int = 4) -> DataFrame:
    """``(ip, value)`` by the longest covering prefix, for the distinct ``ip`` of ``keys``.

    The part after a ``/`` does not count, so a prefix is looked up by its address. The longest
    length is found first, a number that is kept up row by row, and the value by its network after
    that; the largest of structs or texts would sort a row for each length of each key.
    """
    distinct = keys.select(ip).distinct().withColumn("_addr", address(address_part(F.col(ip)), af))
    nets = table.where(F.col("net").isNotNull() & F.col("len").isNotNull()).groupBy("net", "len").agg(
        F.max(value).alias(value))  # of equal networks the largest value counts
    nets = small_side(nets, BROADCAST_NETWORKS)
    found = covering(distinct, F.col("_addr"), F.lit(WIDTH[af]), nets.select("net", "len", F.lit(True).alias("_hit")), af)
    best = found.groupBy(ip, "_addr").agg(F.max("len").alias("len"))
    return best.withColumn("net", truncate(F.col("_addr"), F.col("len"), af)).join(nets, ["net", "len"]).select(ip, value)


def longest_prefix(df: DataFrame, ip: str, table: DataFrame, value: str, default=UNKNOWN_COUNTRY,
                   af: int = 4) -> DataFrame:
    """Add ``value`` of the longest prefix that covers ``ip``; ``default`` where there is none."""
    found = best_match(df, ip, table, value, af)
    return df.join(found, ip, "left").withColumn(value, F.coalesce(value, F.lit(default)))


def origin_facts(pairs: DataFrame, roa: DataFrame, extra: Sequence[str] = (), af: int = 4) -> tuple[DataFrame, DataFrame]:
    """What covers the prefixes of distinct ``(prefix, originasn_id)`` pairs, and which pairs are valid.

    Prefixes meet the distinct networks, and pairs the distinct networks of their own
    origin, so a pair has at most one row for each length and longest length allowed,
    however many entries cover a busy prefix.
    """
    text = F.col("prefix")
    key = ["prefix", "originasn_id"]
    at, plen = address(address_part(text), af), F.col("_plen")

    def values(named):
        return [F.max(c).alias(c) for c in named]

    def longest(column):
        return F.max_by(column, F.struct("len", column))

    networks = roa.groupBy("net", "len").agg(F.lit(True).alias("_any"), *values(extra))
    owned = roa.groupBy("net", "len", F.col("asn").cast("bigint").alias("originasn_id"), "max_len").agg(
        F.lit(True).alias("_own"), *values(extra))
    each = pairs.select("prefix").distinct().withColumn("_plen", length_part(text, af))
    any_entry = covering(each, at, plen, networks, af).groupBy("prefix").agg(
        F.max("_any").alias("_covered"), *[longest(c).alias(f"_any_{c}") for c in extra])
    own = covering(pairs.select(*key).withColumn("_plen", length_part(text, af)), at, plen, owned, af, ["originasn_id"])
    valid = own.where(plen <= F.col("max_len")).groupBy(*key).agg(
        F.max("_own").alias("_valid"), *[longest(c).alias(f"_valid_{c}") for c in extra])
    return any_entry, valid


def with_status(rows: DataFrame, any_entry: DataFrame, valid: DataFrame, out: str, extra: Sequence[str] = ()) -> DataFrame:
    """Add ``out`` and the columns of ``extra`` to rows by their ``prefix`` and ``originasn_id``."""
    joined = rows.join(any_entry, "prefix", "left").join(valid, ["prefix", "originasn_id"], "left")
    return joined.select(
        *rows.columns,
        F.when(F.col("_valid"), VALID).when(F.col("_covered"), INVALID).otherwise(NOT_FOUND).alias(out),
        *[F.coalesce(F.when(F.col("_valid"), F.col(f"_valid_{c}")).otherwise(F.col(f"_any_{c}")), F.lit("")).alias(c)
          for c in extra])


def origin_status(pairs: DataFrame, roa: DataFrame, out: str, extra: Sequence[str] = (), af: int = 4) -> DataFrame:
    """Validation of distinct ``(prefix, originasn_id)`` pairs against ``(net, len, max_len, asn)``.

    NotFound without a covering entry; Valid if one has the origin and allows the length;
    Invalid otherwise. Each column named in ``extra`` comes from the longest valid entry,
    or else from the longest covering one.
    """
    pairs = kept(pairs.select("prefix", "originasn_id").distinct())
    return with_status(pairs, *origin_facts(pairs, roa, extra, af), out, extra)


def validate_origin(df: DataFrame, roa: DataFrame, out: str, extra: Sequence[str] = (), af: int = 4) -> DataFrame:
    return df.join(origin_status(df, roa, out, extra, af), ["prefix", "originasn_id"], "left")


def asn_block_status(keys: DataFrame, asn: str, blocks: DataFrame, out: str, default: str = NOT_FOUND) -> DataFrame:
    """Status of each distinct AS number from blocks ``(lo, hi, status)``.

    Blocks and numbers meet in cells of 1,024 numbers, so the join is an equi join and a
    cell holds few of either. The block that starts last wins, of those the largest status.
    """
    width = F.lit(ASN_BLOCK)
    cells = blocks.withColumn(
        "_cell", F.explode(F.sequence(F.floor(F.col("lo") / width), F.floor(F.col("hi") / width))))
    distinct = keys.select(asn).where(F.col(asn).isNotNull()).distinct().withColumn(
        "_cell", F.floor(F.col(asn) / width))
    found = distinct.join(cells, "_cell").where(F.col(asn).between(F.col("lo"), F.col("hi")))
    found = found.groupBy(asn).agg(F.max_by("status", F.struct("lo", "status")).alias(out))
    return distinct.select(asn).join(found, asn, "left").withColumn(out, F.coalesce(out, F.lit(default)))


def delegated(df: DataFrame, prefix_blocks: DataFrame, asn_blocks: DataFrame, af: int = 4) -> DataFrame:
    """Add ``delegated_prefix_status`` and ``delegated_asn_status``."""
    by_prefix = prefix_blocks.withColumnRenamed("status", "delegated_prefix_status")
    out = longest_prefix(df, "prefix", by_prefix, "delegated_prefix_status", NOT_FOUND, af)
    by_asn = asn_block_status(df, "originasn_id", asn_blocks, "delegated_asn_status")
    return out.join(by_asn, "originasn_id", "left")
