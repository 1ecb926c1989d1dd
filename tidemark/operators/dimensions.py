"""Dimension tables: find natural keys that are new, number them and look ids up."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.identifiers import location_name, with_family
from tidemark.operators.numbering import key_bucket, numbered
from tidemark.session import kept

# Codes that are not countries, and the code of an unknown one.
REGION_NAMES = {"EU": "European Union", "AP": "Asia-Pacific"}
UNKNOWN_COUNTRY = {"ZZ": "Unknown"}


def new_keys(dim: DataFrame, keys: DataFrame, natural: Sequence[str]) -> DataFrame:
    """The distinct keys that ``dim`` lacks; a key with a null part is none."""
    known = keys.select(*natural).dropna().distinct()
    return known.join(dim.select(*natural), list(natural), "left_anti")


def register(dim: DataFrame, keys: DataFrame, natural: Sequence[str]) -> DataFrame:
    """The dimension with a row and a fresh ``id`` for each key it lacked.

    Only the new keys are numbered, in hash buckets, so a first load of many keys is
    spread over the cluster. They are kept, so the pass over ``keys`` runs once however
    often the result is used. Existing ids never change.
    """
    fresh = numbered(kept(new_keys(dim, keys, natural)), [], key_bucket(*natural), list(natural), "_at")
    top = F.coalesce(dim.agg(F.max("id").alias("top")).scalar(), F.lit(0))
    added = fresh.select((top + 1 + F.col("_at")).cast("bigint").alias("id"), *natural)
    return dim.select(F.col("id").cast("bigint").alias("id"), *natural).unionByName(added)


def register_asns(dim: DataFrame, rows: DataFrame, columns: Sequence[str], ashash: bool = True) -> DataFrame:
    """AS numbers seen in ``columns`` as dimension rows.

    With ``ashash`` the flag is set on new and existing numbers; without it new numbers
    get false and existing rows stay as they are.
    """
    seen = rows.select(F.explode(F.array(*[F.col(c).cast("bigint") for c in columns])).alias("number"))
    seen = seen.where(F.col("number").isNotNull()).distinct().withColumn("_seen", F.lit(True))
    flag = F.coalesce(F.col("ashash"), F.lit(False))
    if ashash:
        flag = flag | F.coalesce(F.col("_seen"), F.lit(False))
    return dim.join(seen, "number", "full").select(
        "number", F.coalesce("name", F.lit("")).alias("name"),
        F.coalesce("tartiflette", F.lit(False)).alias("tartiflette"),
        F.coalesce("disco", F.lit(False)).alias("disco"), flag.alias("ashash"))


def register_countries(dim: DataFrame, codes: DataFrame, names: DataFrame,
                       special: Mapping[str, str] = REGION_NAMES) -> DataFrame:
    """Country codes as dimension rows; ``names`` is a table ``(code, name)``.

    A code without a name is kept under its code, with ``known`` false.
    """
    special_name = F.lit(None).cast("string")
    for code, name in special.items():
        special_name = F.when(F.col("code") == code, name).otherwise(special_name)
    fresh = new_keys(dim, codes, ["code"]).join(names.select("code", F.col("name").alias("_name")), "code", "left")
    name = F.coalesce(special_name, "_name")
    added = fresh.select(
        "code", F.coalesce(name, "code").alias("name"), F.lit(False).alias("tartiflette"),
        F.lit(False).alias("disco"), name.isNotNull().alias("known"))
    return dim.withColumn("known", F.lit(True)).unionByName(added)


def lookup_location(df: DataFrame, column: str, dim: DataFrame, out: str) -> DataFrame:
    """Add the id of a location written as text; null where it is unknown."""
    ids = dim.select(location_name(F.col("type"), F.col("name"), F.col("af")).alias("_loc"),
                     F.col("id").alias(out))
    return df.join(ids, with_family(F.col(column)) == F.col("_loc"), "left").drop("_loc")
