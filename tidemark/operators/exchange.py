"""Exchange points: prefixes joined to their exchange, and member ports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

PROTOCOLS = ("IPv4", "IPv6")  # Fixed values.


def read_ok(df: DataFrame) -> DataFrame:
    return df.where(F.col("status") == "ok")


def keep_first(df: DataFrame, ids: str | Sequence[str], pos: str) -> DataFrame:
    """The row with the lowest ``pos`` of each id."""
    ids = [ids] if isinstance(ids, str) else list(ids)
    rest = [c for c in df.columns if c not in ids]
    return df.groupBy(*ids).agg(F.min_by(F.struct(*rest), pos).alias("_first")).select(*ids, "_first.*")


def netixlan_project(df: DataFrame) -> DataFrame:
    return df.select("ix_id", "name", F.col("id").alias("netixlan_id"), "asn", "ipaddr4", "ipaddr6")


def ix_enrich(ix: DataFrame, ixlan: DataFrame, ixpfx: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(rows, rejects)``: prefixes with their exchange, and those that have none.

    A reject's ``reason`` is the first check it fails: protocol, ixlan, ix.
    """
    lan = ixlan.select(F.col("id").alias("ixlan_id"), F.col("ix_id"), F.lit(True).alias("_lan"))
    point = ix.select(F.col("id").alias("ix_id"), "name", "name_long", "country", F.lit(True).alias("_ix"))
    joined = (
        ixpfx.withColumnRenamed("id", "ixpfx_id")
        .join(lan, "ixlan_id", "left")
        .join(point, "ix_id", "left")
        .withColumn("reason", F.when(~F.coalesce(F.col("protocol").isin(*PROTOCOLS), F.lit(False)), "protocol")
                    .when(F.col("_lan").isNull(), "ixlan")
                    .when(F.col("_ix").isNull(), "ix"))
    )
    rows = joined.where(F.col("reason").isNull()).select(
        "ix_id", "name", "name_long", "country", "ixlan_id", "ixpfx_id", "protocol", "prefix")
    rejects = joined.where(F.col("reason").isNotNull()).select("ixpfx_id", "ixlan_id", "protocol", "prefix", "reason")
    return rows, rejects
