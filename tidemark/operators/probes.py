"""Probe archive: latest record per probe, defaults and filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

EARTH_RADIUS_KM = 6371.0
NEAR_KM = 50.0


def latest_snapshot(df: DataFrame, ids: str,
                    order: Sequence[str] = ("timestamp", "partition", "offset")) -> DataFrame:
    """The last record of each id by those columns of ``order`` that there are.

    Offsets alone are no order across partitions.
    """
    rest = [c for c in df.columns if c != ids]
    by = F.struct(*[c for c in order if c in df.columns])
    return df.groupBy(ids).agg(F.max_by(F.struct(*rest), by).alias("_last")).select(ids, "_last.*")


def probe_defaults(df: DataFrame) -> DataFrame:
    """Empty text for missing addresses, ``[0, 0]`` for a missing place.

    ``geometry`` becomes the array ``coordinates``, longitude first.
    """
    place = F.col("geometry.coordinates")
    return df.select(
        *[c for c in df.columns if c not in ("address_v4", "prefix_v4", "geometry")],
        F.coalesce("address_v4", F.lit("")).alias("address_v4"),
        F.coalesce("prefix_v4", F.lit("")).alias("prefix_v4"),
        F.when(F.get(place, F.lit(0)).isNotNull(), place)
        .otherwise(F.array(F.lit(0.0), F.lit(0.0))).alias("coordinates"))


def haversine_km(lon: Column, lat: Column, to_lon: float, to_lat: float) -> Column:
    dlat, dlon = F.radians(lat - to_lat) / 2, F.radians(lon - to_lon) / 2
    a = F.pow(F.sin(dlat), 2) + F.cos(F.radians(lat)) * F.cos(F.radians(F.lit(to_lat))) * F.pow(F.sin(dlon), 2)
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def filter_probes(df: DataFrame, asns: Sequence[int] = (), countries: Sequence[str] = (),
                  near: Sequence[tuple[float, float]] = (), km: float = NEAR_KM, start=None, end=None) -> DataFrame:
    """Probes by AS, country, nearness to one of some ``(lon, lat)`` points, and time."""
    if asns:
        df = df.where(F.col("asn_v4").isin(*asns))
    if countries:
        df = df.where(F.col("country_code").isin(*countries))
    if near:
        lon, lat = F.get("coordinates", F.lit(0)), F.get("coordinates", F.lit(1))
        close = F.lit(False)
        for to_lon, to_lat in near:
            close = close | (haversine_km(lon, lat, to_lon, to_lat) <= km)
        df = df.where(close)
    if start is not None:
        df = df.where(F.col("timestamp") >= F.lit(start).cast("timestamp"))
    if end is not None:
        df = df.where(F.col("timestamp") < F.lit(end).cast("timestamp"))
    return df
