"""Positions inside groups of any size.

``row_number`` alone sorts a whole group in one task. Here a group is cut into buckets
that follow the wanted order; rows are numbered inside their bucket, and the number of
rows in earlier buckets is added. Only the bucket counts, one row each, are summed per
group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def earlier_buckets(counts: DataFrame, group: Sequence[str], count: str = "_count") -> DataFrame:
    """For each ``(group, _bucket)`` the number of rows in the buckets before it."""
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(*group, "_bucket", F.coalesce(F.sum(count).over(before), F.lit(0)).alias("_before"))


def numbered(df: DataFrame, group: Sequence[str], bucket: Column, order: Sequence[Column | str],
             name: str) -> DataFrame:
    """Add ``name``: the row's 0-based position in its group.

    Buckets come first in the order and ``order`` decides within a bucket, so the whole
    order is ``(bucket, *order)``. Pick the bucket so that a bucket fits in a task.
    """
    cut = df.withColumn("_bucket", bucket)
    counts = cut.groupBy(*group, "_bucket").agg(F.count(F.lit(1)).alias("_count"))
    inside = Window.partitionBy(*group, "_bucket").orderBy(*order)
    return (
        cut.withColumn("_inside", F.row_number().over(inside) - 1)
        .join(earlier_buckets(counts, group), [*group, "_bucket"])
        .withColumn(name, (F.col("_before") + F.col("_inside")).cast("bigint"))
        .select(*df.columns, name)
    )


def key_bucket(*keys: str) -> Column:
    """4,096 even buckets for rows that are distinct in ``keys``."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return F.substring(F.md5(text), 1, 3)
