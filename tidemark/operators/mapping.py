"""Rows for a fixed table made from messages by a declared mapping."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from tidemark.functions.clock import from_epoch_s
from tidemark.operators.dimensions import lookup_location


@dataclass(frozen=True)
class MapSpec:
    """Which message field fills which column, as what type.

    ``columns``, ``types`` and ``fields`` run in parallel. A type is int, float, str,
    datetime (epoch seconds) or atlas_location (a location name turned into its id).
    """

    topic: str
    table: str
    columns: tuple[str, ...]
    types: tuple[str, ...]
    fields: tuple[str, ...]
    defaults: Mapping[str, object] = field(default_factory=dict)

    def __post_init__(self):
        if not len(self.columns) == len(self.types) == len(self.fields):
            raise ValueError("columns, types and fields must have one length")


def _cast(value: Column, kind: str) -> Column:
    if kind == "int":
        return value.try_cast("bigint")
    if kind == "float":
        return value.try_cast("double")
    if kind == "str":
        return value.cast("string")
    if kind == "datetime":
        return from_epoch_s(value.try_cast("double"))
    if kind == "atlas_location":
        return value.cast("string")
    raise ValueError(f"unknown type {kind}")


def _sources(df: DataFrame, name: str, spec: MapSpec) -> list[Column]:
    """Where a field may come from, first choice first."""
    found = [F.col(name)] if name in df.columns else []
    if "datapoint" in df.columns:
        inner = df.schema["datapoint"].dataType
        if isinstance(inner, StructType) and name in inner.fieldNames():
            found.append(F.col("datapoint").getField(name))
    if name in spec.defaults:
        found.append(F.lit(spec.defaults[name]))
    return found


def map_rows(df: DataFrame, spec: MapSpec, locations: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``(rows, rejects)``.

    A field is taken from the message, else from its ``datapoint``, else from the
    defaults. A message with a missing field, a failed cast or an unknown location is
    rejected whole; ``reason`` names the first such field.
    """
    mapped = df
    reason = F.lit(None).cast("string")
    for i, (name, kind) in reversed(list(enumerate(zip(spec.fields, spec.types)))):
        sources = _sources(df, name, spec)
        present = F.lit(False)
        value = F.lit(None).cast({"int": "bigint", "float": "double", "datetime": "timestamp"}.get(kind, "string"))
        for source in reversed(sources):
            present = present | source.isNotNull()
            value = F.when(source.isNotNull(), _cast(source, kind)).otherwise(value)
        mapped = mapped.withColumn(f"_out{i}", value).withColumn(f"_has{i}", present)
        if kind == "atlas_location":
            mapped = lookup_location(mapped, f"_out{i}", locations, f"_id{i}").drop(f"_out{i}")
            mapped = mapped.withColumnRenamed(f"_id{i}", f"_out{i}")
        reason = (
            F.when(~F.col(f"_has{i}"), F.lit(f"missing {name}"))
            .when(F.col(f"_out{i}").isNull(), F.lit(f"bad {name}"))
            .otherwise(reason)
        )
    mapped = mapped.withColumn("reason", reason)
    rows = mapped.where(F.col("reason").isNull()).select(
        *[F.col(f"_out{i}").alias(c) for i, c in enumerate(spec.columns)])
    rejects = mapped.where(F.col("reason").isNotNull()).select(*df.columns, "reason")
    return rows, rejects
