"""The declared mappings of alarm and rank topics to their tables."""

from __future__ import annotations

from tidemark.operators.mapping import MapSpec

# Table layouts, topic names and defaults.
SCORE_ALARM_COLUMNS = ("timebin", "deviation", "af", "asn_id", "originasn_id")
SCORE_ALARM_TYPES = ("datetime", "float", "int", "int", "int")
SCORE_ALARM_FIELDS = ("timestamp", "deviation", "af", "asn", "scope")

DELAY_ALARM_COLUMNS = ("timebin", "deviation", "startpoint_id", "endpoint_id")
DELAY_ALARM_TYPES = ("datetime", "float", "atlas_location", "atlas_location")
DELAY_ALARM_FIELDS = ("ts", "deviation", "startpoint", "endpoint")

RANK_COLUMNS = ("timebin", "metric", "rank", "af", "mean", "asn_id")
RANK_TYPES = ("datetime", "str", "int", "int", "float", "int")
RANK_FIELDS = ("timestamp", "metric", "rank", "af", "mean", "asn")

METRICS = ("as_path_length", "ip_hops", "rtt")
FAMILIES = (4, 6)


def score_alarms(af: int) -> MapSpec:
    return MapSpec(f"hegemony_anomalies_ipv{af}", "hegemony_alarms", SCORE_ALARM_COLUMNS, SCORE_ALARM_TYPES,
                   SCORE_ALARM_FIELDS, {"af": af})


def delay_alarms() -> MapSpec:
    return MapSpec("diffrtt_anomalies", "atlas_delay_alarms", DELAY_ALARM_COLUMNS, DELAY_ALARM_TYPES,
                   DELAY_ALARM_FIELDS)


def rank_selection(af: int, metric: str) -> MapSpec:
    return MapSpec(f"traceroutev{af}_topology_as_rank_weekly_{metric}", "atlas_selection", RANK_COLUMNS, RANK_TYPES,
                   RANK_FIELDS, {"af": af, "metric": metric})


def rank_deployment(af: int, metric: str) -> MapSpec:
    return MapSpec(f"traceroutev{af}_topology_candidates_weekly_{metric}", "atlas_deployment",
                   (*RANK_COLUMNS, "nbsamples"), (*RANK_TYPES, "int"), (*RANK_FIELDS, "num_samples"),
                   {"af": af, "metric": metric})


def all_specs() -> list[MapSpec]:
    """Three alarm tables and twelve rank topics."""
    ranks = [make(af, metric) for make in (rank_selection, rank_deployment) for af in FAMILIES for metric in METRICS]
    return [score_alarms(4), score_alarms(6), delay_alarms(), *ranks]
