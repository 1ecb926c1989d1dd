"""Schemas of topic values, as DDL. Times named timestamp or ts are epoch seconds."""

LOG = ("topic STRING, partition INT, offset BIGINT, key BINARY, value {value}, timestamp TIMESTAMP, "
       "timestampType INT, headers ARRAY<STRUCT<key: STRING, value: BINARY>>")

SCORE = "timestamp BIGINT, scope STRING, asn STRING, hege DOUBLE"
SCORE_OLD = "ts BIGINT, scope STRING, asn STRING, hege DOUBLE"
SCORE_BY_SCOPE = "scope STRING, scope_hegemony MAP<STRING, DOUBLE>"
PREFIX_SCORE = "timestamp BIGINT, scope STRING, asn STRING, hege DOUBLE, nb_peers INT"
COUNTRY_SCORE = ("ts BIGINT, cc STRING, asn STRING, hege DOUBLE, original_weight DOUBLE, weight STRING, "
                 "transit_only BOOLEAN")
TRACEROUTE_SCORE = "timestamp BIGINT, scope STRING, asn STRING, hege DOUBLE, nb_peers INT"
DELAY = ("ts BIGINT, startpoint STRING, endpoint STRING, median DOUBLE, nb_tracks INT, nb_probes INT, "
         "entropy DOUBLE, hop INT, nb_real_rtts INT")
RANK = "timestamp BIGINT, rank INT, mean DOUBLE, asn BIGINT, num_samples INT"
BURST = ("streamtype STRING, streamname STRING, starttime BIGINT, level DOUBLE, totalprobes INT, "
         "probelist MAP<BIGINT, BIGINT>")
RECONNECT = ("streamtype STRING, streamname STRING, starttime BIGINT, endtime BIGINT, "
             "reconnectedprobes MAP<BIGINT, BIGINT>")
PROBE = ("id BIGINT, address_v4 STRING, prefix_v4 STRING, "
         "geometry STRUCT<coordinates: ARRAY<DOUBLE>>")
EXCHANGE = ("ix_id BIGINT, name STRING, name_long STRING, country STRING, ixlan_id BIGINT, ixpfx_id BIGINT, "
            "protocol STRING, prefix STRING")
MEMBER_PORT = "ix_id BIGINT, name STRING, netixlan_id BIGINT, asn BIGINT, ipaddr4 STRING, ipaddr6 STRING"
ELEMENT = ("STRUCT<type: STRING, time: DOUBLE, peer_asn: BIGINT, peer_address: STRING, "
           "fields: STRUCT<`next-hop`: STRING, `as-path`: STRING, communities: ARRAY<STRING>, prefix: STRING>>")
RECORD = ("rec STRUCT<project: STRING, collector: STRING, type: STRING, dump_time: DOUBLE, time: DOUBLE, "
          f"status: STRING, dump_position: STRING>, elements ARRAY<{ELEMENT}>")


def log_of(value: str) -> str:
    """The schema of a log whose values have the given fields."""
    return LOG.format(value=f"STRUCT<{value}>")
