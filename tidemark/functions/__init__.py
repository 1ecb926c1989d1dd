"""Column expressions. All of them stay inside the JVM."""

from tidemark.functions.clock import epoch_ms, epoch_s, file_stamp, from_epoch_s, parse_ts
from tidemark.functions.identifiers import (
    as_set_members, asn, encode_key, global_scope, location_name, parse_location, split_scope,
    tr_identifier, valid_asn, with_family,
)
from tidemark.functions.network import address, address_part, ip_to_long, ipv6_longs, length_part, long_to_ip, truncate

__all__ = [
    "address", "address_part", "as_set_members", "asn", "encode_key", "epoch_ms", "epoch_s",
    "file_stamp", "from_epoch_s", "global_scope", "ip_to_long", "ipv6_longs", "length_part",
    "location_name", "long_to_ip", "parse_location", "parse_ts", "split_scope", "tr_identifier",
    "truncate", "valid_asn", "with_family",
]
