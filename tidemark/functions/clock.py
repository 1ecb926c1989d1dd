"""Times: epoch numbers, timestamp arguments and file-name stamps.

Event time is a TIMESTAMP in a UTC session; payload time is epoch seconds.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The date formats accepted as an argument and used in names.
ARGUMENT_FORMAT = "yyyy-M-d'T'H:m"
STAMP_FORMAT = "yyyy-MM-dd'T'HH:mm"


MAX_EPOCH_S = 9_223_372_036_854  # Fixed value: the last second whose microseconds fit a BIGINT.


def from_epoch_s(seconds: Column) -> Column:
    """The timestamp of epoch seconds; null where it is out of range."""
    return F.when(seconds.between(-MAX_EPOCH_S, MAX_EPOCH_S), F.timestamp_seconds(seconds))


def epoch_s(ts: Column) -> Column:
    return F.unix_seconds(ts)


def epoch_ms(seconds: Column) -> Column:
    """Epoch milliseconds from float seconds, cut off rather than rounded."""
    return (seconds.cast("double") * 1000).cast("bigint")


def parse_ts(text: Column) -> Column:
    """Epoch milliseconds from a timestamp argument.

    Ten digits are seconds, thirteen are milliseconds, other digit strings are bad, and
    the rest must be a UTC date and minute. Bad arguments give null.
    """
    return (
        F.when(text.rlike("^[0-9]{10}$"), text.try_cast("bigint") * 1000)
        .when(text.rlike("^[0-9]{13}$"), text.try_cast("bigint"))
        .when(text.rlike("^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}T[0-9]{1,2}:[0-9]{1,2}$"),
              F.unix_millis(F.try_to_timestamp(text, F.lit(ARGUMENT_FORMAT))))
    )


def file_stamp(ts: Column) -> Column:
    return F.date_format(ts, STAMP_FORMAT)
