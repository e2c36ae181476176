"""Log sequence numbers (64-bit, written as two hexadecimal halves) and the source's clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Microseconds between the Unix epoch and 2000-01-01, the source's epoch.
EPOCH_SHIFT = 946_684_800_000_000


def parse_lsn(text: Column) -> Column:
    """``A/B`` in hexadecimal to a long; null where the text is not of that form."""
    half = lambda i: F.conv(F.split_part(text, F.lit("/"), F.lit(i)), 16, 10).cast("bigint")
    return F.when(text.rlike("^[0-9A-Fa-f]{1,8}/[0-9A-Fa-f]{1,8}$"), F.shiftleft(half(1), 32) + half(2))


def format_lsn(lsn: Column) -> Column:
    return F.concat(F.hex(F.shiftrightunsigned(lsn, 32)), F.lit("/"), F.hex(lsn.bitwiseAND(F.lit(0xFFFFFFFF))))


def int64_from_network(data: Column) -> Column:
    """The long of eight big-endian bytes below 2^63."""
    return F.conv(F.hex(data), 16, 10).cast("bigint")


def int64_to_network(value: Column) -> Column:
    return F.unhex(F.lpad(F.hex(value), 16, "0"))


def source_micros(ts: Column) -> Column:
    """Microseconds since 2000-01-01 UTC of a timestamp."""
    return F.unix_micros(ts.cast("timestamp")) - F.lit(EPOCH_SHIFT)


def epoch_seconds(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp")) / F.lit(1_000_000)
