"""Scalar expressions; all run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Default date and date-time layouts.
DATE = "yyyy-MM-dd"
DATE_TIME = "yyyy-MM-dd HH:mm:ss"


def date_text(epoch_ms: Column, fmt: str = DATE) -> Column:
    """Epoch milliseconds as text; a missing value gives the text ``null``."""
    return F.coalesce(F.date_format(F.timestamp_millis(epoch_ms), fmt), F.lit("null"))


def stamp_to_date(epoch_ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(epoch_ms), DATE_TIME)


def date_to_stamp(text: Column) -> Column:
    return F.unix_millis(F.try_to_timestamp(text, F.lit(DATE_TIME)))


def ipv4(address: Column) -> Column:
    """Dotted form of a 32-bit address, highest byte first."""
    octet = lambda shift: F.shiftrightunsigned(address.cast("long"), shift).bitwiseAND(F.lit(255))
    return F.concat_ws(".", *[octet(s).cast("string") for s in (24, 16, 8, 0)])


def next_midnight(ts: Column) -> Column:
    return F.date_trunc("day", ts) + F.expr("INTERVAL 1 DAY")


def lookup_or_self(mapping: dict[str, str], key: Column) -> Column:
    """Value of a literal map, the key itself when it is absent."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), key)


def report_line(fmt: str, *cols: Column) -> Column:
    return F.format_string(fmt, *cols)
