"""Records inside text and binary columns.

Bad records never fail a job: they come back flagged and can be routed aside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: time layout of access-log lines.
ACCESS_LOG_TIME = "dd/MM/yyyy:HH:mm:ss"


def parse_delimited(df: DataFrame, text: str, ddl: str, sep: str = ",", keep: tuple = ()) -> DataFrame:
    """Split, trim and cast a delimited text column.

    ``is_valid`` is false when the number of fields differs or a field does not
    cast to its declared type.
    """
    schema = T._parse_datatype_string(ddl)
    parts = F.split(F.col(text), "\\Q" + sep + "\\E", -1)
    raw = [F.trim(F.get(parts, i)) for i in range(len(schema.fields))]
    cast = [r.try_cast(f.dataType) for r, f in zip(raw, schema.fields)]
    valid = F.size(parts) == len(schema.fields)
    for value in cast:
        valid = valid & value.isNotNull()
    return df.select(
        *keep, *[c.alias(f.name) for c, f in zip(cast, schema.fields)],
        F.coalesce(valid, F.lit(False)).alias("is_valid"), F.col(text).alias("raw"))


def split_rejects(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(good records, raw text of the rejected ones)``."""
    good = parsed.filter("is_valid").drop("is_valid", "raw")
    return good, parsed.filter("NOT is_valid").select("raw")


def parse_access_log(df: DataFrame, line: str, keep: tuple = ()) -> DataFrame:
    """Fields of a space-separated access-log line: ip, user, time (4th), method (6th), url (7th)."""
    parts = F.split(F.col(line), " ")
    text_time = F.regexp_replace(F.get(parts, 3), r"^\[", "")
    return df.select(
        *keep,
        F.get(parts, 0).alias("ip"), F.get(parts, 2).alias("user"),
        F.try_to_timestamp(text_time, F.lit(ACCESS_LOG_TIME)).alias("ts"),
        F.get(parts, 5).alias("method"), F.get(parts, 6).alias("url"))


def parse_json(column: str | Column, ddl: str) -> Column:
    """JSON text as a struct; missing fields and broken records become null."""
    col = F.col(column) if isinstance(column, str) else column
    return F.from_json(col, ddl, {"mode": "PERMISSIVE"})


def little_endian_int(payload: Column, offset: int) -> Column:
    """Signed 32-bit little-endian integer at a byte offset of a binary column."""
    byte = lambda i: F.hex(F.substring(payload, offset + i + 1, 1))
    value = F.conv(F.concat(byte(3), byte(2), byte(1), byte(0)), 16, 10).cast("long")
    return F.when(value >= 1 << 31, value - (1 << 32)).otherwise(value)


def to_little_endian(value: Column) -> Column:
    """The four little-endian bytes of a signed 32-bit integer."""
    digits = F.lpad(F.hex(F.pmod(value.cast("long"), F.lit(1 << 32))), 8, "0")
    pair = lambda i: F.substring(digits, i, 2)
    return F.unhex(F.concat(pair(7), pair(5), pair(3), pair(1)))


def decode_event(payload: Column, names: tuple[str, ...]) -> tuple[Column, Column]:
    """``(address, event name)`` of an 8-byte event: two little-endian integers, the second an enum ordinal."""
    ordinal = little_endian_int(payload, 4)
    symbols = F.array(*[F.lit(n) for n in names])
    return little_endian_int(payload, 0), F.get(symbols, ordinal.cast("int"))
