"""Scalar column functions.  All are built from native Spark expressions
(JVM side, code-generated or interpreted higher-order functions); no Python
runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TWO_32 = 4294967296
_TWO_31 = 2147483648


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def epoch_seconds(ts: Column | str) -> Column:
    """Whole seconds since 1970-01-01 of a zone-less timestamp (no session zone involved)."""
    return F.timestamp_diff("SECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), _c(ts))


def java_split(s: Column | str, sep: str) -> Column:
    """``String.split`` with a literal one-char-or-longer separator, Java rules:
    trailing empty strings are removed, inner ones kept, and ``""`` gives ``[""]``.
    Spark's ``split`` keeps trailing empties, so we strip trailing separators first.
    """
    s = _c(s)
    pattern = "".join("\\" + ch if not ch.isalnum() else ch for ch in sep)
    # one-char separator: trimming that char is a plain (non-regex) rtrim
    trimmed = F.rtrim(s, F.lit(sep)) if len(sep) == 1 else F.regexp_replace(s, f"({pattern})+$", "")
    return (F.when(s.isNull(), F.lit(None).cast("array<string>"))
            .when(s == "", F.array(F.lit("")))
            .when(trimmed == "", F.array().cast("array<string>"))
            .otherwise(F.split(trimmed, pattern, -1)))


def _to_int32(h: Column) -> Column:
    """Map an unsigned 32-bit value held in a bigint to Java's signed int."""
    return F.when(h >= F.lit(_TWO_31), h - F.lit(_TWO_32)).otherwise(h).cast("int")


def java_string_hash(s: Column | str) -> Column:
    """``String.hashCode``: h = 31*h + c over UTF-16 units, wrapped to 32 bits."""
    # a code point beyond the basic plane is two units, a high and a low surrogate
    points = F.transform(F.split(_c(s), "", -1), lambda ch: F.ascii(ch).cast("bigint"))
    chars = F.flatten(F.transform(points, lambda p: F.when(p >= 0x10000, F.array(
        F.lit(0xD800) + F.floor((p - 0x10000) / 0x400), F.lit(0xDC00) + F.pmod(p - 0x10000, F.lit(0x400))))
        .otherwise(F.array(p))))
    h = F.aggregate(chars, F.lit(0).cast("bigint"),
                    lambda acc, x: F.pmod(acc * F.lit(31) + x, F.lit(_TWO_32)))
    return _to_int32(h)


def java_long_hash(v: Column | str) -> Column:
    """``Long.hashCode``: (int)(v ^ (v >>> 32))."""
    v = _c(v).cast("bigint")
    mixed = F.bitwise_xor(v, F.shiftrightunsigned(v, 32)) if hasattr(F, "bitwise_xor") \
        else v.bitwiseXOR(F.shiftrightunsigned(v, 32))
    return _to_int32(F.pmod(mixed, F.lit(_TWO_32)))


def java_hash(col: Column | str, data_type: T.DataType) -> Column:
    """``Object.hashCode`` for the argument's type (any-typed scalar function)."""
    c = _c(col)
    if isinstance(data_type, T.StringType):
        return java_string_hash(c)
    if isinstance(data_type, (T.IntegerType, T.ShortType, T.ByteType)):
        return c.cast("int")
    if isinstance(data_type, T.LongType):
        return java_long_hash(c)
    if isinstance(data_type, T.BooleanType):
        return F.when(c, F.lit(1231)).otherwise(F.lit(1237))
    raise TypeError(f"java_hash: unsupported type {data_type}")


def epoch_ms_format(ms: Column | str, fmt: str = "yyyy-MM-dd HH:mm:ss.SSS") -> Column:
    """Format epoch milliseconds like the reference's window-bound printing (UTC)."""
    return F.date_format(F.timestamp_millis(_c(ms)), fmt)
