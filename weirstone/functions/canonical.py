"""Canonical text of values and order-insensitive row checksums."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE_BITS = 20
SLICE_MASK = (1 << SLICE_BITS) - 1


# Doubles from here on do not fit a bigint once they are scaled.
_BIGINT_EDGE = 9.2e18


def scaled(col: Column, digits: int = 2) -> Column:
    """A number as a whole count of its ``digits``-th decimal place, halves away from zero.

    Null for NaN, infinities and numbers that do not fit a bigint.
    """
    y = col.cast("double") * float(10**digits)
    whole = F.when(y >= 0, F.floor(y + 0.5)).otherwise(F.ceil(y - 0.5))
    return F.when(F.abs(y) < _BIGINT_EDGE, whole)


# Beyond this a scaled number is counted but not summed.
_DECIMAL_EDGE = 1e28


def summands(field: T.StructField, digits: int) -> tuple[Column, Column | None, Column | None]:
    """What sums of a numeric column are made of.

    The number as a whole count of its ``digits``-th decimal place if that fits
    a bigint, the same as decimal(28,0) for larger ones, and whether it can be
    neither (NaN, infinities, 1e28 and more).  Integer columns have only the first.
    """
    col, kind = F.col(f"`{field.name}`"), field.dataType
    if isinstance(kind, T.DecimalType):
        whole = F.round(col * F.lit(Decimal(10**digits)))
        small = whole.try_cast("bigint")
        large = F.when(small.isNull(), whole.try_cast("decimal(28,0)"))
        return small, large, col.isNotNull() & small.isNull() & large.isNull()
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        y = col.cast("double") * float(10**digits)
        inside = F.abs(y) < _DECIMAL_EDGE
        large = F.when(inside & (F.abs(y) >= _BIGINT_EDGE), y.try_cast("decimal(28,0)"))
        return scaled(col, digits), large, col.isNotNull() & ~inside
    return col.cast("bigint"), None, None


def canonical_text(field: T.StructField, digits: int | None = None) -> Column:
    """Text of a column that is the same wherever the same value is stored.

    Fractions are exact, or whole counts of their ``digits``-th decimal place.
    Times are counts of microseconds or days, so the session zone plays no part.
    """
    col, kind = F.col(f"`{field.name}`"), field.dataType
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        exact = F.when(col == 0, F.lit(0.0)).otherwise(col.cast("double")).cast("string")
        text = exact if digits is None else F.coalesce(scaled(col, digits).cast("string"), exact)
    elif isinstance(kind, T.TimestampNTZType):
        start = F.lit("1970-01-01").cast("timestamp_ntz")
        text = F.timestamp_diff("MICROSECOND", start, col).cast("string")
    elif isinstance(kind, T.TimestampType):
        text = F.unix_micros(col).cast("string")
    elif isinstance(kind, T.DateType):
        text = F.unix_date(col).cast("string")
    elif isinstance(kind, T.BinaryType):
        text = F.hex(col)
    elif isinstance(kind, T.MapType):
        text = _escape(F.to_json(F.struct(F.sort_array(F.map_entries(col)).alias("v"))))
    elif isinstance(kind, (T.ArrayType, T.StructType)):
        text = _escape(F.to_json(F.struct(col.alias("v"))))
    elif isinstance(kind, (T.StringType, T.CharType, T.VarcharType)):
        text = _escape(col)
    else:
        text = col.cast("string")
    return F.when(col.isNull(), F.lit("~")).otherwise(text)


def _escape(col: Column) -> Column:
    # keeps the separator '|' and the null mark '~' unambiguous
    col = F.replace(col, F.lit("\\"), F.lit("\\\\"))
    col = F.replace(col, F.lit("|"), F.lit("\\p"))
    return F.replace(col, F.lit("~"), F.lit("\\t"))


def row_hash(fields: Sequence[T.StructField], digits: int | None = None) -> Column:
    """60-bit hash of a row: the first 15 hex digits of the MD5 of its text."""
    text = F.concat_ws("|", *[canonical_text(f, digits) for f in fields])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def wide_sum(col: Column) -> Column:
    """Exact sum of a bigint column as decimal.

    Sums the low 20 bits and the rest as two bigints, so the aggregation stays
    in primitive code and holds for 2^43 rows; ANSI mode raises beyond that.
    """
    low = F.sum(col.bitwiseAND(F.lit(SLICE_MASK)))
    high = F.sum(F.shiftright(col, SLICE_BITS))
    unit = F.lit(1 << SLICE_BITS).cast("decimal(7,0)")
    return high.cast("decimal(19,0)") * unit + low.cast("decimal(19,0)")


def checksum(hash_col: Column) -> Column:
    """Sum of 60-bit row hashes as text; null for an empty table."""
    low = F.sum(hash_col.bitwiseAND(F.lit(SLICE_MASK)))
    mid = F.sum(F.shiftright(hash_col, SLICE_BITS).bitwiseAND(F.lit(SLICE_MASK)))
    high = F.sum(F.shiftright(hash_col, 2 * SLICE_BITS))
    unit = F.lit(1 << SLICE_BITS).cast("decimal(7,0)")
    unit2 = F.lit(1 << (2 * SLICE_BITS)).cast("decimal(13,0)")
    total = (
        high.cast("decimal(19,0)") * unit2
        + mid.cast("decimal(19,0)") * unit
        + low.cast("decimal(19,0)")
    )
    return total.cast("decimal(38,0)").cast("string")
