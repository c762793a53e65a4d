"""Values rendered as SQL literals, one Column expression per Spark type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .names import column
from .times import utc_naive

_DAY_MICROS = 86_400_000_000


def _fail_when(bad: Column, message: str, value: Column) -> Column:
    return F.when(bad, F.raise_error(F.lit(message)).cast("string")).otherwise(value)


def float_text(c: Column) -> Column:
    """Shortest round-trip digits without an exponent: 1.0 -> ``1``, 1.5E-9 -> ``0.0000000015``."""
    text = c.cast("string")
    sign = F.when(F.startswith(text, F.lit("-")), "-").otherwise("")
    unsigned = F.ltrim(text, F.lit("-"))
    mantissa = F.substring_index(unsigned, "E", 1)
    whole = F.substring_index(mantissa, ".", 1)
    frac = F.rtrim(F.substring_index(mantissa, ".", -1), F.lit("0"))
    plain = F.when(frac == "", whole).otherwise(F.concat(whole, F.lit("."), frac))
    exp = F.substring_index(unsigned, "E", -1).cast("int")
    digits = F.concat(whole, frac)
    # with an exponent the whole part is a single digit, so the point sits after digit exp + 1
    head = F.rpad(F.substring(digits, F.lit(1), exp + 1), exp + 1, F.lit("0"))
    tail = F.substring(digits, exp + 2, F.length(digits))
    large = F.when(tail == "", head).otherwise(F.concat(head, F.lit("."), tail))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -exp - 1), digits)
    scaled = F.when(exp >= 0, large).otherwise(small)
    return F.concat(sign, F.when(F.contains(unsigned, F.lit("E")), scaled).otherwise(plain))


def _float_literal(c: Column) -> Column:
    d = c.cast("double")
    bad = F.isnan(d) | (F.abs(d) == float("inf"))
    return _fail_when(bad, "non-finite number has no SQL literal", float_text(c))


def time_text(micros: Column) -> Column:
    """Microseconds since midnight as ``HH:MM:SS.ffffff``; outside [0, 24 h) is an error."""
    m = micros.cast("bigint")
    text = F.format_string(
        "%02d:%02d:%02d.%06d",
        F.floor(m / 3_600_000_000), F.floor(m / 60_000_000) % 60,
        F.floor(m / 1_000_000) % 60, m % 1_000_000,
    )
    return _fail_when(~m.between(0, _DAY_MICROS - 1), "time of day outside 00:00..24:00", text)


def micros_of_day(ts: Column, instant: bool = False) -> Column:
    """Microseconds since midnight of a zone-free timestamp, or of an instant's UTC reading."""
    ts = utc_naive(ts) if instant else ts
    return (
        (F.hour(ts) * 3600 + F.minute(ts) * 60).cast("bigint") * 1_000_000
        + (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("bigint")
    )


def sql_literal(c: Column, dtype: T.DataType, time_of_day: bool = False) -> Column:
    """Literal text of one column; NULL becomes ``NULL``. Unsupported types raise here, at plan time.

    ``time_of_day`` marks a bigint holding microseconds since midnight.
    """
    if time_of_day:
        body = F.concat(F.lit("'"), time_text(c), F.lit("'"))
    elif isinstance(dtype, T.BooleanType):
        body = F.when(c, "1").otherwise("0")
    elif isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType)):
        body = c.cast("string")  # ANSI casts print decimals at their scale, never with an exponent
    elif isinstance(dtype, (T.FloatType, T.DoubleType)):
        body = _float_literal(c)
    elif isinstance(dtype, T.StringType):
        body = F.concat(F.lit("N'"), F.replace(c, F.lit("'"), F.lit("''")), F.lit("'"))
    elif isinstance(dtype, T.BinaryType):
        body = F.concat(F.lit("0x"), F.hex(c))
    elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        naive = utc_naive(c) if isinstance(dtype, T.TimestampType) else c
        body = F.date_format(naive, "''yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'''")
    elif isinstance(dtype, T.DateType):
        body = F.date_format(c, "''yyyy-MM-dd''")
    else:
        raise TypeError(f"no SQL literal for type {dtype.simpleString()}")
    return F.when(c.isNull(), "NULL").otherwise(body)


def row_tuple(df: DataFrame, columns=None, time_columns=()) -> Column:
    """``(v1, v2, ...)`` over the chosen columns in order."""
    types = {f.name: f.dataType for f in df.schema.fields}
    cells = [
        sql_literal(column(name), types[name], name in time_columns)
        for name in (columns or df.columns)
    ]
    return F.concat(F.lit("("), F.concat_ws(", ", *cells), F.lit(")"))
