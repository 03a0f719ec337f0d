"""Column expressions that turn extract text into typed values. A value that cannot be converted is NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c) -> Column:
    """Trimmed text; an empty string is NULL."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def parse_boolean(c) -> Column:
    text = F.lower(F.trim(_col(c)))
    return F.when(text.isin("true", "1"), F.lit(True)).when(text.isin("false", "0"), F.lit(False))


def parse_long(c) -> Column:
    """Whole numbers only: ``1.0`` is 1, ``2.5`` is NULL."""
    number = blank_to_null(c).try_cast("decimal(38,10)")
    return F.when(number == F.floor(number), number.try_cast("bigint"))


def parse_double(c) -> Column:
    value = blank_to_null(c).try_cast("double")
    return F.when(~F.isnan(value), value)


def parse_decimal(c, precision: int = 38, scale: int = 10) -> Column:
    return blank_to_null(c).try_cast(f"decimal({precision},{scale})")


def _dated(c) -> Column:
    # A bare time of day would otherwise be read as a time of the current day.
    text = blank_to_null(c)
    return F.when(text.rlike("^[0-9]{4}"), text)


def parse_date(c) -> Column:
    return _dated(c).try_cast("date")


def parse_timestamp(c) -> Column:
    """UTC timestamps cut to milliseconds, with or without seconds, ``T`` and a zone."""
    text = _dated(c)
    # Without seconds the zone follows the minutes; seconds are put in, as a failing cast is slow.
    short = F.substring(text, 17, 1).isin("Z", "+", "-")
    full = F.when(short, F.concat(F.substring(text, 1, 16), F.lit(":00"), F.substring(text, 17, 16))).otherwise(text)
    value = full.try_cast("timestamp")
    return F.date_trunc("MILLISECOND", value)


def parse_hex_binary(c) -> Column:
    """``0x`` text to bytes."""
    text = blank_to_null(c)
    return F.when(F.lower(F.substring(text, 1, 2)) == "0x", F.try_to_binary(F.substring(text, 3, 2147483647), F.lit("hex")))


def truncate_bytes(c, limit: int) -> Column:
    """At most ``limit`` UTF-8 bytes of a text, never half a character."""
    text = _col(c)
    raw = text.cast("binary")

    def starts_character(position: int) -> Column:
        byte = F.hex(F.substring(raw, max(position, 1), 1))
        return ~byte.between("80", "BF")

    # A character is at most four bytes long: step back to where the first one that does not fit starts.
    keep = (
        F.when(starts_character(limit + 1), F.lit(limit))
        .when(starts_character(limit), F.lit(limit - 1))
        .when(starts_character(limit - 1), F.lit(limit - 2))
        .otherwise(F.lit(limit - 3))
    )
    cut = F.substring(raw, F.lit(1), F.greatest(keep, F.lit(0))).cast("string")
    return F.when(F.octet_length(text) <= limit, text).otherwise(cut)


def replace_invalid(c) -> Column:
    """Bytes or text with every invalid UTF-8 sequence replaced."""
    return F.make_valid_utf8(_col(c).cast("string"))


def clean_value(c, data_type: T.DataType, trim_strings: bool = False) -> Column:
    """The cleaning expression of one target type."""
    if isinstance(data_type, T.BooleanType):
        return parse_boolean(c)
    if isinstance(data_type, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        return parse_long(c).try_cast(data_type)
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return parse_double(c).cast(data_type)
    if isinstance(data_type, T.DecimalType):
        return parse_decimal(c, data_type.precision, data_type.scale)
    if isinstance(data_type, T.DateType):
        return parse_date(c)
    if isinstance(data_type, T.TimestampType):
        return parse_timestamp(c)
    if isinstance(data_type, T.TimestampNTZType):
        return parse_timestamp(c).cast("timestamp_ntz")
    if isinstance(data_type, T.BinaryType):
        return parse_hex_binary(c)
    if isinstance(data_type, T.StringType):
        return F.trim(_col(c)) if trim_strings else _col(c)
    return blank_to_null(c).try_cast(data_type)


def convert_value(c, source: T.DataType, target: T.DataType) -> Column:
    """Convert an already typed column, for example after its dictionary type changed."""
    if source == target:
        return _col(c)
    if isinstance(source, T.StringType):
        return clean_value(c, target)
    if isinstance(target, T.StringType):
        return _col(c).cast("string")
    if isinstance(target, (T.LongType, T.IntegerType)) and isinstance(source, (T.DoubleType, T.FloatType, T.DecimalType)):
        return F.when(_col(c) == F.floor(_col(c)), _col(c).try_cast(target))
    try_castable = isinstance(target, (T.NumericType, T.BooleanType)) and isinstance(source, (T.NumericType, T.BooleanType))
    dates = isinstance(target, (T.DateType, T.TimestampType, T.TimestampNTZType)) and isinstance(
        source, (T.DateType, T.TimestampType, T.TimestampNTZType)
    )
    if try_castable or dates:
        return _col(c).try_cast(target)
    return clean_value(_col(c).cast("string"), target)


def clean(data: DataFrame, schema: T.StructType, trim_strings: bool = False) -> DataFrame:
    """Typed cleaning projection: one narrow select, no shuffle."""
    return data.select(
        *[clean_value(F.col(f"`{f.name}`"), f.dataType, trim_strings).alias(f.name) for f in schema.fields]
    )
