"""Scalar cleaning of text columns."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NBSP = "\u00a0"

# Symbols removed from amounts, and texts that stand for "no date".
SYMBOLS = "$@#,"
PLACEHOLDERS = ("0", "#", "-", "X", "TB-ADV", "Not available")

CONTROL_CHARS = r"[\x00-\x1f\x7f-\x9f]"

#: Day zero of spreadsheet serial dates.
SERIAL_EPOCH = dt.date(1899, 12, 30)
#: Serial number used as an open end date.
SERIAL_OPEN_END = "2958465"


def strip_nbsp(c: Column) -> Column:
    return F.translate(c, NBSP, "")


def trim_spaces(c: Column) -> Column:
    return F.trim(c)


def strip_control_chars(c: Column) -> Column:
    # most values hold none, and testing is cheaper than rebuilding the text
    return F.when(c.rlike(CONTROL_CHARS), F.regexp_replace(c, CONTROL_CHARS, "")).otherwise(c)


def strip_symbols(c: Column, replacement: Mapping[str, str] | None = None) -> Column:
    """Remove currency and separator symbols, or apply an entity's own one-to-one map."""
    if replacement:
        return F.translate(c, "".join(replacement), "".join(replacement.values()))
    return F.translate(c, SYMBOLS, "")


def digits_only(c: Column) -> Column:
    """First run of digits, blank when there is none."""
    return F.regexp_extract(c, "[0-9]+", 0)


def numeric_chars_only(c: Column) -> Column:
    return F.regexp_replace(c, r"[^0-9.\-]", "")


def strip_thousands(c: Column) -> Column:
    return F.translate(c, ",", "")


def edi_cleanup(c: Column) -> Column:
    bare = F.trim(F.translate(c, "~", ""))
    return F.when(bare.startswith("5") | bare.startswith("7"), F.concat(F.lit("00"), bare)).otherwise(bare)


def placeholder_to_blank(
    c: Column, placeholders: Iterable[str] = PLACEHOLDERS, blank: str | None = None
) -> Column:
    return F.when(c.isin(*placeholders), F.lit(blank).cast("string")).otherwise(c)


def blank_to_null(c: Column) -> Column:
    return F.when(F.trim(c) != "", c)


def null_to_blank(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def is_blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c.cast("string")) == "")


def cast_long(c: Column) -> Column:
    return c.try_cast("bigint")


def cast_double(c: Column) -> Column:
    return c.try_cast("double")


def fill_null(c: Column, default: object = 0) -> Column:
    return F.coalesce(c, F.lit(default))


def cast_declared(c: Column, dtype: T.DataType) -> Column:
    return c if isinstance(dtype, T.StringType) else c.try_cast(dtype)


def scale_decimal(c: Column, digits: int, dtype: str = "decimal(28,6)") -> Column:
    """Times 100, then rounded to ``digits`` places, or up to the next integer for -1."""
    scaled = c.try_cast(dtype) * 100
    return F.ceil(scaled) if digits == -1 else F.round(scaled, digits)


def excel_serial_date(c: Column, missing: Iterable[str] = ()) -> Column:
    """Spreadsheet day number to DATE; listed texts and non-numbers give null."""
    text = F.when(~c.isin(*missing), c) if missing else c
    days = F.floor(text.try_cast("decimal(20,10)")).try_cast("int")
    return F.date_add(F.lit(SERIAL_EPOCH), days)


def excel_serial_timestamp(c: Column) -> Column:
    """Spreadsheet day number with a fraction to TIMESTAMP, rounded to the second."""
    seconds = F.round(c.try_cast("decimal(20,10)") * 86400).try_cast("bigint")
    midnight = F.lit(SERIAL_EPOCH).cast("timestamp")
    return F.timestamp_seconds(F.unix_timestamp(midnight) + seconds)


def standardize_timestamp(c: Column, fmt: str) -> Column:
    return F.try_to_timestamp(c, F.lit(fmt))


def standardize_date(c: Column, fmt: str) -> Column:
    return standardize_timestamp(c, fmt).cast("date")


def strip_leading_zeros(c: Column) -> Column:
    return F.ltrim(c, F.lit("0"))


def normalized_key(c: Column, default: str = "") -> Column:
    """Key text used for matching: trimmed, with a default for missing values."""
    return F.coalesce(F.trim(c.cast("string")), F.lit(default))


def month_label(c: Column) -> Column:
    """First two space-separated tokens joined."""
    parts = F.split(c, " ")
    return F.concat(F.get(parts, F.lit(0)), F.get(parts, F.lit(1)))
