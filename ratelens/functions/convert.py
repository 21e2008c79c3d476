"""Lenient conversions: a value that cannot be converted becomes null.

Spark 4 runs in ANSI mode, where one bad value in a plain cast fails the whole job, so everything
here goes through ``try_cast``. Functions that take ``(df, name)`` look at the column's type first:
on a column that already has the wanted type they return the bare column, so that filters on it
still reach the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def ref(name: str) -> Column:
    """The column with exactly this name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


# What may be a number for ``try_cast``, which costs an exception for any other text. It lets through
# everything a cast can read: blanks around, sign, digits, point, exponent, hexadecimal digits, inf, nan.
MAYBE_NUMBER = (r"(?i)\A[\x00-\x20\x7f]*[+-]?(?:[0-9.][0-9a-fpx.+-]*|inf|infinity|nan)"
                r"[\x00-\x20\x7f]*\z")
MAYBE_WHOLE = r"\A[\x00-\x20\x7f]*[+-]?[0-9]+[\x00-\x20\x7f]*\z"


def _from_text(value: Column, kind: str, pattern: str) -> Column:
    return F.when(value.rlike(pattern), value.try_cast(kind))


def whole(df: DataFrame, name: str) -> Column:
    """Integer keys and years. ``'5.7'`` is cut to 5; large ids in text keep all their digits."""
    kind, value = df.schema[name].dataType, ref(name)
    if isinstance(kind, T.IntegralType):
        return value.cast("bigint")
    if isinstance(kind, T.StringType):
        return F.coalesce(_from_text(value, "bigint", MAYBE_WHOLE),
                          _from_text(value, "double", MAYBE_NUMBER).try_cast("bigint"))
    return value.try_cast("bigint")


def number(df: DataFrame, name: str) -> Column:
    """Measures as double; NaN counts as missing, or one NaN would turn every mean into NaN."""
    kind = df.schema[name].dataType
    value = ref(name)
    value = _from_text(value, "double", MAYBE_NUMBER) if isinstance(kind, T.StringType) \
        else value.try_cast("double")
    if isinstance(kind, (T.IntegralType, T.DecimalType)):
        return value
    return F.when(~F.isnan(value), value)


def number_or_zero(df: DataFrame, name: str) -> Column:
    """``number``, 0.0 where missing or bad, also when the table has no such column."""
    if name not in df.columns:
        return F.lit(0.0)
    return F.coalesce(number(df, name), F.lit(0.0))


def whole_or_zero(df: DataFrame, name: str) -> Column:
    """``whole``, 0 where missing or bad, also when the table has no such column."""
    if name not in df.columns:
        return F.lit(0).cast("bigint")
    return F.coalesce(whole(df, name), F.lit(0).cast("bigint"))


def day(df: DataFrame, name: str) -> Column:
    """Calendar day of a date, a timestamp or a text that starts with one."""
    return ref(name).try_cast("date")


def moment(df: DataFrame, name: str) -> Column:
    """Timestamp without time zone, so the result does not depend on the session's zone."""
    return ref(name).try_cast("timestamp_ntz")


def month(date: Column) -> Column:
    """``yyyy-MM`` of a date."""
    return F.date_format(date, "yyyy-MM")


def text(value: Column) -> Column:
    """Text form of any value; null stays null and never becomes the word 'nan' or 'null'."""
    return value.cast("string")


def trimmed(value: Column) -> Column:
    """Text without leading and trailing blanks; tabs and line breaks stay."""
    return F.trim(text(value))


def key(df: DataFrame, name: str) -> Column:
    """A key to group by: integers as they are, anything else as trimmed text.

    Both have the same text form, but grouping and joining integers moves and compares less.
    """
    if isinstance(df.schema[name].dataType, T.IntegralType):
        return ref(name)
    return trimmed(ref(name))


def stripped(value: Column) -> Column:
    """Text without leading and trailing white space of any kind."""
    return F.regexp_replace(text(value), r"(?U)^\s+|\s+$", "")


def text_key(value: Column) -> Column:
    """Join key for names: blanks trimmed, lower case, accents kept."""
    return F.lower(trimmed(value))


def n_chars(value: Column) -> Column:
    """Characters in a text, trailing blanks included."""
    return F.length(text(value))
