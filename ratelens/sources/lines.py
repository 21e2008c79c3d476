"""Texts with line breaks on one line, so that a file of lines can be split anywhere."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# A sign that texts hardly hold stands before the letter of each; it escapes itself as well.
SIGN = "\u241b"
ESCAPES = (("\n", f"{SIGN}n"), ("\r", f"{SIGN}r"), (SIGN, f"{SIGN}0"))


def one_line(value: Column) -> Column:
    """The text without line breaks, so that ``joined_lines`` can restore it."""
    out = value
    for plain, escaped in reversed(ESCAPES):
        out = F.replace(out, F.lit(plain), F.lit(escaped))
    return out


def joined_lines(value: Column) -> Column:
    out = value
    for plain, escaped in ESCAPES:
        out = F.replace(out, F.lit(escaped), F.lit(plain))
    return F.when(value.contains(SIGN), out).otherwise(value)
