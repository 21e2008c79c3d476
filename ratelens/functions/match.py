"""Predicates for text search and lookup. Null never matches."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ratelens.functions.convert import ref, text


def contains(value: Column, query: str, literal: bool = False) -> Column:
    """Case-insensitive search, accented letters included.

    The query is a regular expression unless ``literal`` is set.
    """
    if literal:
        return F.contains(F.lower(text(value)), F.lower(F.lit(query)))
    return text(value).rlike("(?iu)" + query)


def search(df: DataFrame, column: Column, query: str | None, literal: bool = False) -> DataFrame:
    """Rows whose column contains the query; a blank query keeps every row."""
    wanted = (query or "").strip()
    return df.where(contains(column, wanted, literal)) if wanted else df


def same_text(df: DataFrame, name: str, wanted: str) -> Column:
    """Exact lookup on the text form of a column.

    On an integer column it is a comparison of numbers, which Parquet can answer from its
    statistics; no number has the text '07' or 'x', so such a lookup finds nothing.
    """
    if not isinstance(df.schema[name].dataType, T.IntegralType):
        return text(ref(name)) == F.lit(wanted)
    if re.fullmatch(r"0|-?[1-9][0-9]{0,17}", wanted):
        return ref(name) == F.lit(int(wanted))
    return F.lit(False)


def both_present(left: Column, right: Column) -> Column:
    return left.isNotNull() & right.isNotNull()
