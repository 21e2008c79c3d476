"""Tables whose columns differ in type, brought to common types before they are united.

A common type holds every value of both: integers widen, a date becomes a timestamp, decimals get the
digits of both. Where no type holds both exactly, as for a number and a text, or for decimals of too
many digits, both become text, which the reports read again as numbers and dates. Whole numbers meet
doubles as doubles, unless one of them is too large for a double to hold; then both become text.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from ratelens.functions.convert import ref

LARGEST_IN_DOUBLE = 2 ** 53
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
_FLOAT = (T.FloatType, T.DoubleType)
_SIMPLE = (*_WHOLE, *_FLOAT, T.DecimalType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType,
           T.BooleanType, T.NullType)


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds the values of both; text where none does but text."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if not isinstance(a, _SIMPLE) or not isinstance(b, _SIMPLE):
        raise TypeError(f"no type holds both {a.simpleString()} and {b.simpleString()}")
    whole = [isinstance(x, _WHOLE) for x in (a, b)]
    if all(whole):
        return max(a, b, key=lambda x: _DIGITS[type(x)])
    if all(w or isinstance(x, _FLOAT) for w, x in zip(whole, (a, b))):
        return T.DoubleType()
    if all(w or isinstance(x, T.DecimalType) for w, x in zip(whole, (a, b))):
        scales = [0 if w else x.scale for w, x in zip(whole, (a, b))]
        before = [_DIGITS[type(x)] if w else x.precision - x.scale for w, x in zip(whole, (a, b))]
        digits, scale = max(before) + max(scales), max(scales)
        return T.DecimalType(digits, scale) if digits <= 38 else T.StringType()
    if {type(a), type(b)} in ({T.DateType, T.TimestampType}, {T.DateType, T.TimestampNTZType}):
        return a if isinstance(b, T.DateType) else b
    return T.StringType()


def _by_name(table: DataFrame) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in table.schema.fields}


def _too_large(table: DataFrame, names: Sequence[str]) -> set[str]:
    """Columns of whole numbers with one that a double cannot hold. Parquet answers from its footers."""
    if not names:
        return set()
    ends = table.agg(*[F.struct(F.min(ref(n)), F.max(ref(n))).alias(f"c{i}") for i, n in enumerate(names)]).head()
    return {n for n, (low, high) in zip(names, ends)
            if low is not None and (low < -LARGEST_IN_DOUBLE or high > LARGEST_IN_DOUBLE)}


def common_schema(tables: Sequence[DataFrame]) -> dict[str, T.DataType]:
    """Every column of any table, in order of appearance, with its common type.

    Only where a column holds 64-bit numbers in one table and doubles in another are the ends of the
    former asked for.
    """
    kinds: dict[str, list[T.DataType]] = {}
    for table in tables:
        for name, kind in _by_name(table).items():
            kinds.setdefault(name, []).append(kind)
    found = {name: reduce(common_type, own) for name, own in kinds.items()}
    risky = {name for name, own in kinds.items() if isinstance(found[name], T.DoubleType)
             and any(isinstance(k, T.LongType) for k in own)}
    for table in tables:
        wide = [n for n, k in _by_name(table).items() if n in risky and isinstance(k, T.LongType)]
        for name in _too_large(table, wide):
            found[name] = T.StringType()
    return found


def widened(table: DataFrame, schema: dict[str, T.DataType]) -> DataFrame:
    """The table with its columns in the given types; those that have them stay bare."""
    own = _by_name(table)
    return table.select(*[
        ref(n) if own[n] == kind else ref(n).cast(kind).alias(n) for n, kind in schema.items() if n in own])


def union_widened(tables: Sequence[DataFrame]) -> DataFrame | None:
    """All rows of all tables, columns matched by name and brought to common types, absent ones null.

    Nothing is lost: no value is rounded, cut or made null. Duplicates stay; no table gives None.
    """
    if not tables:
        return None
    schema = common_schema(tables)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [widened(t, schema) for t in tables])
