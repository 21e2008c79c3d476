"""Column names: normalising, choosing and checking. Only metadata is touched, no rows are read."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ratelens.functions.convert import ref


class MissingColumns(ValueError):
    """A table lacks a column that a report cannot do without."""


def snake_name(name: str) -> str:
    """``carroId`` -> ``carro_id``, ``Reseña`` -> ``resena``.

    Accents go. A capital or an underscore starts a new word, as does the first letter or digit
    after characters that are neither; a capital in such a place starts two, one of them empty.
    """
    words: list[str] = []
    within, first = False, True
    for sign in unicodedata.normalize("NFKD", name):
        if unicodedata.combining(sign):
            continue
        starts, first = not first, False
        if not (sign.isascii() and (sign.isalnum() or sign == "_")):
            within = False
            continue
        if not within:
            words.append("")
            within = True
        if sign == "_" or starts and sign.isupper():
            words.append("")
        if sign != "_":
            words[-1] += sign.lower()
    return "_".join(words).strip("_")


def snake_columns(df: DataFrame) -> DataFrame:
    """Rename all columns at once; two columns that end up with one name are an error."""
    names = [snake_name(c) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"column names clash after normalising: {clashes} from {df.columns}")
    return df.toDF(*names)


def pick(df: DataFrame, aliases: Sequence[str], default: str | None = None,
         any_case: bool = False) -> str | None:
    """The table's name for the first alias it has, else ``default``."""
    present = {(c.lower() if any_case else c): c for c in reversed(df.columns)}
    return next((present[a] for a in aliases if a in present), default)


def must_pick(df: DataFrame, aliases: Sequence[str], what: str, any_case: bool = False) -> str:
    """As ``pick``; a table with none of the aliases is an error that lists what it has."""
    found = pick(df, aliases, any_case=any_case)
    if found is None:
        raise MissingColumns(f"no {what} column: expected one of {list(aliases)}, got {df.columns}")
    return found


def require(df: DataFrame, names: Iterable[str], any_case: bool = False) -> dict[str, str]:
    """Map each required name to the table's spelling of it; an error lists what is missing."""
    wanted = list(names)
    found = {n: pick(df, [n], any_case=any_case) for n in wanted}
    missing = [n for n in wanted if found[n] is None]
    if missing:
        raise MissingColumns(f"missing columns {missing}, got {df.columns}")
    return found


def find_token(df: DataFrame, tokens: Iterable[str]) -> str | None:
    """First column whose lower-case name contains one of the tokens."""
    return _first(df, lambda c: any(t in c for t in tokens))


def find_prefix(df: DataFrame, prefixes: Iterable[str]) -> str | None:
    """First column whose lower-case name starts with one of the prefixes."""
    return _first(df, lambda c: any(c.startswith(p) for p in prefixes))


def first_text_column(df: DataFrame) -> str | None:
    return next((name for name, kind in df.dtypes if kind == "string"), None)


def project(df: DataFrame, columns: dict[str, str | Column]) -> DataFrame:
    """One select from ``{output name: input name or expression}``."""
    return df.select(*[
        (ref(source) if isinstance(source, str) else source).alias(name)
        for name, source in columns.items()
    ])


def with_constant(df: DataFrame, name: str, value: object, kind: str) -> DataFrame:
    return df.withColumn(name, F.lit(value).cast(kind))


def _first(df: DataFrame, holds: Callable[[str], bool]) -> str | None:
    return next((c for c in df.columns if holds(c.lower())), None)
