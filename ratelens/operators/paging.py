"""Pages that cost the same however deep: each starts after the last row of the one before.

A page by ``offset`` fetches all earlier rows as well. Here the last row of a page is a filter on the
next one, so a task keeps one page of rows and, where the table is stored in that order, row groups
before the place are not even read.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ratelens.functions.convert import ref
from ratelens.operators.ranking import falling, rising

PLACE = "_lugar"
COPIES = "copias"


def _read_back(value: str | None, kind: T.DataType) -> Column:
    return F.lit(value).cast(kind)


def _same(name: str, value: Column) -> Column:
    return ref(name).eqNullSafe(value)


def _beyond(name: str, kind: T.DataType, given: str | None, down: bool) -> Column:
    """Whether the column comes after the given value; nulls are last. False after a null."""
    if given is None:
        return F.lit(False)
    value = _read_back(given, kind)
    return (ref(name) < value if down else ref(name) > value) | ref(name).isNull()


def after_place(df: DataFrame, keys: Mapping[str, bool], values: Sequence[str | None]) -> DataFrame:
    """Rows that come after the row with these values; ``keys`` says which columns fall.

    The condition on the first column stands alone as well, so that it reaches the scan.
    """
    kinds = {c: df.schema[c].dataType for c in keys}
    pairs = list(zip(keys, values))
    steps = []
    for i, (name, given) in enumerate(pairs):
        equal = [_same(c, _read_back(v, kinds[c])) for c, v in pairs[:i]]
        steps.append(reduce(and_, [*equal, _beyond(name, kinds[name], given, keys[name])]))
    first, given = pairs[0]
    reached = _beyond(first, kinds[first], given, keys[first]) | _same(first, _read_back(given, kinds[first]))
    return df.where(reached & reduce(or_, steps))


def seek_page(df: DataFrame, shown: Sequence[str], column: str, default: str, ascending: bool = False,
              n: int = 20, after: str | None = None) -> DataFrame:
    """n rows of the table sorted as ``column_order`` sorts it, after the place ``after``.

    ``after`` is the ``_lugar`` of the last row of the page before, as ``next_place`` gives it. Rows
    that are alike in all columns in use come after each other; a place then also says how many of
    them have been shown, and as many are passed over, which any number of copies makes no dearer:
    they are counted, not fetched.
    """
    chosen = column if column in df.columns else default
    names = list(dict.fromkeys([chosen, *shown]))
    keys = {c: c == chosen and not ascending for c in names}
    narrow = df.select(*[ref(c) for c in names])
    order = [falling(c) if keys[c] else rising(c) for c in names]
    place = F.to_json(F.array(*[ref(c).cast("string") for c in names])).alias(PLACE)
    if after is None:
        found = narrow.orderBy(*order).limit(n)
    else:
        *values, seen = json.loads(after)
        same = reduce(and_, [_same(c, _read_back(v, narrow.schema[c].dataType)) for c, v in zip(names, values)])
        left = narrow.where(same).agg((F.count(F.lit(1)) - seen).alias("_left"))
        again = left.where("_left > 0").select(
            *[_read_back(v, narrow.schema[c].dataType).alias(c) for c, v in zip(names, values)],
            F.explode(F.sequence(F.lit(1), F.least("_left", F.lit(n)))).alias("_i")).drop("_i")
        rest = after_place(narrow, keys, values).orderBy(*order).limit(n)
        found = again.unionByName(rest).orderBy(*order).limit(n)
    return found.select(*[ref(c) for c in shown], place)


def next_place(places: Sequence[str], before: str | None = None) -> str | None:
    """The place after a page, from the ``_lugar`` of its rows in order; None after an empty page."""
    if not places:
        return None
    last = json.loads(places[-1])
    seen = 0
    for place in reversed(places):
        if json.loads(place) != last:
            break
        seen += 1
    if before is not None and seen == len(places):
        *values, earlier = json.loads(before)
        seen += earlier if values == last else 0
    return json.dumps([*last, seen], ensure_ascii=False)
