"""Sort orders, top lists and the rank of one vehicle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ratelens import vocabulary as V
from ratelens.functions.convert import ref
from ratelens.functions.match import same_text

# Each named order as (column, descending) pairs.
NAMED_ORDERS = {
    V.BEST: (("promedio_calificacion", True), ("n_resenas", True)),
    V.WORST: (("promedio_calificacion", False), ("n_resenas", True)),
    V.MOST_REVIEWED: (("n_resenas", True), ("promedio_calificacion", True)),
    V.LEAST_REVIEWED: (("n_resenas", False), ("promedio_calificacion", True)),
}
# List lengths for input from a browser, see ``clamp_top``.
DEFAULT_TOP, LARGEST_TOP = 20, 50


def falling(name: str) -> Column:
    return ref(name).desc_nulls_last()


def rising(name: str) -> Column:
    return ref(name).asc_nulls_last()


def report_order(df: DataFrame, *order: Column, copies: bool = False) -> DataFrame:
    """Sort by the given columns, then by all columns from left to right.

    The second part makes the order of ties the same in every run and lets the range sort spread
    rows that share a hot value over many tasks. Rows that are alike in every column it cannot
    spread; ``copies`` says that the table may hold many of them, as a catalogue with repeated
    rows may. Such rows are then sorted by the number of the partition they come from, which
    changes nothing in the result. A task that runs again finds the same rows and the same
    number, so this is safe when an executor is lost, as a running row number would not be.
    """
    last = [F.spark_partition_id()] if copies else []
    return df.orderBy(*order, *[rising(c) for c in df.columns], *last)


def named_order(df: DataFrame, name: str, copies: bool = False) -> DataFrame:
    """One of four two-column orders; an unknown name means the best first."""
    pairs = NAMED_ORDERS.get(name, NAMED_ORDERS[V.BEST])
    keys = [falling(c) if down else rising(c) for c, down in pairs]
    return report_order(df, *keys, copies=copies)


def column_order(df: DataFrame, shown: Sequence[str], column: str, default: str,
                 ascending: bool = False, n: int | None = None, start: int = 0) -> DataFrame:
    """The shown columns, sorted by any column of the table, or by the default if it has no such.

    With ``n`` only so many rows, after the first ``start`` of the order. Columns neither shown nor sorted by are dropped before the
    sort, so they are not even read.
    """
    chosen = column if column in df.columns else default
    narrow = df.select(*[ref(c) for c in dict.fromkeys([*shown, chosen])])
    ordered = report_order(narrow, rising(chosen) if ascending else falling(chosen))
    if start:
        ordered = ordered.offset(start)
    if n is not None:
        ordered = ordered.limit(n)
    return ordered.select(*[ref(c) for c in shown])


def top(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first n rows; Spark keeps n rows per task and never sorts the whole table.

    Select the columns to show first: all columns take part in deciding ties.
    """
    return report_order(df, *order).limit(n)


def clamp_top(asked: object) -> int:
    """List length from user input: 1 to 50, and 20 when it is not a whole number.

    For callers that want such a bound; no page applies it by itself.
    """
    try:
        return min(max(int(str(asked)), 1), LARGEST_TOP)
    except ValueError:
        return DEFAULT_TOP


def supported(df: DataFrame, count: str, at_least: int) -> DataFrame:
    """Groups with enough rows behind them."""
    return df.where(ref(count) >= at_least)


def top_supported(df: DataFrame, n: int, at_least: int, mean: str = "promedio_calificacion",
                  count: str = "n_calificaciones", worst: bool = False) -> DataFrame:
    """Best or worst n by mean among those with at least so many ratings."""
    enough = supported(df, count, at_least).where(ref(mean).isNotNull())
    return top(enough, n, rising(mean) if worst else falling(mean))


def rank_of(scores: DataFrame, key: str, wanted: str, measures: Mapping[str, str]) -> DataFrame:
    """Place of one vehicle by each measure, highest first, and the number of rows, ``n_total``.

    ``measures`` maps the name of a place to the column that decides it. A place is one more than
    the number of rows above it, so ties share the better place and a missing value comes after
    all others. An id that occurs more than once takes its best row; an unknown id gives no row.
    Two aggregations, no sort: numbering all rows in order would send the whole table through one
    task.
    """
    best = scores.where(same_text(scores, key, wanted)).agg(F.struct(
        F.count(F.lit(1)).alias("_rows"),
        *[F.max(ref(column)).alias(place) for place, column in measures.items()])).scalar()
    places = []
    for place, column in measures.items():
        value = best.getField(place)
        above = F.when(value.isNull(), F.count(ref(column))).otherwise(
            F.count_if(ref(column) > value))
        places.append((F.lit(1) + above).alias(place))
    return (
        scores.agg(*places, F.count(F.lit(1)).alias("n_total"))
        .where(best.getField("_rows") > 0)
        .select(F.lit(wanted).alias(key), "*")
    )
