"""Results to files. Every sink writes in parallel; a directory of part files is the result.

A result replaces the one before as a whole, see ``publish``: a write that fails, or is killed, leaves
the old result in place.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame

from ratelens.functions.convert import ref
from ratelens.operators.ranking import report_order
from ratelens.sources.lines import one_line
from ratelens.sources.publish import publish
from ratelens.sources.shared import stored


def write_table(df: DataFrame, *paths: str, partition_by: Sequence[str] = ()) -> None:
    """Parquet, replaced as a whole. The default store between two steps."""
    publish(df.sparkSession, lambda place: df.write.partitionBy(*partition_by).parquet(place), *paths)


def write_csv(df: DataFrame, *paths: str) -> None:
    """CSV directory with a header in each part file, replaced as a whole.

    Blanks around text are kept, quotes are doubled and line breaks are escaped, so that each row is
    one line. ``read_csv`` gives the same values back, but for an empty text, which CSV does not tell
    from a missing one.
    """
    lines = df.select(*[one_line(ref(c)).alias(c) if kind == "string" else ref(c)
                        for c, kind in df.dtypes])
    publish(df.sparkSession, lambda place: lines.write.options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(place), *paths)


def write_report(df: DataFrame, path: str, at_most: int) -> None:
    """One CSV file for a result that is small by nature, such as a top list or a histogram.

    ``at_most`` states the size. A larger result is an error and nothing is written. The limit
    leaves one partition of at most that many rows, after the aggregation has run in parallel;
    ``coalesce(1)`` would pull the aggregation itself into one task.
    """
    bounded = stored(df.limit(at_most + 1), "report")
    if bounded.count() > at_most:
        raise ValueError(f"more than {at_most} rows: use write_csv")
    write_csv(bounded, path)


def write_sorted(df: DataFrame, path: str, *order: Column, copies: bool = False) -> None:
    """CSV in report order: a range sort, whose part files are numbered in that order."""
    write_csv(report_order(df, *order, copies=copies), path)


def write_each(df: DataFrame, paths: Sequence[str],
               write: Callable[..., None] = write_csv) -> None:
    """The same result to several places, computed once, into a table in the shared folder.

    The order of a sorted result is kept: one part file there is one part file in each place. No
    place gets it before it is written for all of them.
    """
    write(stored(df, "each"), *paths)


def preview(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first n rows in the given order, for the caller to show."""
    return report_order(df, *order).limit(n)
