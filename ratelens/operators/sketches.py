"""Approximate distinct counts from sketches that add up.

A sketch of the users of a day is some kilobytes, whatever their number. Sketches of days are stored
once; the users of a month, or of any set of days, are counted from their union without the facts.
The relative standard error is 1.04 / sqrt(2 ** precision), at all sizes of the union alike.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ratelens.functions.convert import ref

PRECISION = 14                  # binary logarithm of a sketch's registers


def standard_error(precision: int = PRECISION) -> float:
    return 1.04 / math.sqrt(2 ** precision)


def sketch_of(key: str, precision: int = PRECISION) -> Column:
    """A sketch of the different values of a column in its text form; nulls do not count."""
    return F.hll_sketch_agg(ref(key).cast("string"), F.lit(precision))


def daily_sketches(facts: DataFrame, day: str, key: str, precision: int = PRECISION) -> DataFrame:
    """``fecha_d``, ``n_filas``, ``boceto`` per day. Undated rows have a sketch of their own.

    Tasks combine their rows into sketches before the shuffle, so a day with a third of the rows is
    no larger than any other.
    """
    return facts.groupBy(ref(day).alias("fecha_d")).agg(
        F.count(F.lit(1)).alias("n_filas"), sketch_of(key, precision).alias("boceto"))


def distinct_of_sketches(sketches: DataFrame, *groups: Column) -> DataFrame:
    """``n_filas`` and ``n_claves`` (about) of each group of days, or of all of them."""
    return sketches.groupBy(*groups).agg(
        F.coalesce(F.sum("n_filas"), F.lit(0)).alias("n_filas"),
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("boceto")), F.lit(0)).alias("n_claves"))


def review_summary_of_sketches(sketches: DataFrame) -> DataFrame:
    """``review_summary`` with an approximate number of users, from daily sketches of the users."""
    total = distinct_of_sketches(sketches).select(
        F.col("n_filas").alias("total_resenas"), F.col("n_claves").alias("total_usuarios"))
    mean = F.col("total_resenas") / F.greatest("total_usuarios", F.lit(1))
    return total.withColumn("promedio_resenas_usuario", F.bround(mean, 2))


def key_counts_about(df: DataFrame, key: str, table: str, precision: int = PRECISION) -> DataFrame:
    """As ``key_counts``, with an approximate number of keys: one pass and no shuffle of keys."""
    has_null = F.coalesce(F.max(ref(key).isNull().cast("bigint")), F.lit(0))
    return df.agg(
        F.lit(table).alias("tabla"), F.count(F.lit(1)).alias("n_filas"),
        (F.coalesce(F.hll_sketch_estimate(sketch_of(key, precision)), F.lit(0)) + has_null).alias("n_claves"))
