"""Repeatable sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ratelens.functions.convert import ref, text

_HASH_RANGE = 1 << 32
_RANGE_BITS = 16


def key_hash(keys: Sequence[str], seed: int) -> Column:
    """A number below 2^32 that depends on seed and key values only."""
    joined = F.concat_ws("|", F.lit(str(seed)), *[text(ref(k)) for k in keys])
    return F.conv(F.substring(F.md5(joined), 1, 8), 16, 10).cast("bigint")


def hash_sample(df: DataFrame, keys: Sequence[str], fraction: float, seed: int = 42,
                at_most: int | None = None) -> DataFrame:
    """About ``fraction`` of the rows, the same ones however the table is laid out.

    Spark's own ``sample`` depends on the partitioning. With ``at_most`` the rows with the lowest
    hashes are taken, which is again independent of layout: a first pass counts rows per range of
    hashes, all ranges below the cut are taken whole, and only the rows of the range that holds the
    cut, about one in 65,536, are sorted. That pass runs at once; without ``at_most`` nothing does.
    """
    drawn = df.withColumn("_hash", key_hash(keys, seed))
    drawn = drawn.where(F.col("_hash") < int(fraction * _HASH_RANGE))
    if at_most is None:
        return drawn.drop("_hash")
    range_ = F.shiftright("_hash", _RANGE_BITS)
    counts = sorted(drawn.groupBy(range_).count().collect())     # 65,536 rows at most
    left = at_most
    for cut, rows in counts:
        if rows > left:
            break
        left -= rows
    else:
        return drawn.drop("_hash")
    last = drawn.where(range_ == cut).orderBy(
        "_hash", *[ref(c).asc_nulls_last() for c in df.columns]).limit(left)
    return drawn.where(range_ < cut).unionByName(last).drop("_hash")
