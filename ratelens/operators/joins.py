"""Joins of facts to catalogues. Facts are always aggregated per key before they meet a join."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ratelens.functions.convert import ref, text_key
from ratelens.sources.shared import stored  # noqa: F401

# A key with more rows than this is split.
HOT_ROWS = 1_000_000


class NoOverlap(ValueError):
    """Two tables that should describe the same vehicles share no id."""


def hot_keys(df: DataFrame, key: str, min_rows: int = HOT_ROWS) -> DataFrame:
    """``_hot``, ``_shares``: every key with ``min_rows`` rows or more, null included, and into how
    many shares of about that size to split it. There are at most rows / ``min_rows`` such keys.
    """
    counts = df.groupBy(ref(key).alias("_hot")).agg(F.count(F.lit(1)).alias("_rows"))
    shares = F.ceil(F.col("_rows") / min_rows).cast("int")
    return counts.where(F.col("_rows") >= min_rows).select("_hot", shares.alias("_shares"))


def lookup_join(many: DataFrame, one: DataFrame, key: str, how: str = "left",
                hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Join rows to a table that has each key at most once.

    ``how`` is ``inner``, ``left`` (keep all of ``many``) or ``right`` (keep all of ``one``).
    A shuffle by key would send all rows of a hot key to one task. Its rows are dealt to shares by
    the partition they come from, which a task that runs again finds the same, and its row of
    ``one`` is repeated for each share; null keys are dealt out likewise. Nothing runs while the
    plan is built. The hot keys go to all tasks: with the default ``hot_rows`` that is one key for
    each million rows of ``many`` at most; raise it for tables of more than 10^11 rows. ``None``
    says that no key is hot and saves the count.
    """
    if how != "left":
        many = many.where(ref(key).isNotNull())
    if hot_rows is None:
        return many.join(one, key, how)
    hot = F.broadcast(hot_keys(many, key, hot_rows))
    is_hot = ref(key).eqNullSafe(F.col("_hot"))
    dealt = many.join(hot, is_hot, "left").withColumn("_share", F.coalesce(
        F.pmod(F.spark_partition_id(), F.col("_shares")), F.lit(0))).drop("_hot", "_shares")
    shares = F.sequence(F.lit(0), F.coalesce(F.col("_shares"), F.lit(1)) - 1)
    copies = one.join(hot, is_hot, "left").withColumn("_share", F.explode(shares)).drop("_hot")
    if how != "right":
        copies = copies.drop("_shares")
    if how != "right":
        return dealt.join(copies, [key, "_share"], how).drop("_share")
    # A hot key has rows, so a copy of its row that meets none in its share is no row of the result.
    joined = dealt.withColumn("_met", F.lit(True)).join(
        copies.withColumnRenamed("_shares", "_split"), [key, "_share"], "right")
    return joined.where(F.col("_met").isNotNull() | F.col("_split").isNull()).drop("_share", "_met", "_split")


def name_spellings(catalogue: DataFrame, name: str, one_per_key: bool = False) -> DataFrame:
    """``name_key``, the name, and how many catalogue rows carry it.

    With ``one_per_key`` spellings that differ in case or outer blanks count as one, under the
    spelling that sorts first.
    """
    known = catalogue.where(ref(name).isNotNull()).withColumn("name_key", text_key(ref(name)))
    if one_per_key:
        return known.groupBy("name_key").agg(
            F.min(ref(name)).alias(name), F.lit(1).cast("bigint").alias("copies"))
    return known.groupBy("name_key", ref(name)).agg(F.count(F.lit(1)).alias("copies"))


def join_by_name(per_key: DataFrame, spellings: DataFrame,
                 hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Aggregated facts with the catalogue names they match; unmatched facts have a null name.

    A fact matches every catalogue row with its name. Rows that are copies are represented once
    with their number in ``copies``, so repeated models do not multiply rows.
    """
    joined = lookup_join(spellings, per_key, "name_key", "right", hot_rows)
    return joined.withColumn("copies", F.coalesce("copies", F.lit(1)))


def _keys_by_side(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """Each non-null key once as ``clave``, with whether it occurs left and right.

    Both key columns go through one aggregation; nothing is joined. A join, or ``intersect``,
    would move all rows of a key that fills a third of a table; here they are combined before
    the shuffle.
    """
    def tagged(df: DataFrame, key: str, side: str) -> DataFrame:
        return df.where(ref(key).isNotNull()).select(
            ref(key).alias("clave"), *[F.lit(side == s).alias(s) for s in ("_left", "_right")])

    keys = tagged(left, left_key, "_left").unionByName(tagged(right, right_key, "_right"))
    return keys.groupBy("clave").agg(
        F.bool_or("_left").alias("_left"), F.bool_or("_right").alias("_right"))


def key_overlap(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """One row: distinct keys in both tables, in the left and in the right one. Nulls do not count.
    """
    return _keys_by_side(left, left_key, right, right_key).agg(
        F.count_if(F.col("_left") & F.col("_right")).alias("n_comunes"),
        F.count_if("_left").alias("n_izquierda"),
        F.count_if("_right").alias("n_derecha"),
    )


def common_keys(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """The distinct non-null keys that occur in both tables."""
    keys = _keys_by_side(left, left_key, right, right_key)
    return keys.where(F.col("_left") & F.col("_right")).select("clave")


def require_overlap(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> None:
    """Raise ``NoOverlap`` when the tables share no key. Runs one small job."""
    if common_keys(left, left_key, right, right_key).isEmpty():
        raise NoOverlap(f"no value of {left_key} occurs in {right_key}")
