"""Places of all rows of a table at once, without numbering them in one task.

Equal values share a place, so places belong to values: the values are counted, sorted by range into
partitions, and summed up in each. A value's place is the rows of the partitions before, plus those
above it in its own, plus one. The sums of the partitions are one small row.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window, functions as F

from ratelens.functions.convert import ref
from ratelens.operators.joins import HOT_ROWS, lookup_join
from ratelens.sources.shared import stored

# So many values with their places, 16 bytes each, are sent to all tasks; more are joined by value.
SENT_VALUES = 500_000


def value_places(df: DataFrame, column: str) -> DataFrame:
    """``_value`` (never null) and ``_place``: one more than the number of rows with a higher value.

    A value's rows are counted before they are moved, so one that a third of the rows share is one
    row here. The sorted counts are stored, as a sort by range may deal differently when a lost task
    runs again.
    """
    counts = df.where(ref(column).isNotNull()).groupBy(ref(column).alias("_value")).agg(F.count(F.lit(1)).alias("_n"))
    own = Window.partitionBy("_part").orderBy(F.desc("_value"))
    dealt = stored(counts.repartitionByRange(F.desc("_value")).withColumn("_part", F.spark_partition_id()), "values")
    summed = dealt.withColumn("_above", F.sum("_n").over(own) - F.col("_n"))
    # One row with the sum of each partition, in order; a partition's offset is the sum of those before.
    parts = dealt.groupBy("_part").agg(F.sum("_n").alias("_sum")).agg(
        F.sort_array(F.collect_list(F.struct("_part", "_sum"))).alias("_all"))
    offsets = parts.select(F.explode(F.transform("_all", lambda p: F.struct(
        p["_part"].alias("_part"),
        F.aggregate(F.filter("_all", lambda q: q["_part"] < p["_part"]), F.lit(0).cast("bigint"),
                    lambda total, q: total + q["_sum"]).alias("_before")))).alias("_o")).select("_o.*")
    return summed.join(F.broadcast(offsets), "_part").select(
        "_value", (F.col("_before") + F.col("_above") + 1).alias("_place"))


def rank_all(df: DataFrame, measures: Mapping[str, str], hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """All rows with their place by each measure, highest first, and the number of rows, ``n_total``.

    ``measures`` maps the name of a place to the column that decides it. Ties share the better place
    and missing values come after all others, as in ``rank_of``. NaN is the highest value. The values
    are counted first: few are sent to the rows, which then stay where they are.
    """
    counted = df.agg(F.count(F.lit(1)).alias("n_total"), *[
        (F.count(ref(column)) + 1).alias(f"_last{i}") for i, column in enumerate(measures.values())])
    ranked = df
    for i, (place, column) in enumerate(measures.items()):
        places = stored(value_places(df, column), "places").withColumnRenamed("_value", "_key")
        keyed = ranked.withColumn("_key", ref(column))
        if places.count() <= SENT_VALUES:
            ranked = keyed.join(F.broadcast(places), "_key", "left")
        else:
            ranked = lookup_join(keyed, places, "_key", "left", hot_rows)
        last = counted.select(f"_last{i}").scalar()
        ranked = ranked.withColumn(place, F.coalesce("_place", last)).drop("_key", "_place")
    total = counted.select("n_total").scalar()
    return ranked.select(*[ref(c) for c in df.columns], *[ref(p) for p in measures], total.alias("n_total"))
