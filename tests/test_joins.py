import pytest
from conftest import rows, unordered
from pyspark.sql import functions as F

from ratelens.operators import joins


def lookup_tables(spark):
    """Key 1 holds a third of the rows, the null key another large part; key 9 matches nothing."""
    many = spark.range(300).select(
        F.when(F.col("id") < 100, 1).when(F.col("id") < 180, None)
        .otherwise(F.col("id") % 15).cast("bigint").alias("k"),
        F.concat(F.lit("row"), F.col("id")).alias("v"))
    one = spark.createDataFrame(
        [(k, f"one{k}") for k in [*range(9), *range(10, 20)]], "k long, w string")
    return many, one


def test_hot_keys_and_their_shares(spark):
    many, _ = lookup_tables(spark)
    assert unordered(joins.hot_keys(many, "k", 50)) == [(1, 3), (None, 2)]
    assert rows(joins.hot_keys(many, "k", 1000)) == []


@pytest.mark.parametrize("how", ["left", "inner", "right"])
def test_thousands_of_hot_keys(spark, how):
    many = spark.range(9000).selectExpr("id % 3000 as k", "id as v")
    one = spark.range(1500, 4500).selectExpr("id as k", "id * 2 as w")
    assert joins.hot_keys(many, "k", 2).count() == 3000
    assert unordered(joins.lookup_join(many, one, "k", how, 2)) == unordered(many.join(one, "k", how))


def test_split_bounds_the_rows_of_a_task(spark, tmp_path):
    """A third of 24,000 rows has one key, another third none; a task should not get them all."""
    spark.range(0, 24000, 1, 16).selectExpr(
        "case when id % 3 = 0 then 1 when id % 3 = 1 then id end as k", "id as v").write.parquet(f"{tmp_path}/m")
    one = spark.range(24000).selectExpr("id as k", "id * 2 as w")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
            "spark.sql.files.maxPartitionBytes": "20000", "spark.sql.shuffle.partitions": "16"}
    old = {c: spark.conf.get(c, None) for c in conf}
    for c, v in conf.items():
        spark.conf.set(c, v)
    try:
        many = spark.read.parquet(f"{tmp_path}/m")

        def most(hot_rows):
            joined = joins.lookup_join(many, one, "k", "left", hot_rows)
            return joined.select("v", F.spark_partition_id().alias("p")).groupBy("p").count().agg(F.max("count")).collect()[0][0]
        assert most(None) >= 8000
        assert most(500) < 4000
    finally:
        for c, v in old.items():
            spark.conf.unset(c) if v is None else spark.conf.set(c, v)


def test_nothing_runs_while_the_plan_is_built(spark):
    many, one = lookup_tables(spark)
    broken = many.withColumn("k", F.expr("cast(raise_error('ran') as bigint)"))
    joins.lookup_join(broken, one, "k", "left", 50)


@pytest.mark.parametrize("how", ["left", "inner", "right"])
@pytest.mark.parametrize("hot_rows", [1, 5, 50, 90, 10**9, None])
def test_split_join_equals_plain_join(spark, how, hot_rows):
    many, one = lookup_tables(spark)
    one = one.unionByName(spark.createDataFrame([(None, "none")], one.schema))
    plain = unordered(many.join(one, "k", how))
    assert unordered(joins.lookup_join(many, one, "k", how, hot_rows)) == plain
    if how == "left":
        assert len(plain) == 300


@pytest.mark.parametrize("how", ["left", "inner", "right"])
def test_split_join_when_only_null_is_hot(spark, how):
    many = spark.createDataFrame([(None, "a")] * 5 + [(1, "b"), (2, "c")], "k long, v string")
    one = spark.createDataFrame([(1, "x")], "k long, w string")
    split = joins.lookup_join(many, one, "k", how, 3)
    assert unordered(split) == unordered(many.join(one, "k", how))


def test_hot_keys_of_text(spark):
    many = spark.createDataFrame([("ñ'x`", "a")] * 4 + [("b", "c")], "k string, v string")
    one = spark.createDataFrame([("ñ'x`", 1), ("b", 2)], "k string, w int")
    assert unordered(joins.lookup_join(many, one, "k", "left", 2)) == unordered(
        many.join(one, "k", "left"))


def test_key_overlap(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (None,)], "a long")
    right = spark.createDataFrame([(2,), (3,), (4,), (None,), (2,)], "b long")
    assert rows(joins.key_overlap(left, "a", right, "b")) == [(1, 2, 3)]
    assert rows(joins.common_keys(left, "a", right, "b")) == [(2,)]
    joins.require_overlap(left, "a", right, "b")


def test_disjoint_keys_are_an_error(spark):
    left = spark.createDataFrame([(1,), (None,)], "a long")
    right = spark.createDataFrame([(2,), (None,)], "b long")
    assert rows(joins.key_overlap(left, "a", right, "b")) == [(0, 1, 1)]
    with pytest.raises(joins.NoOverlap):
        joins.require_overlap(left, "a", right, "b")


def test_name_spellings(spark):
    names = spark.createDataFrame([("Ibiza",), ("Ibiza",), (" IBIZA ",), (None,)], "m string")
    assert unordered(joins.name_spellings(names, "m")) == [
        ("ibiza", " IBIZA ", 1), ("ibiza", "Ibiza", 2)]
    assert rows(joins.name_spellings(names, "m", one_per_key=True)) == [("ibiza", " IBIZA ", 1)]


def test_stored_table_reads_back(spark):
    many, _ = lookup_tables(spark)
    assert unordered(joins.stored(many, "t")) == unordered(many)
