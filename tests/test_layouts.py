"""Places of all rows, lookups by key and joins by bucket: results, plans and rows read."""

import random

import pytest
from conftest import plan_of, rows, unordered
from pyspark.sql import functions as F

from ratelens.functions.match import same_text
from ratelens.operators import ranking, ranks
from ratelens.sources import clustered


@pytest.mark.parametrize("sent", [500_000, 10])
def test_places_are_those_of_sql(spark, monkeypatch, sent):
    monkeypatch.setattr(ranks, "SENT_VALUES", sent)
    rng = random.Random(9)
    values = [rng.choice([None, 1.5, -2.0, float("nan"), 7.0]) for _ in range(100)] + [rng.random() for _ in range(200)]
    df = spark.createDataFrame([(i, v, i % 3, 5) for i, v in enumerate(values)], "id long, v double, w long, same int").repartition(7)
    found = ranks.rank_all(df, {"pv": "v", "pw": "w", "ps": "same"}, hot_rows=50)
    df.createOrReplaceTempView("ranked_rows")
    wanted = spark.sql("""select *, rank() over (order by v desc nulls last) as pv, rank() over (order by w desc) as pw,
                          rank() over (order by same desc) as ps, count(*) over () as n_total from ranked_rows""")
    assert found.columns == wanted.columns
    assert sorted(map(repr, rows(found.withColumn("pv", F.col("pv").cast("int"))))) == sorted(
        map(repr, rows(wanted.withColumn("pv", F.col("pv").cast("int")))))


def test_places_agree_with_those_of_one(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("c", None), ("d", 3.0)], "k string, v double")
    every = {r.k: (r.p, r.n_total) for r in ranks.rank_all(df, {"p": "v"}).collect()}
    assert every == {k: tuple(ranking.rank_of(df, "k", k, {"p": "v"}).head())[1:] for k in "abcd"}
    assert every == {"a": (3, 4), "b": (1, 4), "c": (4, 4), "d": (1, 4)}


def test_places_of_no_rows_and_of_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "k long, v double")
    assert unordered(ranks.rank_all(df, {"p": "v"})) == [(1, None, 1, 2), (2, None, 1, 2)]
    assert rows(ranks.rank_all(df.limit(0), {"p": "v"})) == []


def test_no_window_over_the_table(spark, tmp_path):
    spark.range(1000).selectExpr("id as k", "id % 90 as v").write.parquet(f"{tmp_path}/t")
    plan = plan_of(ranks.value_places(spark.read.parquet(f"{tmp_path}/t"), "v"), "simple")
    assert "windowspecdefinition(_part" in plan and plan.count("SinglePartition") == 1
    assert "SinglePartition" not in plan[plan.index("Window"):].split("BroadcastExchange")[0]


def rows_read(df):
    """Rows that the scans of a query gave out, after passing over row groups."""
    df.collect()
    plan, found = df._jdf.queryExecution().executedPlan(), 0
    waiting = [plan]
    while waiting:
        node = waiting.pop()
        if node.nodeName().startswith("Scan"):
            found += node.metrics().apply("numOutputRows").value()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            waiting.append(node.executedPlan())
        children = node.children()
        waiting += [children.apply(i) for i in range(children.size())]
    return found


@pytest.fixture
def scores(spark):
    """Text ids in no order; one id has a third of the rows."""
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), F.md5(F.col("id").cast("string"))))
    return spark.range(0, 90_000, 1, 6).select(key.alias("id_vehiculo"), F.rand(1).alias("score"))


def test_a_lookup_reads_few_rows(spark, scores, tmp_path):
    clustered.write_lookup(scores, f"{tmp_path}/t", "id_vehiculo", 90_000, row_group_bytes=1 << 16)
    stored = spark.read.parquet(f"{tmp_path}/t")
    assert stored.count() == 90_000
    wanted = scores.where("id_vehiculo <> 'hot'").head().id_vehiculo
    found = stored.where(same_text(stored, "id_vehiculo", wanted))
    assert len(found.collect()) == 1 and rows_read(found) < 9_000
    assert stored.where(same_text(stored, "id_vehiculo", "hot")).count() == 30_000


def test_the_filter_knows_what_is_not_there(spark, scores, tmp_path):
    """Ids between the ends of a row group but not in it: only the Bloom filter can tell."""
    clustered.write_lookup(scores, f"{tmp_path}/t", "id_vehiculo", 90_000)
    stored = spark.read.parquet(f"{tmp_path}/t")
    absent = [f"v{i:x}{'7' * 31}" for i in range(16)]
    assert sum(rows_read(stored.where(F.col("id_vehiculo") == a)) for a in absent) < 40_000
    scores.write.option("parquet.enable.dictionary", "false").parquet(f"{tmp_path}/plain")     # as with many keys
    plain = spark.read.parquet(f"{tmp_path}/plain")
    assert sum(rows_read(plain.where(F.col("id_vehiculo") == a)) for a in absent) == 16 * 90_000


def test_a_hot_key_fills_several_files(spark, scores, tmp_path):
    with_parts = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "6"}
    old = {c: spark.conf.get(c, None) for c in with_parts}
    for c, v in with_parts.items():
        spark.conf.set(c, v)
    try:
        clustered.write_lookup(scores, f"{tmp_path}/t", "id_vehiculo")
    finally:
        for c, v in old.items():
            spark.conf.unset(c) if v is None else spark.conf.set(c, v)
    files = spark.read.parquet(f"{tmp_path}/t").where("id_vehiculo = 'hot'").groupBy("_metadata.file_name").count()
    assert files.count() >= 2


@pytest.mark.parametrize("how", ["inner", "left", "full_outer"])
def test_buckets_join_without_exchange(spark, tmp_path, how):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1"}
    left = spark.range(500).selectExpr("case when id > 3 then id end as id", "id * 2 as a")
    right = spark.range(300, 800).selectExpr("id", "id * 3 as b")
    clustered.write_bucketed(left, f"{tmp_path}/l", "id", 4)
    clustered.write_bucketed(right, f"{tmp_path}/r", "id", 4)
    old = {c: spark.conf.get(c) for c in conf}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a, b = clustered.read_bucketed(spark, f"{tmp_path}/l"), clustered.read_bucketed(spark, f"{tmp_path}/r")
        joined = a.join(b, "id", how)
        assert "Exchange" not in plan_of(joined, "simple")
        assert unordered(joined) == unordered(left.join(right, "id", how))
        assert "Exchange" in plan_of(left.join(right, "id", how), "simple")
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)


def test_bucketed_tables_are_replaced_whole(spark, tmp_path):
    clustered.write_bucketed(spark.range(9), f"{tmp_path}/t", "id", 2)
    with pytest.raises(Exception, match="no more"):
        clustered.write_bucketed(spark.range(9).select(F.raise_error(F.lit("no more")).cast("long").alias("id")), f"{tmp_path}/t", "id", 2)
    assert unordered(clustered.read_bucketed(spark, f"{tmp_path}/t")) == [(i,) for i in range(9)]
