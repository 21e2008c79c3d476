import pytest
from conftest import plan_of, rows, unordered
from pyspark.sql import functions as F

from ratelens.operators import ranking
from ratelens.operators.reshape import metrics_long
from ratelens.operators.sampling import hash_sample

SCORES = [("a", 4.0, 2), ("b", 4.0, 5), ("c", 2.0, 5), ("d", None, 1), ("e", 2.0, None)]


@pytest.fixture
def scores(spark):
    return spark.createDataFrame(
        SCORES, "id_vehiculo string, promedio_calificacion double, n_resenas long")


@pytest.mark.parametrize("order, expected", [
    ("mejor", "baced"), ("peor", "cebad"), ("mas_resenas", "bcade"), ("menos_resenas", "dabce"),
])
def test_named_orders_put_null_last(scores, order, expected):
    if order == "mejor":
        expected = "bac" + "ed"
    assert "".join(r[0] for r in rows(ranking.named_order(scores, order))) == expected


def test_unknown_order_is_the_best_first(scores):
    assert rows(ranking.named_order(scores, "otro")) == rows(ranking.named_order(scores, "mejor"))


def test_copies_are_all_kept_in_order(spark, scores):
    copied = scores
    for _ in range(3):
        copied = copied.unionByName(copied)
    copied = copied.unionByName(copied.where("id_vehiculo = 'c'")).repartition(7)
    order = ranking.falling("promedio_calificacion")
    expected = rows(ranking.report_order(copied, order))
    assert len(expected) == 48
    made = ranking.report_order(copied, order, copies=True)
    assert made.columns == scores.columns
    assert rows(made) == expected


@pytest.mark.parametrize("copies", [True, False])
def test_copies_spread_over_tasks(spark, copies):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    same = spark.range(0, 8000, 1, 8).selectExpr("id < 0 as a", "'x' || (id < 0) as b")
    made = ranking.report_order(same, ranking.falling("a"), copies=copies)
    try:
        sizes = [n for (n,) in rows(
            made.groupBy(F.spark_partition_id().alias("p")).count().select("count"))]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 8000 and (max(sizes) < 3000 if copies else max(sizes) == 8000)


def test_column_order(scores):
    def order(column, **more):
        made = ranking.column_order(scores, ["id_vehiculo"], column, "promedio_calificacion", **more)
        assert made.columns == ["id_vehiculo"]
        return "".join(r[0] for r in rows(made))

    assert order("n_resenas") == "bcade"
    assert order("n_resenas", ascending=True) == "dabce"
    assert order("no") == "abced"
    assert order("no", n=2) == "ab"


def test_top(scores):
    made = ranking.top(scores, 2, ranking.falling("n_resenas"))
    assert [r[0] for r in rows(made)] == ["b", "c"]
    assert "TakeOrderedAndProject" in plan_of(made)


@pytest.mark.parametrize("asked, n", [
    ("5", 5), (5, 5), ("0", 1), ("-3", 1), ("400", 50), ("x", 20), (None, 20), ("2.5", 20)])
def test_clamp_top(asked, n):
    assert ranking.clamp_top(asked) == n


def test_top_supported(spark):
    scores = spark.createDataFrame(
        [("a", 5.0, 1), ("b", 4.0, 3), ("c", 2.0, 3), ("d", 3.0, 9), ("e", None, 9)],
        "id string, promedio_calificacion double, n_calificaciones long")
    assert [r[0] for r in rows(ranking.top_supported(scores, 2, 3))] == ["b", "d"]
    assert [r[0] for r in rows(ranking.top_supported(scores, 2, 3, worst=True))] == ["c", "d"]
    assert ranking.supported(scores, "n_calificaciones", 4).count() == 2


def test_rank(scores):
    def rank(wanted):
        return rows(ranking.rank_of(
            scores, "id_vehiculo", wanted, {"r": "promedio_calificacion", "c": "n_resenas"}))

    assert rank("a") == [("a", 1, 3, 5)]
    assert rank("b") == [("b", 1, 1, 5)]
    assert rank("c") == [("c", 3, 1, 5)]
    assert rank("d") == [("d", 5, 4, 5)]
    assert rank("e") == [("e", 3, 5, 5)]
    assert rank("nobody") == []


def test_rank_of_a_repeated_id_is_its_best(spark):
    scores = spark.createDataFrame([(1, 2.0), (1, 5.0), (2, 4.0)], "k long, m double")
    assert rows(ranking.rank_of(scores, "k", "1", {"m": "m"})) == [("1", 1, 3)]


def test_metrics_long(scores):
    made = metrics_long(scores, "id_vehiculo", "d", [
        "promedio_calificacion", "n_resenas", "n_calificaciones"])
    assert rows(made) == [
        ("d", "promedio_calificacion", 0.0), ("d", "n_resenas", 1.0),
        ("d", "n_calificaciones", 0.0)]
    assert rows(metrics_long(scores, "id_vehiculo", "nobody", ["n_resenas"])) == []


def test_sample_is_the_same_in_any_layout(spark):
    base = spark.range(20000).select(
        F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    drawn = unordered(hash_sample(base, ["k"], 0.05))
    assert 800 < len(drawn) < 1200
    for layout in (base.repartition(13), base.coalesce(1), base.orderBy(F.desc("k"))):
        assert unordered(hash_sample(layout, ["k"], 0.05)) == drawn
        few = unordered(hash_sample(layout, ["k"], 0.05, at_most=40))
        assert few == unordered(hash_sample(base, ["k"], 0.05, at_most=40))
        assert len(few) == 40 and set(few) <= set(drawn)
    assert unordered(hash_sample(base, ["k"], 0.05, seed=7)) != drawn
    assert hash_sample(base, ["k"], 1.0).count() == 20000
