import datetime

import pytest
from conftest import rows, unordered
from pyspark.sql import functions as F

from ratelens.operators import metrics


def ratings(spark, data, kind="long"):
    return spark.createDataFrame(data, f"id_vehiculo {kind}, calificacion double")


DATA = [(1, 5.0), (1, 4.0), (1, None), (2, 3.0), (None, 2.0), (3, None)]


def test_vehicle_ratings_of_all_rows(spark):
    assert unordered(metrics.vehicle_ratings(ratings(spark, DATA))) == sorted([
        (1, 4.5, 3), (2, 3.0, 1), (None, 2.0, 1), (3, None, 1)], key=repr)


def test_vehicle_ratings_of_usable_rows(spark):
    made = metrics.vehicle_ratings(ratings(spark, DATA), rated_only=True)
    assert unordered(made) == [(1, 4.5, 2), (2, 3.0, 1)]


def test_vehicle_reviews(spark):
    reviews = spark.createDataFrame(
        [("1", "abc"), ("1", "ab"), ("1", None), (None, "x")], "id_vehiculo string, resena string")
    assert unordered(metrics.vehicle_reviews(reviews)) == sorted([
        ("1", 3, 2.5), (None, 1, 1.0)], key=repr)
    assert unordered(metrics.vehicle_reviews(reviews.drop("resena"))) == sorted([
        ("1", 3), (None, 1)], key=repr)


def test_ratings_and_reviews_keep_both_sides(spark):
    rated = ratings(spark, [("1", 5.0), ("2", 4.0), (None, 1.0)], "string")
    reviews = spark.createDataFrame(
        [("2", "abcd"), ("3", "ab"), (None, "x")], "id_vehiculo string, resena string")
    assert unordered(metrics.ratings_and_reviews(rated, reviews)) == sorted([
        ("1", 5.0, 1, 0, 0.0), ("2", 4.0, 1, 1, 4.0), ("3", None, None, 1, 2.0),
        (None, 1.0, 1, 0, 0.0), (None, None, None, 1, 1.0)], key=repr)
    assert unordered(metrics.ratings_and_reviews(rated, reviews.drop("resena"))) == sorted([
        ("1", 5.0, 1, 0), ("2", 4.0, 1, 1), ("3", None, None, 1),
        (None, 1.0, 1, 0), (None, None, None, 1)], key=repr)
    assert unordered(metrics.ratings_and_reviews(rated, reviews.drop("id_vehiculo"))) == sorted([
        ("1", 5.0, 1, 0, 0.0), ("2", 4.0, 1, 0, 0.0), (None, 1.0, 1, 0, 0.0)], key=repr)


def test_ids_of_different_types_meet_as_text(spark):
    rated = ratings(spark, [(1, 5.0), (2, 4.0)])
    reviews = spark.createDataFrame([("2",), ("02",)], "id_vehiculo string")
    assert unordered(metrics.ratings_and_reviews(rated, reviews)) == [
        ("02", None, None, 1), ("1", 5.0, 1, 0), ("2", 4.0, 1, 1)]


@pytest.mark.parametrize("hot_rows", [1, 10**6])
def test_catalogue_scorecard_shows_unrated(spark, hot_rows):
    vehicles = spark.createDataFrame(
        [(1, "a"), (4, "d"), (None, "n"), (1, "a2")], "id_vehiculo long, vehiculo_label string")
    made = metrics.catalogue_scorecard(vehicles, ratings(spark, DATA), hot_rows)
    assert unordered(made) == sorted([
        (1, "a", 4.5, 2, True), (1, "a2", 4.5, 2, True), (4, "d", 0.0, 0, False),
        (None, "n", 0.0, 0, False)], key=repr)


@pytest.mark.parametrize("hot_rows", [1, 10**6])
def test_label_scorecard_merges_labels(spark, hot_rows):
    labelled = spark.createDataFrame(
        [(1, "a", 2000), (2, "a", 2000), (3, "c", 2000), (1, "b", 2001), (9, "z", 1), (None, "n", 1),
         (3, None, None), (3, None, None)],
        "id_vehiculo long, vehiculo string, anio int")
    made = metrics.label_scorecard(ratings(spark, DATA), labelled, hot_rows)
    assert made.columns == ["vehiculo", "anio", "estado", "promedio_calificacion", "n_resenas"]
    assert unordered(made) == sorted([
        ("a", 2000, "N/A", 4.0, 4), ("b", 2001, "N/A", 4.5, 3), ("c", 2000, "N/A", None, 1),
        (None, None, "N/A", None, 2)], key=repr)


def test_label_scorecard_equals_join_then_group(spark):
    facts = spark.range(2000).select(
        (F.col("id") % 37).alias("id_vehiculo"),
        F.when(F.col("id") % 11 != 0, (F.col("id") % 9) / 2.0).alias("calificacion"))
    labelled = spark.range(50).select(
        (F.col("id") % 40).alias("id_vehiculo"),
        F.concat(F.lit("m"), F.col("id") % 7).alias("vehiculo"),
        (F.col("id") % 3).cast("int").alias("anio"))
    plain = facts.join(labelled, "id_vehiculo").groupBy("vehiculo", "anio").agg(
        F.lit("N/A").alias("estado"), F.round(F.avg("calificacion"), 2), F.count(F.lit(1)))
    assert unordered(metrics.label_scorecard(facts, labelled)) == unordered(plain)


def test_model_ratings_fan_out_like_a_row_join(spark):
    facts = spark.createDataFrame(
        [(" ibiza ", 5.0), ("IBIZA", 2.0), ("uno", 3.0), ("punto", None), (None, 1.0)],
        "raw string, calificacion double")
    autos = spark.createDataFrame(
        [("Ibiza",), ("Ibiza",), ("IBIZA",), ("Uno",), (None,)], "Model string")
    plain = (
        facts.withColumn("k", F.lower(F.trim("raw")))
        .join(autos.withColumn("k", F.lower(F.trim("Model"))), "k", "left")
        .groupBy("Model").agg(F.avg("calificacion"), F.count(F.lit(1)))
    )
    made = metrics.model_ratings(facts, "raw", autos, "Model")
    split = metrics.model_ratings(facts, "raw", autos, "Model", hot_rows=2)
    assert unordered(split) == unordered(made) == unordered(plain) == sorted([
        ("Ibiza", 3.5, 4), ("IBIZA", 3.5, 2), ("Uno", 3.0, 1), (None, 1.0, 2)], key=repr)
    once = metrics.model_ratings(facts, "raw", autos, "Model", one_per_key=True)
    assert unordered(once) == sorted([
        ("IBIZA", 3.5, 2), ("Uno", 3.0, 1), (None, 1.0, 2)], key=repr)
    assert unordered(metrics.model_reviews(facts, "raw", autos, "Model")) == sorted([
        ("Ibiza", 4), ("IBIZA", 2), ("Uno", 1), (None, 2)], key=repr)


def test_brand_rollup(spark):
    scores = spark.createDataFrame([
        ("a", 1, 4.0, 10, 1), ("a", 2, 2.0, 30, None), ("a", 2, None, 10, 2),
        ("zero", 3, 5.0, 0, 1), ("none", 4, 5.0, None, 1), ("unrated", 5, None, 4, 1),
        (None, 6, 3.0, 1, 1), ("noid", None, 3.0, 1, 1),
    ], "marca string, id_vehiculo long, promedio_calificacion double, n_calificaciones long, "
       "n_resenas long")
    made = metrics.brand_rollup(scores)
    assert made.columns == [
        "marca", "rating_promedio", "n_vehiculos", "total_resenas", "total_calificaciones"]
    assert unordered(made) == sorted([
        ("a", 2.0, 2, 3, 50), ("zero", None, 1, 1, 0), ("none", None, 1, 1, 0),
        ("unrated", 0.0, 1, 1, 4), (None, 3.0, 1, 1, 1), ("noid", 3.0, 0, 1, 1)], key=repr)
    plain = metrics.brand_rollup(scores, ratings=None, reviews=None)
    assert unordered(plain.where("marca = 'a'")) == [("a", 3.0, 2)]


def test_dense_histogram_rounds_halves_to_even(spark):
    stars = spark.createDataFrame(
        [(v,) for v in (0.4, 0.5, 1.5, 2.5, 3.5, 4.5, 6.0, 5.5, None)], "s double")
    assert rows(metrics.star_histogram_dense(stars, "s")) == [
        (1, 0), (2, 2), (3, 0), (4, 2), (5, 0)]
    assert rows(metrics.star_histogram_dense(stars, "s", range(0, 2))) == [(0, 2), (1, 0)]
    assert rows(metrics.star_histogram_dense(stars.limit(0), "s")) == [(s, 0) for s in range(1, 6)]


def test_star_histogram_keeps_null(spark):
    made = metrics.star_histogram(ratings(spark, DATA)).orderBy("calificacion")
    assert rows(made) == [(None, 2), (2.0, 1), (3.0, 1), (4.0, 1), (5.0, 1)]


def test_series(spark):
    day = datetime.date
    dated = spark.createDataFrame(
        [(day(2024, 1, 31),), (day(2024, 2, 1),), (day(2024, 2, 1),), (None,)], "fecha date")
    assert unordered(metrics.monthly_ratings(dated)) == sorted([
        ("2024-01", 1), ("2024-02", 2), (None, 1)], key=repr)
    assert unordered(metrics.daily_reviews(dated.withColumnRenamed("fecha", "fecha_d"))) == sorted([
        (day(2024, 1, 31), 1), (day(2024, 2, 1), 2), (None, 1)], key=repr)


def test_users(spark):
    reviews = spark.createDataFrame(
        [("u", "abc"), ("u", None), (None, "x"), ("v", None)], "usuario string, resena string")
    assert unordered(metrics.user_activity(reviews)) == sorted([
        ("u", 2, 3.0), (None, 1, 1.0), ("v", 1, None)], key=repr)
    assert unordered(metrics.user_activity(reviews.drop("resena"))) == sorted([
        ("u", 2), (None, 1), ("v", 1)], key=repr)
    named = reviews.withColumnsRenamed({"usuario": "username", "resena": "comentario"})
    assert unordered(metrics.named_user_counts(named)) == [("u", 2), ("v", 1)]
    for data in (named, named.limit(0), named.where("username is null")):
        assert rows(metrics.review_summary_of_counts(metrics.user_counts(data))) == rows(
            metrics.review_summary(data))
    assert rows(metrics.review_summary(named)) == [(4, 2, 2.0)]
    assert rows(metrics.review_summary(named.limit(0))) == [(0, 0, 0.0)]
    assert rows(metrics.review_summary(named.where("username is null"))) == [(1, 0, 1.0)]


def test_rating_summary(spark):
    assert rows(metrics.rating_summary(ratings(spark, DATA), "calificacion")) == [(6, 3.5)]
    eighths = ratings(spark, [(1, 3.0), (2, 3.25)])
    assert rows(metrics.rating_summary(eighths, "calificacion")) == [(2, 3.12)]


def test_scorecard_means_round_halves_up(spark):
    eighths = ratings(spark, [(1, 3.0), (1, 3.25)])
    labelled = spark.createDataFrame([(1, "a", 1)], "id_vehiculo long, vehiculo string, anio int")
    assert metrics.label_scorecard(eighths, labelled).head()["promedio_calificacion"] == 3.13


def test_counts(spark):
    data = ratings(spark, DATA)
    assert rows(metrics.key_counts(data, "id_vehiculo", "t")) == [("t", 6, 4)]
    assert rows(metrics.key_counts(data.limit(0), "id_vehiculo", "t")) == [("t", 0, 0)]
    assert metrics.distinct_keys(data, "id_vehiculo").count() == 4
    assert rows(metrics.table_size(data)) == [(6,)]
    twice = data.unionByName(data)
    assert unordered(metrics.drop_copies(twice)) == sorted(DATA, key=repr)


def test_describe_numbers(spark):
    data = ratings(spark, [(1, 1.0), (2, 3.0), (3, None), (4, float("nan"))])
    assert rows(metrics.describe_numbers(data, ["calificacion", "id_vehiculo"])) == [
        ("calificacion", 2, 2.0, pytest.approx(2 ** 0.5), 1.0, 3.0),
        ("id_vehiculo", 4, 2.5, pytest.approx((5 / 3) ** 0.5), 1.0, 4.0)]
