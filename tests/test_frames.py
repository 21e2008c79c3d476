import datetime

import pytest
from conftest import rows

from ratelens.sources import frames
from ratelens.sources.names import MissingColumns


def test_ratings_by_id(spark):
    raw = spark.createDataFrame(
        [(" 7 ", "4", "2024-01-02 10:00:00"), (None, "bad", "x")],
        "carroId string, Estrellas string, creadoEn string")
    made = frames.ratings_by_id(raw)
    assert dict(made.dtypes) == {
        "calificacion": "double", "id_vehiculo": "string", "fecha": "date"}
    assert rows(made.select("id_vehiculo", "calificacion", "fecha")) == [
        ("7", 4.0, datetime.date(2024, 1, 2)), (None, None, None)]
    with pytest.raises(MissingColumns, match="rating"):
        frames.ratings_by_id(raw.drop("Estrellas"))


def test_reviews_take_what_is_there(spark):
    raw = spark.createDataFrame([("u", "t")], "author string, coment string")
    assert frames.reviews_by_id(raw).columns == ["usuario", "resena"]


def test_ratings_by_number_with_an_unnamed_id(spark):
    raw = spark.createDataFrame([("7", "4"), ("x", "5")], "_c0 string, ESTRELLAS string")
    assert rows(frames.ratings_by_number(raw)) == [(7, 4.0), (None, 5.0)]
    with pytest.raises(MissingColumns, match="rating"):
        frames.ratings_by_number(raw.select("_c0"))
    with pytest.raises(MissingColumns, match="vehicle id"):
        frames.ratings_by_number(raw.select("ESTRELLAS"))


def test_catalogue_in_any_case(spark):
    raw = spark.createDataFrame(
        [("7", " Seat ", None, "2001.0")],
        "ID_VEHICULO string, Marca string, modelo string, Anio string")
    made = frames.catalogue(raw)
    assert dict(made.dtypes)["anio"] == "int"
    assert rows(made) == [(7, "Seat", None, 2001)]
    with pytest.raises(MissingColumns, match="anio"):
        frames.catalogue(raw.drop("Anio"))


def test_stored_scorecard_by_name_parts(spark):
    raw = spark.createDataFrame(
        [("Seat", "4.5", "12", 1), ("Fiat", "x", None, 2)],
        "modelo string, rating_medio string, `total_reseñas` string, extra int")
    made = frames.stored_scorecard(raw)
    assert made.columns == ["vehiculo_label", "promedio_calificacion", "n_resenas", "extra"]
    assert rows(made) == [("Seat", 4.5, 12, 1), ("Fiat", 0.0, 0, 2)]


def test_stored_scorecard_without_a_name(spark):
    worded = spark.createDataFrame([(1, "Seat")], "x int, y string")
    assert rows(frames.stored_scorecard(worded)) == [(1, "Seat", "Seat", 0.0, 0)]
    numbers = spark.createDataFrame([(1,)], "x int")
    assert rows(frames.stored_scorecard(numbers)) == [(1, "Vehículo", 0.0, 0)]


def test_star_ratings(spark):
    raw = spark.createDataFrame([("4", "2024-01-02"), ("bad", "x")],
                                "Mis_Estrellas string, fecha_alta string")
    assert rows(frames.star_ratings(raw)) == [
        ("4", datetime.datetime(2024, 1, 2), 4.0), ("bad", None, None)]
    with pytest.raises(MissingColumns):
        frames.star_ratings(raw.drop("Mis_Estrellas"))


def test_user_reviews(spark):
    raw = spark.createDataFrame([("u", "t", "x")], "username string, mi_coment string, fecha string")
    made = frames.user_reviews(raw)
    assert made.columns == ["username", "comentario", "fecha"]
    assert rows(made) == [("u", "t", None)]
    with pytest.raises(MissingColumns):
        frames.user_reviews(raw.drop("username"))
