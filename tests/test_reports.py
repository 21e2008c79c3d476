import datetime
import re

import pytest
from conftest import plan_of, rows, unordered

from ratelens.operators.joins import NoOverlap
from ratelens.plans import dashboards, reports
from ratelens.sources.names import MissingColumns


@pytest.fixture
def raw_ratings(spark):
    return spark.createDataFrame(
        [("7", "5", "2024-01-02"), (" 7 ", "4.5", "2024-01-03"), ("8", "bad", "x"),
         ("x", "3", None), (None, None, "2024-02-01")],
        "carroId string, estrellas string, creado_en string")


@pytest.fixture
def raw_reviews(spark):
    return spark.createDataFrame(
        [("u", "hola", "2024-01-02 10:00:00", "7"), ("u", None, "x", "9"),
         (None, "ok", "2024-01-02", None), ("v", "", "2024-01-03", "7")],
        "username string, comentario string, fecha string, idVehiculo string")


@pytest.fixture
def raw_catalogue(spark):
    return spark.createDataFrame(
        [("7", "Seat", "Ibiza", "2001"), ("8", None, None, "2002"), ("9", "Fiat", "", "x")],
        "id_vehiculo string, marca string, Modelo string, anio string")


def test_ratings_report(raw_ratings):
    report = reports.ratings_report(raw_ratings)
    assert rows(report["distribucion_estrellas"]) == [(None, 2), (3.0, 1), (4.5, 1), (5.0, 1)]
    assert rows(report["calificaciones_mensual"]) == [
        (None, 2), ("2024-01", 2), ("2024-02", 1)]
    once = reports.ratings_report(raw_ratings, one_pass=True)
    for part, df in report.items():
        assert rows(once[part]) == rows(df) and once[part].dtypes == df.dtypes
    assert list(reports.ratings_report(raw_ratings.drop("creado_en"))) == ["distribucion_estrellas"]


def test_reviews_report(raw_reviews):
    report = reports.reviews_report(raw_reviews)
    day = datetime.date
    assert rows(report["resenas_diarias"]) == [
        (None, 1), (day(2024, 1, 2), 2), (day(2024, 1, 3), 1)]
    assert rows(report["usuarios_agg"]) == [("u", 2, 4.0), ("v", 1, 0.0), (None, 1, 2.0)]
    assert list(reports.reviews_report(raw_reviews.drop("username"))) == ["resenas_diarias"]
    untold = reports.reviews_report(raw_reviews.drop("comentario"))["usuarios_agg"]
    assert untold.columns == ["usuario", "n_resenas"]
    with pytest.raises(MissingColumns, match="date"):
        reports.reviews_report(raw_reviews.drop("fecha"))


def test_vehicles_report(raw_ratings, raw_reviews):
    made = reports.vehicles_report(raw_ratings, raw_reviews)
    assert made.columns == ["id_vehiculo", "promedio_calificacion", "n_calificaciones",
                            "n_resenas", "longitud_media_resena"]
    assert rows(made) == [
        ("7", 4.75, 2, 2, 2.0), ("x", 3.0, 1, 0, 0.0), ("8", None, 1, 0, 0.0),
        ("9", None, None, 1, 0.0), (None, None, 1, 0, 0.0), (None, None, None, 1, 2.0)]
    with pytest.raises(MissingColumns, match="vehicle id"):
        reports.vehicles_report(raw_ratings.drop("carroId"), raw_reviews)


def test_named_scorecard(raw_ratings, raw_catalogue, spark):
    assert unordered(reports.named_scorecard(raw_ratings, raw_catalogue)) == [
        ("ID 8", 2002, "N/A", None, 1), ("Seat Ibiza", 2001, "N/A", 4.75, 2)]
    assert unordered(reports.named_scorecard(raw_ratings, raw_catalogue, "part")) == [
        ("Seat Ibiza", 2001, "N/A", 4.75, 2), (None, 2002, "N/A", None, 1)]
    assert unordered(reports.named_scorecard(raw_ratings, raw_catalogue, "unknown")) == [
        ("Desconocido", 2002, "N/A", None, 1), ("Seat Ibiza", 2001, "N/A", 4.75, 2)]
    other = spark.createDataFrame([("70", "a", "b", "1")], raw_catalogue.schema)
    with pytest.raises(NoOverlap):
        reports.named_scorecard(raw_ratings, other)
    assert rows(reports.named_scorecard(raw_ratings, other, check_overlap=False)) == []
    with pytest.raises(MissingColumns, match="marca"):
        reports.named_scorecard(raw_ratings, raw_catalogue.drop("marca"))


def test_full_catalogue_scorecard(raw_ratings, spark):
    named = spark.createDataFrame(
        [("7", "Ibiza", 1), ("8", "Uno", 2), ("9", "Punto", 3)],
        "id_vehiculo string, vehiculo string, anio int")
    made = reports.full_catalogue_scorecard(raw_ratings, named)
    assert rows(made) == [
        (7, "Ibiza", 4.75, 2, True), (8, "Uno", 0.0, 0, False), (9, "Punto", 0.0, 0, False)]
    assert unordered(reports.coverage(raw_ratings, named)) == [
        ("calificaciones", 2, 1), ("catalogo", 3, 3)]


def test_reports_by_model(spark):
    autos = spark.createDataFrame([("Ibiza", 2001, "ok", 1.0, 2.0), ("Uno", 1, "ok", 1.0, 2.0)],
                                  "Model string, Year int, Status string, Price double, MSRP double")
    ratings = spark.createDataFrame([(" IBIZA", "5"), ("x", "1")], "carroId string, estrellas string")
    assert rows(reports.ratings_by_model(ratings, autos)) == [("Ibiza", 5.0, 1), (None, 1.0, 1)]
    assert rows(reports.reviews_by_model(ratings.select("carroId"), autos)) == [
        ("Ibiza", 1), (None, 1)]
    assert reports.catalogue_listing(autos).columns == ["Model", "Year", "Status", "Price", "MSRP"]
    profile = reports.users_profile(autos)
    assert rows(profile["total"]) == [(2,)]
    assert profile["describe"].count() == 5


def test_sampled_catalogue_keeps_unrated(spark):
    autos = spark.range(3000).selectExpr(
        "id", "concat('m', id) as Model", "2000 as Year", "'ok' as Status")
    ratings = spark.range(9000).selectExpr("id % 1500 as id_vehiculo", "4.0D as calificacion")
    made = rows(reports.sampled_catalogue(autos, ratings, "id", at_most=100))
    assert len(made) == 100
    assert {r[3:] for r in made} == {(4.0, 6), (0.0, 0)}
    assert [r[3] for r in made] == sorted((r[3] for r in made), reverse=True)
    whole = rows(reports.sampled_catalogue(autos, ratings, "id", fraction=1.0))
    assert len(whole) == 3000 and set(made) <= set(whole)


def test_catalogue_from(spark):
    raw = spark.createDataFrame(
        [("1", " Seat", "Ibiza\n"), ("1", " Seat", "Ibiza\n"), ("2", None, "nan")],
        "vehiculo string, make string, descripcion string")
    assert unordered(reports.catalogue_from(raw)) == sorted([
        ("1", "Seat", "Ibiza"), ("2", None, "nan")], key=repr)
    first = spark.createDataFrame([("Ibiza", 1)], "modelo string, otro int")
    assert rows(reports.catalogue_from(first)) == [("Ibiza", "Ibiza")]


SCORES = [("1", "Seat", 4.0, 5, 10), ("2", "Seat", 2.0, 9, 30), ("3", "Fiat", 5.0, 1, 1),
          ("12", None, None, 0, 0)]


@pytest.fixture
def scores(spark):
    return spark.createDataFrame(
        SCORES, "id_vehiculo string, marca string, promedio_calificacion double, n_resenas long, "
                "n_calificaciones long")


def test_vehicle_search_and_detail(scores):
    found = dashboards.vehicle_search(scores, "1")
    assert [r[0] for r in rows(found["tabla"])] == ["1", "12"]
    assert rows(found["total"]) == [(2,)]
    assert rows(dashboards.vehicle_search(scores, n=1)["grafica"]) == [("3", 5.0)]
    by_reviews = dashboards.vehicle_search(scores, order="N_RESENAS")["tabla"]
    assert [r[0] for r in rows(by_reviews)] == ["2", "1", "3", "12"]
    detail = dashboards.vehicle_detail(scores, "2")
    assert rows(detail["detalle"]) == [("2", 2.0, 30, 9)]
    assert rows(detail["metricas"]) == [
        ("2", "promedio_calificacion", 2.0), ("2", "n_calificaciones", 30.0),
        ("2", "n_resenas", 9.0)]
    assert rows(detail["puesto"]) == [("2", 3, 1, 4)]
    unknown = dashboards.vehicle_detail(scores, "99")
    assert all(part.isEmpty() for part in unknown.values())
    few = dashboards.vehicle_detail(scores.select("id_vehiculo", "promedio_calificacion"), "1")
    assert rows(few["puesto"]) == [("1", 2, 2, 4)]
    assert rows(few["metricas"])[1:] == [("1", "n_calificaciones", 0.0), ("1", "n_resenas", 0.0)]


def test_brands(scores):
    page = dashboards.brands_page(scores)
    assert rows(page["tabla"]) == [
        ("Fiat", 5.0, 1, 1, 1), ("Seat", 2.5, 2, 14, 40), (None, None, 1, 0, 0)]
    assert [r[0] for r in rows(page["top_resenas"])] == ["Seat", "Fiat", None]
    assert rows(page["total"]) == [(3,)]
    once = dashboards.brands_page(scores, one_pass=True)
    assert {p: rows(df) for p, df in once.items()} == {p: rows(df) for p, df in page.items()}
    assert rows(dashboards.brands_page(scores, at_least=2)["total"]) == [(1,)]
    assert rows(dashboards.brands_page(scores, query="FI")["top_rating"]) == [
        ("Fiat", 5.0, 1, 1, 1)]
    simple = dashboards.brands_page(scores.drop("n_calificaciones", "n_resenas"))
    assert "top_resenas" not in simple
    assert rows(simple["tabla"]) == [("Fiat", 5.0, 1), ("Seat", 3.0, 2), (None, None, 1)]
    with pytest.raises(MissingColumns, match="brand"):
        dashboards.brands_page(scores.drop("marca"))


def test_brand_detail(scores):
    detail = dashboards.brand_detail(scores, "Seat", n=1)
    assert rows(detail["resumen"]) == [("Seat", 2.5, 2, 14, 40)]
    assert rows(detail["top_rating"]) == [("1", 4.0)]
    assert rows(detail["top_resenas"]) == [("2", 9)]
    assert rows(dashboards.brand_detail(scores, "Seat", at_least=99)["resumen"]) == []
    assert all(part.isEmpty() for part in dashboards.brand_detail(scores, "Opel").values())


def test_vehicle_pages(spark):
    stored = spark.createDataFrame(
        [("Ibiza", 4.0, 5), ("Uno", 5.0, 1), ("León", 4.0, 7), (None, 1.0, 9)],
        "modelo string, promedio_calificacion double, n_resenas long")
    page = dashboards.vehicles_page(stored, order="mejor", n=2)
    assert [r[0] for r in rows(page["vehiculos"])] == ["Uno", "León", "Ibiza", None]
    assert rows(page["top"]) == [("Uno", 5.0, 1), ("León", 4.0, 7)]
    assert rows(page["top_resenas"]) == [(None, 9), ("León", 7)]
    assert [r[0] for r in rows(dashboards.vehicles_page(stored, "LEÓN")["vehiculos"])] == ["León"]
    listed = dashboards.vehicle_list(stored, "N", "n_resenas", "asc", 1)
    assert rows(listed["total"]) == [(2,)]
    assert [r[0] for r in rows(listed["tabla"])] == ["Uno", "León"]
    assert rows(listed["grafica"]) == [("Uno", 5.0)]


def test_table_is_whole_or_one_page(spark):
    stored = spark.range(1200).selectExpr("concat('m', id) as modelo", "id as n_resenas")
    listed = dashboards.vehicle_list(stored, order="n_resenas", direction="asc")
    assert [r[1] for r in rows(listed["tabla"])] == list(range(1200))
    assert listed["grafica"].count() == 20
    page = dashboards.vehicle_list(
        stored, order="n_resenas", direction="asc", top=400, page_rows=70, start=500)
    assert [r[1] for r in rows(page["tabla"])] == list(range(500, 570))
    assert page["grafica"].count() == 400


def test_brand_detail_under_a_search(spark):
    scores = spark.createDataFrame(
        [("Seat", 1, 4.0, 2), ("Fiat", 2, 3.0, 1)],
        "marca string, id_vehiculo long, promedio_calificacion double, n_calificaciones long")
    found = dashboards.brand_detail(scores, "Seat", query="EA")
    assert [r.marca for r in found["resumen"].collect()] == ["Seat"]
    assert dashboards.brand_detail(scores, "Seat", query="fiat")["resumen"].isEmpty()


def test_one_pass_gives_the_same_parts(spark):
    raw = spark.createDataFrame(
        [("ana", "abc", "2024-01-02", 1), ("ana", None, "2024-01-02", 1), (None, "x", "bad", 2),
         ("luz", "yz", "2024-01-03", None)], "username string, comentario string, fecha string, idVehiculo long")
    plain, stored = reports.reviews_report(raw), reports.reviews_report(raw, one_pass=True)
    assert {k: (v.dtypes, rows(v)) for k, v in plain.items()} == {k: (v.dtypes, rows(v)) for k, v in stored.items()}
    ratings = spark.createDataFrame([(7, 5.0), (7, 4.0), (9, 1.0), (None, 2.0), (8, None)], "carroId long, estrellas double")
    catalogue = spark.createDataFrame([(7, "a", 1), (8, "b", 2), (5, "c", 3)], "id_vehiculo long, vehiculo string, anio int")
    both = reports.whole_catalogue_report(ratings, catalogue)
    assert rows(both["vehiculos_agg"]) == rows(reports.full_catalogue_scorecard(ratings, catalogue))
    assert sorted(rows(both["cobertura"])) == sorted(rows(reports.coverage(ratings, catalogue)))


def test_charts_read_only_what_they_show(spark, tmp_path):
    wide = spark.range(10).selectExpr(
        "id as id_vehiculo", "1.0D as promedio_calificacion", "id as n_resenas",
        "id as n_calificaciones", "'x' as marca", "'long text' as otro")
    wide.write.parquet(f"{tmp_path}/wide")
    stored = spark.read.parquet(f"{tmp_path}/wide")
    plans = {
        "promedio": dashboards.vehicle_search(stored)["grafica"],
        "otro": dashboards.vehicle_search(stored, order="otro")["grafica"],
        "resenas": dashboards.brand_detail(stored, "x")["top_resenas"],
        "detalle": dashboards.vehicle_detail(stored, "7")["detalle"],
        "vehiculos": dashboards.vehicles_page(
            stored.withColumnRenamed("id_vehiculo", "vehiculo"))["top_resenas"],
    }
    read = {name: re.findall("ReadSchema: struct<(.*)>", plan_of(df)) for name, df in plans.items()}
    key, mean, n = "id_vehiculo:bigint", "promedio_calificacion:double", "n_resenas:bigint"
    assert read == {
        "promedio": [f"{key},{mean}"],
        "otro": [f"{key},{mean},otro:string"],
        "resenas": [f"{key},{n},marca:string"],
        "detalle": [f"{key},{mean},{n},n_calificaciones:bigint"],
        "vehiculos": [f"{key},{n}"],
    }
    assert "PushedFilters: [IsNotNull(id_vehiculo), EqualTo(id_vehiculo,7)]" in plan_of(
        plans["detalle"])
    assert "EqualTo(marca,x)" in plan_of(plans["resenas"])


def test_ratings_and_reviews_pages(spark, raw_ratings, raw_reviews):
    page = dashboards.ratings_page(raw_ratings)
    assert rows(page["resumen"]) == [(5, 4.17)]
    assert rows(page["distribucion"]) == [(1, 0), (2, 0), (3, 1), (4, 1), (5, 1)]
    once = dashboards.ratings_page(raw_ratings, one_pass=True)
    assert {p: rows(df) for p, df in once.items()} == {p: rows(df) for p, df in page.items()}
    page = dashboards.reviews_page(raw_reviews, n=1)
    once = dashboards.reviews_page(raw_reviews, n=1, one_pass=True)
    assert {p: rows(df) for p, df in once.items()} == {p: rows(df) for p, df in page.items()}
    assert rows(page["resumen"]) == [(4, 2, 2.0)]
    assert rows(page["usuarios"]) == [("u", 2)]


def test_stored_pages(spark):
    histogram = spark.createDataFrame([(5.0, 3)], "star double, total long")
    months = spark.createDataFrame([("2024-01", 3)], "mes string, count long")
    page = dashboards.stored_ratings_page(histogram, months)
    assert rows(page["distribucion"]) == [(5.0, 3)] and rows(page["mensual"]) == [("2024-01", 3)]
    assert dashboards.stored_ratings_page(None, months.drop("mes")) == {}
    daily = spark.createDataFrame([("2024-01-02", 3), ("x", 1)], "dia string, n long")
    users = spark.createDataFrame([("Ana", 3), ("ana2", 5), ("Luz", 4)], "user string, n long")
    page = dashboards.stored_reviews_page(daily, users, "ANA", 1)
    assert rows(page["diarias"]) == [(None, 1), (datetime.datetime(2024, 1, 2), 3)]
    assert rows(page["usuarios"]) == [("ana2", 5), ("Ana", 3)]
    assert rows(page["top"]) == [("ana2", 5)] and rows(page["total"]) == [(2,)]
