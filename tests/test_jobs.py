"""From raw CSV files to the pages that read the stored results."""

import pytest
from conftest import rows
from pyspark.errors import AnalysisException

from ratelens.operators.joins import NoOverlap
from ratelens.plans import dashboards, jobs, reports
from ratelens.sources.readers import read_csv, read_table
from ratelens.sources.writers import write_csv

RATINGS = """,estrellas,creado_en
7,5,2024-01-02 10:00:00
7,4,2024-01-03 11:00:00
8,3,2024-02-01 12:00:00
,2,
9,bad,x
"""
REVIEWS = '''username,comentario,fecha,idVehiculo
ana,"muy
bueno, ""sí""",2024-01-02 10:00:00,7
luz,no,2024-01-02 11:00:00,7
ana,,2024-01-03 11:00:00,10
'''


@pytest.fixture
def files(tmp_path):
    (tmp_path / "calificaciones.csv").write_text(
        RATINGS.replace(",estrellas", "carroId,estrellas", 1), encoding="utf-8")
    (tmp_path / "sin_nombre.csv").write_text(RATINGS, encoding="utf-8")
    (tmp_path / "resenas.csv").write_text(REVIEWS, encoding="utf-8")
    (tmp_path / "catalogo.csv").write_text(
        "id_vehiculo,marca,modelo,anio\n7,Seat,Ibiza,2001\n8,,,\n9,Fiat,,1999\n", encoding="utf-8")
    (tmp_path / "autos.csv").write_text(
        "Model,Year,Status,Price,MSRP,Other\nSeven,2001,New,1,2,x\n7,2002,Used,3,4,y\n",
        encoding="utf-8")
    return tmp_path


def test_ratings_to_page(spark, files):
    jobs.save(jobs.report_by_view(spark, " Calificaciones ", f"{files}/calificaciones.csv"),
              f"{files}/out", write=write_csv)
    page = dashboards.stored_ratings_page(
        read_csv(spark, f"{files}/out/distribucion_estrellas", "calificacion double, n bigint"),
        read_csv(spark, f"{files}/out/calificaciones_mensual", "ym string, n_calif bigint"))
    assert rows(page["distribucion"].orderBy("calificacion")) == [
        (None, 1), (2.0, 1), (3.0, 1), (4.0, 1), (5.0, 1)]
    assert rows(page["mensual"].orderBy("ym")) == [(None, 2), ("2024-01", 2), ("2024-02", 1)]


def test_reviews_to_page(spark, files):
    jobs.save(jobs.report_by_view(
        spark, "resenas", reviews=f"{files}/resenas.csv", multi_line=True), f"{files}/out",
        write=write_csv)
    users = read_csv(spark, f"{files}/out/usuarios_agg",
                     "usuario string, n_resenas bigint, longitud_media_resena double")
    assert rows(users) == [("ana", 2, 15.0), ("luz", 1, 2.0)]
    page = dashboards.stored_reviews_page(None, users, "AN")
    assert rows(page["top"]) == [("ana", 2)]


def test_vehicles_to_detail(spark, files):
    report = jobs.report_by_view(
        spark, "otra", f"{files}/calificaciones.csv", f"{files}/resenas.csv", multi_line=True)
    jobs.save(report, f"{files}/out", write=write_csv)
    scores = read_csv(
        spark, f"{files}/out/vehiculos_agg",
        "id_vehiculo string, promedio_calificacion double, n_calificaciones bigint, "
        "n_resenas bigint, longitud_media_resena double")
    assert rows(scores) == [
        ("7", 4.5, 2, 2, 8.5), ("8", 3.0, 1, 0, 0.0), (None, 2.0, 1, 0, 0.0),
        ("10", None, None, 1, 0.0), ("9", None, 1, 0, 0.0)]
    assert rows(dashboards.vehicle_detail(scores, "8")["puesto"]) == [("8", 2, 2, 5)]


def test_scorecard_to_pages(spark, files):
    scores = reports.named_scorecard(
        read_csv(spark, f"{files}/sin_nombre.csv"), read_csv(spark, f"{files}/catalogo.csv"))
    write_csv(scores, f"{files}/out/vehiculos_agg")
    stored = read_csv(spark, f"{files}/out/vehiculos_agg")
    page = dashboards.vehicles_page(stored)
    assert rows(page["top"]) == [("Seat Ibiza", 4.5, 2), ("ID 8", 3.0, 1), ("Fiat", 0.0, 1)]


def test_reports_by_type(spark, files):
    paths = {"autos": f"{files}/autos.csv", "ratings": f"{files}/calificaciones.csv",
             "reviews": f"{files}/resenas.csv", "users": f"{files}/catalogo.csv"}

    def made(kind):
        part = jobs.report_by_type(spark, kind, **paths, multi_line=True)
        return rows(next(iter(part.values())))

    assert made("calificaciones") == [("7", 4.5, 2), (None, 2.5, 3)]
    assert made("resenas") == [("7", 2), (None, 1)]
    assert made("autos") == [("Seven", "2001", "New", "1", "2"), ("7", "2002", "Used", "3", "4")]
    assert len(made("usuarios")) == 3
    profile = jobs.report_by_type(spark, "usuarios", **paths)
    assert rows(profile["usuarios_total"]) == [(3,)] and profile["usuarios_describe"].count() == 5
    with pytest.raises(ValueError, match="unknown"):
        made("motos")


def test_missing_inputs(spark, files):
    with pytest.raises(ValueError, match="calificaciones"):
        jobs.report_by_view(spark, "calificaciones")
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        jobs.report_by_view(spark, "calificaciones", f"{files}/nada.csv")


def test_scorecard_to_two_places(spark, files):
    report = jobs.scorecard(spark, f"{files}/calificaciones.csv", f"{files}/catalogo.csv", "unknown")
    jobs.save(report, f"{files}/out", f"{files}/copy", write=write_csv)
    for folder in ("out", "copy"):
        back = read_csv(spark, f"{files}/{folder}/vehiculos_agg")
        assert sorted(rows(back), key=repr) == [
            ("Desconocido", None, "N/A", "3.0", "1"), ("Fiat", "1999", "N/A", None, "1"),
            ("Seat Ibiza", "2001", "N/A", "4.5", "2")]
    (files / "otro.csv").write_text("id_vehiculo,marca,modelo,anio\n70,a,b,1\n")
    with pytest.raises(NoOverlap):
        jobs.scorecard(spark, f"{files}/calificaciones.csv", f"{files}/otro.csv")


def test_report_as_parquet(spark, files):
    report = jobs.report_by_view(spark, "calificaciones", f"{files}/calificaciones.csv")
    jobs.save(report, f"{files}/p", f"{files}/q")
    for name, part in report.items():
        for folder in "pq":
            stored = read_table(spark, f"{files}/{folder}/{name}")
            assert stored.dtypes == part.dtypes
            assert sorted(rows(stored), key=repr) == sorted(rows(part), key=repr)


def test_whole_catalogue_and_catalogue_files(spark, files):
    (files / "nombres.csv").write_text("id_vehiculo,vehiculo,anio\n7,Ibiza,2001\n5,Uno,\n")
    report = jobs.whole_catalogue(spark, f"{files}/calificaciones.csv", f"{files}/nombres.csv")
    assert rows(report["vehiculos_agg"]) == [
        (7, "Ibiza", 4.5, 2, True), (5, "Uno", 0.0, 0, False)]
    assert sorted(rows(report["cobertura"])) == [("calificaciones", 3, 2), ("catalogo", 2, 2)]
    built = jobs.catalogue(spark, [f"{files}/catalogo*.csv", f"{files}/nada*.csv"])
    assert sorted(rows(built["vehiculos_catalogo"]), key=repr) == [
        ("7", "Seat", "Ibiza"), ("8", None, None), ("9", "Fiat", None)]


def test_a_run_leaves_its_results_only(spark, files):
    from pathlib import Path

    from ratelens.sources.shared import shared_folder

    (files / "nombres.csv").write_text("id_vehiculo,vehiculo,anio\n7,Ibiza,2001\n5,Uno,\n")
    before = set(Path(shared_folder(spark).removeprefix("file:")).iterdir())
    jobs.run(spark, lambda: jobs.whole_catalogue(
        spark, f"{files}/calificaciones.csv", f"{files}/nombres.csv"), f"{files}/r")
    assert set(Path(shared_folder(spark).removeprefix("file:")).iterdir()) == before
    assert read_table(spark, f"{files}/r/vehiculos_agg").count() == 2


def test_broken_records_do_not_end_a_run(spark, files):
    with open(f"{files}/calificaciones.csv", "a", encoding="utf-8") as more:
        more.write('7\n8,4,2024-02-02,"x"\n9,"5\n')
    made = jobs.report_by_view(spark, "calificaciones", f"{files}/calificaciones.csv", aside=f"{files}/rotos")
    assert sum(r.n for r in made["distribucion_estrellas"].collect()) == 5
    bad = read_table(spark, f"{files}/rotos/calificaciones").collect()
    assert sorted(r.registro for r in bad) == ["7", '8,4,2024-02-02,"x"', '9,"5']
    with pytest.raises(ValueError, match="multi_line"):
        jobs.report_by_view(spark, "resenas", reviews=f"{files}/resenas.csv", multi_line=True, aside=f"{files}/rotos")
