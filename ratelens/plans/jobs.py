"""Whole runs: files in, result files out."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from ratelens.plans import reports
from ratelens.sources import writers
from ratelens.sources.readers import read_csv
from ratelens.sources.records import read_csv_apart
from ratelens.sources.shared import intermediate_tables

# Names of the runs.
RATINGS, REVIEWS, VEHICLES, AUTOS, USERS = (
    "calificaciones", "resenas", "vehiculos", "autos", "usuarios")


def report_by_view(spark: SparkSession, view: str, ratings: str | None = None,
                   reviews: str | None = None, multi_line: bool = False,
                   aside: str | None = None) -> dict[str, DataFrame]:
    """The report of one view, from CSV paths; any other name than the first two is vehicles.

    A path the view does not need may be left out. ``multi_line`` is for reviews whose text holds
    line breaks; each of their files is then read by one task. With ``aside`` broken records do not
    end the run: they are written to a folder of that name, by table, and the others are reported on.
    """
    wanted = view.strip().lower()
    if wanted == RATINGS:
        return reports.ratings_report(_read(spark, ratings, RATINGS, aside=aside), one_pass=True)
    if wanted == REVIEWS:
        return reports.reviews_report(_read(spark, reviews, REVIEWS, multi_line, aside), one_pass=True)
    return {"vehiculos_agg": reports.vehicles_report(
        _read(spark, ratings, RATINGS, aside=aside), _read(spark, reviews, REVIEWS, multi_line, aside))}


def report_by_type(spark: SparkSession, kind: str, autos: str, ratings: str | None = None,
                   reviews: str | None = None, users: str | None = None,
                   multi_line: bool = False) -> dict[str, DataFrame]:
    """Ratings or reviews per catalogue model, the catalogue, or the users; other names fail.

    Users come with their number and the usual statistics of every column.
    """
    if kind == RATINGS:
        return {"salida_mejores_calificados": reports.ratings_by_model(
            _read(spark, ratings, RATINGS), read_csv(spark, autos))}
    if kind == REVIEWS:
        return {"salida_resenas": reports.reviews_by_model(
            _read(spark, reviews, REVIEWS, multi_line), read_csv(spark, autos))}
    if kind == AUTOS:
        return {"salida_autos": reports.catalogue_listing(read_csv(spark, autos))}
    if kind == USERS:
        table = _read(spark, users, USERS)
        profile = reports.users_profile(table)
        return {"salida_usuarios": table, "usuarios_total": profile["total"],
                "usuarios_describe": profile["describe"]}
    raise ValueError(f"unknown report {kind!r}")


def scorecard(spark: SparkSession, ratings: str, catalogue: str, label: str = "id",
              check_overlap: bool = True) -> dict[str, DataFrame]:
    """The scorecard per readable name and year, from CSV paths."""
    return {"vehiculos_agg": reports.named_scorecard(
        read_csv(spark, ratings), read_csv(spark, catalogue), label, check_overlap)}


def whole_catalogue(spark: SparkSession, ratings: str, catalogue: str) -> dict[str, DataFrame]:
    """The scorecard of every catalogue vehicle and the counts behind it, from CSV paths."""
    return reports.whole_catalogue_report(read_csv(spark, ratings), read_csv(spark, catalogue))


def catalogue(spark: SparkSession, globs: Sequence[str]) -> dict[str, DataFrame]:
    """The catalogue from groups of CSV files, empty when there are none."""
    return {"vehiculos_catalogo": reports.build_catalogue(spark, globs)}


def save(report: Mapping[str, DataFrame], *folders: str,
         write: Callable[..., None] = writers.write_table) -> None:
    """Each part of a report in a directory of its name, replaced as a whole.

    With several folders a part is computed once and written to each. The result is Parquet, or CSV
    with ``writers.write_csv``.
    """
    for name, part in report.items():
        paths = [f"{folder}/{name}" for folder in folders]
        if len(paths) > 1:
            writers.write_each(part, paths, write)
        else:
            write(part, paths[0])


def run(spark: SparkSession, report: Callable[[], Mapping[str, DataFrame]], *folders: str,
        write: Callable[..., None] = writers.write_table) -> None:
    """Make a report and save it; the intermediate tables it needed are gone afterwards."""
    with intermediate_tables(spark):
        save(report(), *folders, write=write)


def _read(spark: SparkSession, path: str | None, what: str,
          multi_line: bool = False, aside: str | None = None) -> DataFrame:
    if path is None:
        raise ValueError(f"this report needs the path of {what}")
    if aside is None:
        return read_csv(spark, path, multi_line=multi_line)
    if multi_line:
        raise ValueError("broken records are told apart line by line, so not with multi_line")
    found = read_csv_apart(spark, path)
    writers.write_table(found.bad, f"{aside}/{what}")
    return found.good
