"""Batch reports: raw tables in, result tables out. Nothing is written here; see the writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ratelens import vocabulary as V
from ratelens.functions import convert as C
from ratelens.functions.labels import LABELS
from ratelens.operators import joins, metrics, ranking
from ratelens.operators.sampling import hash_sample
from ratelens.sources import frames
from ratelens.sources.names import MissingColumns, must_pick, pick, project
from ratelens.sources.readers import empty_catalogue, read_csv_groups


def ratings_report(raw_ratings: DataFrame, one_pass: bool = False) -> dict[str, DataFrame]:
    """Star histogram and, when the ratings are dated, their monthly series.

    With ``one_pass`` the counts per star and month, a small table, are stored and give both, so
    the ratings are read once.
    """
    ratings = frames.ratings_by_id(raw_ratings)
    if "fecha" not in ratings.columns:
        return {"distribucion_estrellas": metrics.star_histogram(ratings).orderBy("calificacion")}
    if one_pass:
        counts = joins.stored(
            ratings.groupBy("calificacion", C.month(F.col("fecha")).alias("ym"))
            .agg(metrics.n_rows("n")), "ratings-report")
        histogram = counts.groupBy("calificacion").agg(F.sum("n").alias("n"))
        series = counts.groupBy("ym").agg(F.sum("n").alias("n_calif"))
    else:
        histogram, series = metrics.star_histogram(ratings), metrics.monthly_ratings(ratings)
    return {
        "distribucion_estrellas": histogram.orderBy("calificacion"),
        "calificaciones_mensual": series.orderBy("ym"),
    }


def reviews_report(raw_reviews: DataFrame, one_pass: bool = False) -> dict[str, DataFrame]:
    """Daily series and, when the users are known, their activity, busiest first.

    With ``one_pass`` the counts per day and user are stored and give both parts.
    """
    reviews = frames.reviews_by_id(raw_reviews)
    if "fecha_d" not in reviews.columns:
        raise MissingColumns(f"no review date column, got {raw_reviews.columns}")
    if one_pass:
        reviews = joins.stored(metrics.activity_counts(reviews), "reviews-report")
        daily, activity = metrics.daily_of_counts, metrics.activity_of_counts
    else:
        daily, activity = metrics.daily_reviews, metrics.user_activity
    report = {"resenas_diarias": daily(reviews).orderBy("fecha_d")}
    if "usuario" in reviews.columns:
        report["usuarios_agg"] = ranking.report_order(
            activity(reviews), ranking.falling("n_resenas"))
    return report


def vehicles_report(raw_ratings: DataFrame, raw_reviews: DataFrame) -> DataFrame:
    """Rating and review measures per vehicle, best rated first, unrated last."""
    ratings = frames.ratings_by_id(raw_ratings)
    if "id_vehiculo" not in ratings.columns:
        raise MissingColumns(f"no vehicle id column, got {raw_ratings.columns}")
    both = metrics.ratings_and_reviews(ratings, frames.reviews_by_id(raw_reviews))
    both = both.withColumn("id_vehiculo", C.text(F.col("id_vehiculo")))
    return ranking.report_order(both, ranking.falling("promedio_calificacion"))


def named_scorecard(raw_ratings: DataFrame, raw_catalogue: DataFrame, label: str = "id",
                    check_overlap: bool = True, hot_rows: int | None = joins.HOT_ROWS) -> DataFrame:
    """Scorecard per readable name and year.

    ``label`` says what stands in for a missing name: ``id`` (ID n), ``part`` (model or brand,
    else null) or ``unknown`` (a fixed word). With ``check_overlap``, tables without a common id
    are an error instead of an empty result. The scorecard is then computed at once and stored:
    it is empty exactly when no id is common, so the check costs no second pass over the ratings.
    """
    ratings, vehicles = frames.ratings_by_number(raw_ratings), frames.catalogue(raw_catalogue)
    name = LABELS[label](F.col("marca"), F.col("modelo"), F.col("id_vehiculo"))
    labelled = vehicles.select("id_vehiculo", name.alias("vehiculo"), "anio")
    scores = metrics.label_scorecard(ratings, labelled, hot_rows)
    if check_overlap:
        scores = joins.stored(scores, "scorecard")
        if scores.isEmpty():
            raise joins.NoOverlap("no id of the ratings occurs in the catalogue")
    return scores


def full_catalogue_scorecard(raw_ratings: DataFrame, raw_catalogue: DataFrame,
                             hot_rows: int | None = joins.HOT_ROWS) -> DataFrame:
    """Every catalogue vehicle with mean and count, 0 where unrated, best first."""
    return _catalogue_result(metrics.catalogue_scorecard(
        frames.labelled_catalogue(raw_catalogue).select("id_vehiculo", "vehiculo_label"),
        frames.ratings_by_number(raw_ratings), hot_rows))


def _catalogue_result(scored: DataFrame) -> DataFrame:
    result = scored.select("id_vehiculo", "vehiculo_label", "promedio_calificacion", "n_resenas",
                           "calificado")
    return ranking.report_order(
        result, ranking.falling("promedio_calificacion"), copies=True)


def coverage(raw_ratings: DataFrame, raw_catalogue: DataFrame) -> DataFrame:
    """Rows and distinct vehicles of the catalogue and of the usable ratings."""
    ratings = frames.ratings_by_number(raw_ratings).dropna()
    vehicles = frames.labelled_catalogue(raw_catalogue)
    return (
        metrics.key_counts(vehicles, "id_vehiculo", "catalogo")
        .unionByName(metrics.key_counts(ratings, "id_vehiculo", "calificaciones"))
    )


def whole_catalogue_report(raw_ratings: DataFrame, raw_catalogue: DataFrame,
                           hot_rows: int | None = joins.HOT_ROWS) -> dict[str, DataFrame]:
    """The two results above from one pass over the ratings, whose sums per vehicle are stored."""
    vehicles = frames.labelled_catalogue(raw_catalogue)
    rated = joins.stored(metrics.vehicle_ratings(
        frames.ratings_by_number(raw_ratings), rated_only=True), "ratings-per-vehicle")
    counted = rated.agg(
        F.lit("calificaciones").alias("tabla"),
        F.coalesce(F.sum("n_calificaciones"), F.lit(0)).alias("n_filas"),
        F.count(F.lit(1)).alias("n_claves"))
    return {
        "vehiculos_agg": _catalogue_result(metrics.scorecard_of(
            vehicles.select("id_vehiculo", "vehiculo_label"), rated, hot_rows)),
        "cobertura": metrics.key_counts(vehicles, "id_vehiculo", "catalogo").unionByName(counted),
    }


def ratings_by_model(raw_ratings: DataFrame, autos: DataFrame, raw_name: str = "carroId",
                     model: str = "Model", one_per_key: bool = False,
                     hot_rows: int | None = joins.HOT_ROWS) -> DataFrame:
    """Mean and number of ratings per catalogue model, matched by name, best first."""
    ratings = project(raw_ratings, {
        raw_name: raw_name,
        "calificacion": C.number(raw_ratings, must_pick(
            raw_ratings, ("estrellas", *V.RATING), "rating", any_case=True)),
    })
    result = metrics.model_ratings(ratings, raw_name, autos, model, one_per_key, hot_rows)
    return ranking.report_order(result, ranking.falling("promedio_calificacion"))


def reviews_by_model(raw_reviews: DataFrame, autos: DataFrame, model: str = "Model",
                     one_per_key: bool = False, hot_rows: int | None = joins.HOT_ROWS) -> DataFrame:
    """Number of reviews per catalogue model, matched by name, most reviewed first."""
    raw_name = must_pick(raw_reviews, ("id_vehiculo", "carroid", "modelo", *V.VEHICLE_ID),
                         "model name", any_case=True)
    result = metrics.model_reviews(raw_reviews, raw_name, autos, model, one_per_key, hot_rows)
    return ranking.report_order(result, ranking.falling("n_resenas"))


def catalogue_listing(autos: DataFrame) -> DataFrame:
    """The columns of the raw catalogue that are published."""
    return autos.select("Model", "Year", "Status", "Price", "MSRP")


def users_profile(users: DataFrame) -> dict[str, DataFrame]:
    """Number of users and the usual statistics of every column."""
    return {"total": metrics.table_size(users), "describe": users.describe()}


def sampled_catalogue(autos: DataFrame, ratings: DataFrame, key: str, fraction: float = 0.05,
                      at_most: int | None = None, seed: int = 42) -> DataFrame:
    """A repeatable sample of the catalogue with the real ratings of the drawn vehicles.

    ``autos`` has the key, ``Model``, ``Year`` and ``Status``; ``ratings`` has ``id_vehiculo``
    and ``calificacion``. The sample is stored at once, so the catalogue is read once, and the join
    with the aggregated ratings knows its size. ``at_most`` cuts the sample where it is given.
    """
    drawn = joins.stored(hash_sample(project(autos, {
        "id_vehiculo": key, "vehiculo": "Model", "anio": "Year", "estado": "Status",
    }), ["id_vehiculo"], fraction, seed, at_most), "sample")
    scores = metrics.vehicle_ratings(ratings.where(F.col("id_vehiculo").isNotNull()))
    scored = joins.lookup_join(drawn, scores, "id_vehiculo", "left").select(
        "vehiculo", "anio", "estado",
        F.round(F.coalesce("promedio_calificacion", F.lit(0.0)), 2).alias("promedio_calificacion"),
        F.coalesce("n_calificaciones", F.lit(0)).alias("n_resenas"),
    )
    return ranking.report_order(scored, ranking.falling("promedio_calificacion"), copies=True)


def catalogue_from(raw: DataFrame) -> DataFrame:
    """``id_vehiculo``, ``marca``, ``nombre_vehiculo`` without repeated rows, text stripped.

    Without a known id column the first one is the id. One column may serve as id and as name.
    """
    brand, name = pick(raw, V.CATALOGUE_BRAND), pick(raw, V.CATALOGUE_NAME)
    columns = {"id_vehiculo": pick(raw, V.CATALOGUE_ID, default=raw.columns[0])}
    if brand:
        columns["marca"] = brand
    if name:
        columns["nombre_vehiculo"] = name
    rows = metrics.drop_copies(project(raw, columns))
    return rows.withColumns({
        c: C.stripped(F.col(c)) for c in ("marca", "nombre_vehiculo") if c in rows.columns})


def build_catalogue(spark: SparkSession, globs: Sequence[str]) -> DataFrame:
    """The catalogue from groups of CSV files; an empty one when there are no files."""
    raw = read_csv_groups(spark, globs)
    return empty_catalogue(spark) if raw is None else catalogue_from(raw)
