"""Aggregations over ratings and reviews.

All group with sums and counts that Spark combines before the shuffle, so a group that holds a
third of the rows costs no more than any other. Where a group with a null key stays or goes is
stated, as the reports differ in it.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ratelens import vocabulary as V
from ratelens.functions import convert as C
from ratelens.functions.match import both_present
from ratelens.operators.joins import (
    HOT_ROWS, join_by_name, lookup_join, name_spellings,
)


STARS = range(1, 6)


def n_rows(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


# ---- per vehicle -------------------------------------------------------------------------

def star_totals(ratings: DataFrame, *keys: Column | str) -> DataFrame:
    """Sum of stars, number of stars present, number of rows: the parts of a mean that add up."""
    return ratings.groupBy(*keys).agg(
        F.sum("calificacion").alias("star_sum"),
        F.count("calificacion").alias("star_n"),
        n_rows("star_rows"),
    )


def mean_of_totals(weight: Column | None = None) -> Column:
    """Mean of all stars behind several ``star_totals`` rows, each taken ``weight`` times."""
    total, n = F.col("star_sum"), F.col("star_n")
    if weight is not None:
        total, n = total * weight, n * weight
    return F.try_divide(F.sum(total), F.sum(n))


def vehicle_ratings(ratings: DataFrame, rated_only: bool = False) -> DataFrame:
    """Mean and number of ratings per vehicle.

    By default rows without stars count as ratings and rows without id form a group of their own;
    with ``rated_only`` both are left out first.
    """
    if rated_only:
        ratings = ratings.where(both_present(F.col("id_vehiculo"), F.col("calificacion")))
    return ratings.groupBy("id_vehiculo").agg(
        F.avg("calificacion").alias("promedio_calificacion"), n_rows("n_calificaciones"))


def vehicle_reviews(reviews: DataFrame) -> DataFrame:
    """Number of reviews per vehicle, with mean text length if there is a text. Null id stays."""
    measures = [n_rows("n_resenas")]
    if "resena" in reviews.columns:
        length = F.round(F.avg(C.n_chars(F.col("resena"))), 1)
        measures.append(length.alias("longitud_media_resena"))
    return reviews.groupBy("id_vehiculo").agg(*measures)


def ratings_and_reviews(ratings: DataFrame, reviews: DataFrame) -> DataFrame:
    """Every vehicle that has a rating or a review, with the measures of both.

    Both sides are aggregated by id, so the outer join reuses their partitioning. Ids of different
    types are grouped as text. Rows without id stay apart, one from each side. Review measures are 0 where
    a vehicle has none; the mean and number of ratings stay null where nothing was rated. Reviews
    without an id column cannot be assigned to vehicles and count as none.
    """
    if "id_vehiculo" not in reviews.columns:
        return vehicle_ratings(ratings).withColumns({
            "n_resenas": F.lit(0).cast("bigint"), "longitud_media_resena": F.lit(0.0)})
    if ratings.schema["id_vehiculo"].dataType != reviews.schema["id_vehiculo"].dataType:
        as_text = C.text(F.col("id_vehiculo"))
        ratings = ratings.withColumn("id_vehiculo", as_text)
        reviews = reviews.withColumn("id_vehiculo", as_text)
    both = vehicle_ratings(ratings).join(vehicle_reviews(reviews), "id_vehiculo", "full_outer")
    filled = ("n_resenas", "longitud_media_resena")
    return both.fillna({c: 0 for c in filled if c in both.columns})


def catalogue_scorecard(catalogue: DataFrame, ratings: DataFrame,
                        hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Every catalogue row with mean and count of its ratings; 0 and 0 where it has none.

    ``calificado`` tells an unrated vehicle from one rated 0.
    """
    return scorecard_of(catalogue, vehicle_ratings(ratings, rated_only=True), hot_rows)


def scorecard_of(catalogue: DataFrame, rated: DataFrame,
                 hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """``catalogue_scorecard`` from ``vehicle_ratings`` of rated vehicles."""
    rated = rated.withColumnRenamed("n_calificaciones", "n_resenas")
    scored = lookup_join(catalogue, rated, "id_vehiculo", "left", hot_rows)
    return (
        scored.withColumn("calificado", F.col("n_resenas").isNotNull())
        .fillna({"promedio_calificacion": 0.0, "n_resenas": 0})
    )


def vehicle_scorecard(catalogue: DataFrame, ratings: DataFrame, reviews: DataFrame,
                      hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Every catalogue row with all measures of ratings and reviews, the input of brand reports."""
    measures = ratings_and_reviews(ratings, reviews).where(F.col("id_vehiculo").isNotNull())
    scored = lookup_join(catalogue, measures, "id_vehiculo", "left", hot_rows)
    counts = ("n_calificaciones", "n_resenas", "longitud_media_resena")
    return scored.fillna({c: 0 for c in counts if c in scored.columns})


# ---- per label, model and brand ----------------------------------------------------------

def label_scorecard(ratings: DataFrame, labelled: DataFrame,
                    hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Mean (2 decimals) and number of ratings per (vehiculo, anio) of the catalogue.

    ``labelled`` has ``id_vehiculo``, ``vehiculo`` and ``anio``. Ids with the same label and year
    merge. Ratings are summed per id before the join, so the join sees one row per vehicle
    instead of one per rating; sums of whole or half stars are exact, so the mean is the same.
    """
    totals = star_totals(ratings.where(F.col("id_vehiculo").isNotNull()), "id_vehiculo")
    joined = lookup_join(labelled, totals, "id_vehiculo", "inner", hot_rows)
    return joined.groupBy("vehiculo", "anio").agg(
        F.lit(V.NO_STATUS).alias("estado"),
        F.round(mean_of_totals(), 2).alias("promedio_calificacion"),
        F.sum("star_rows").alias("n_resenas"),
    )


def model_ratings(ratings: DataFrame, raw_name: str, catalogue: DataFrame, model: str,
                  one_per_key: bool = False, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Mean and number of ratings per catalogue model, matched on the normalised name.

    Ratings that match nothing form the group with a null model.
    """
    totals = star_totals(ratings, C.text_key(C.ref(raw_name)).alias("name_key"))
    joined = join_by_name(totals, name_spellings(catalogue, model, one_per_key), hot_rows)
    copies = F.col("copies")
    return joined.groupBy(model).agg(
        mean_of_totals(copies).alias("promedio_calificacion"),
        F.sum(F.col("star_rows") * copies).alias("total_calificaciones"),
    )


def model_reviews(reviews: DataFrame, raw_name: str, catalogue: DataFrame, model: str,
                  one_per_key: bool = False, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Number of reviews per catalogue model, matched as in ``model_ratings``."""
    counts = (
        reviews.groupBy(C.text_key(C.ref(raw_name)).alias("name_key")).agg(n_rows("review_rows"))
    )
    joined = join_by_name(counts, name_spellings(catalogue, model, one_per_key), hot_rows)
    return joined.groupBy(model).agg(
        F.sum(F.col("review_rows") * F.col("copies")).alias("n_resenas"))


def brand_rollup(scores: DataFrame, brand: str = "marca", key: str = "id_vehiculo",
                 mean: str = "promedio_calificacion", ratings: str | None = "n_calificaciones",
                 reviews: str | None = "n_resenas") -> DataFrame:
    """Per brand: mean rating, number of vehicles, sums of reviews and ratings. Null brand stays.

    The mean weighs each vehicle by its number of ratings; a brand with no ratings has none, and
    a vehicle without a mean still counts in the weight. Without a rating count it is the plain
    mean of the vehicles.
    """
    rate = C.ref(mean)
    if ratings:
        weight = F.coalesce(C.ref(ratings), F.lit(0))
        average = F.try_divide(F.coalesce(F.sum(rate * weight), F.lit(0.0)), F.sum(weight))
    else:
        average = F.avg(rate)
    measures = [
        average.alias("rating_promedio"),
        F.countDistinct(C.ref(key)).alias("n_vehiculos"),
    ]
    if reviews:
        measures.append(F.coalesce(F.sum(C.ref(reviews)), F.lit(0)).alias("total_resenas"))
    if ratings:
        measures.append(F.coalesce(F.sum(C.ref(ratings)), F.lit(0)).alias("total_calificaciones"))
    return scores.groupBy(C.ref(brand).alias("marca")).agg(*measures)


# ---- histograms and series ---------------------------------------------------------------

def star_histogram(ratings: DataFrame, stars: str = "calificacion") -> DataFrame:
    """Rows per exact star value; missing stars are a group."""
    return ratings.groupBy(C.ref(stars).alias("calificacion")).agg(n_rows("n"))


def star_counts(stars: str, domain: Iterable[int] = STARS) -> list[Column]:
    """One count per star of the domain, for one global aggregation; halves round to even."""
    rounded = F.bround(C.ref(stars), 0)
    return [F.count_if(rounded == F.lit(float(s))).alias(str(s)) for s in domain]


def stars_long(wide: DataFrame, domain: Iterable[int] = STARS) -> DataFrame:
    """The row of ``star_counts`` as (estrellas, n) rows."""
    return (
        wide.unpivot([], [C.ref(str(s)) for s in domain], "estrellas", "n")
        .withColumn("estrellas", F.col("estrellas").cast("int"))
    )


def star_histogram_dense(ratings: DataFrame, stars: str,
                         domain: Iterable[int] = STARS) -> DataFrame:
    """Rows per rounded star, one output row for each star of the domain, 0 where there are none.

    Missing stars and stars outside the domain are not counted.
    """
    wanted = list(domain)
    return stars_long(ratings.agg(*star_counts(stars, wanted)), wanted)


def monthly_ratings(ratings: DataFrame) -> DataFrame:
    """Ratings per month. Months without ratings are absent; undated ones are a group."""
    return ratings.groupBy(C.month(F.col("fecha")).alias("ym")).agg(n_rows("n_calif"))


def daily_reviews(reviews: DataFrame) -> DataFrame:
    """Reviews per day. Days without reviews are absent; undated ones are a group."""
    return reviews.groupBy("fecha_d").agg(n_rows("n_resenas"))


# ---- users -------------------------------------------------------------------------------

def user_activity(reviews: DataFrame) -> DataFrame:
    """Reviews per user, with mean text length if there is a text. Null user stays."""
    measures = [n_rows("n_resenas")]
    if "resena" in reviews.columns:
        measures.append(F.avg(C.n_chars(F.col("resena"))).alias("longitud_media_resena"))
    return reviews.groupBy("usuario").agg(*measures)


def activity_counts(reviews: DataFrame) -> DataFrame:
    """Reviews per day and user with the sum and number of text lengths: parts that add up."""
    measures = [n_rows("n")]
    if "resena" in reviews.columns:
        length = C.n_chars(F.col("resena"))
        measures += [F.sum(length).alias("chars"), F.count(length).alias("texts")]
    keys = [c for c in ("fecha_d", "usuario") if c in reviews.columns]
    return reviews.groupBy(*keys).agg(*measures)


def daily_of_counts(counts: DataFrame) -> DataFrame:
    """``daily_reviews`` from ``activity_counts``."""
    return counts.groupBy("fecha_d").agg(F.sum("n").alias("n_resenas"))


def activity_of_counts(counts: DataFrame) -> DataFrame:
    """``user_activity`` from ``activity_counts``."""
    measures = [F.sum("n").alias("n_resenas")]
    if "texts" in counts.columns:
        measures.append(F.try_divide(F.sum("chars"), F.sum("texts")).alias("longitud_media_resena"))
    return counts.groupBy("usuario").agg(*measures)


def user_counts(reviews: DataFrame, user: str = "username") -> DataFrame:
    """Reviews per user, reviews without comment included. Null user stays."""
    return reviews.groupBy(C.ref(user)).agg(n_rows("n_resenas"))


def named_user_counts(reviews: DataFrame, user: str = "username") -> DataFrame:
    """As ``user_counts``; null user goes."""
    return user_counts(reviews.where(C.ref(user).isNotNull()), user)


# ---- one-row summaries -------------------------------------------------------------------

def rating_totals(stars: str) -> list[Column]:
    """Number of ratings, unreadable ones included, and their mean to 2 decimals, halves to even.
    """
    return [n_rows("total_calif"), F.bround(F.avg(C.ref(stars)), 2).alias("promedio_global")]


def rating_summary(ratings: DataFrame, stars: str) -> DataFrame:
    return ratings.agg(*rating_totals(stars))


def review_summary(reviews: DataFrame, user: str = "username") -> DataFrame:
    """Number of reviews, number of users, reviews per user to 2 decimals, halves to even."""
    return _per_user(reviews.agg(
        n_rows("total_resenas"), F.countDistinct(C.ref(user)).alias("total_usuarios")))


def review_summary_of_counts(counts: DataFrame, user: str = "username") -> DataFrame:
    """``review_summary`` from a table of (user, n_resenas) that has a row for the null user."""
    return _per_user(counts.agg(
        F.coalesce(F.sum("n_resenas"), F.lit(0)).alias("total_resenas"),
        F.count(C.ref(user)).alias("total_usuarios")))


def _per_user(totals: DataFrame) -> DataFrame:
    mean = F.col("total_resenas") / F.greatest("total_usuarios", F.lit(1))
    return totals.withColumn("promedio_resenas_usuario", F.bround(mean, 2))


def table_size(df: DataFrame, name: str = "total") -> DataFrame:
    return df.agg(n_rows(name))


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """The different values of a column, null being one."""
    return df.select(C.ref(key)).distinct()


def key_counts(df: DataFrame, key: str, table: str) -> DataFrame:
    """``tabla``, number of rows, number of distinct keys; null counts as one key."""
    has_null = F.coalesce(F.max(C.ref(key).isNull().cast("bigint")), F.lit(0))
    return df.agg(
        F.lit(table).alias("tabla"),
        n_rows("n_filas"),
        (F.countDistinct(C.ref(key)) + has_null).alias("n_claves"),
    )


def drop_copies(df: DataFrame) -> DataFrame:
    """Each different row once; nulls are equal to each other."""
    return df.dropDuplicates()


def describe_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per numeric column: count, mean, standard deviation, least and greatest value.

    All columns are measured in one pass, with typed results; ``DataFrame.describe`` gives the
    same figures as text.
    """
    def profile(c: str) -> Column:
        value = C.number(df, c)
        return F.struct(
            F.lit(c).alias("columna"),
            F.count(value).alias("n"),
            F.avg(value).alias("media"),
            F.stddev(value).alias("desviacion"),
            F.min(value).alias("minimo"),
            F.max(value).alias("maximo"),
        )

    wide = df.agg(F.array(*[profile(c) for c in columns]).alias("_p"))
    return wide.select(F.inline("_p"))
