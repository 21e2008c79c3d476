"""What the dashboard pages ask for: filtered, sorted and limited tables.

Each function returns the named parts of a page as lazy DataFrames; the caller fetches those it
shows. Only ``one_pass`` computes something at once: the small table it stores. Lists are cut by
``limit`` only where the page itself is a top list or the caller asks for a page.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ratelens import vocabulary as V
from ratelens.functions import convert as C
from ratelens.functions.match import same_text, search
from ratelens.operators import metrics, paging, ranking
from ratelens.operators.joins import stored
from ratelens.operators.reshape import metrics_long
from ratelens.sources import frames
from ratelens.sources.names import must_pick, pick, project


# ---- vehicles ----------------------------------------------------------------------------

def vehicles_page(raw_scores: DataFrame, query: str = "", order: str = V.BEST,
                  n: int = 20) -> dict[str, DataFrame]:
    """All matching vehicles in a named order, the first n of that order, the n most reviewed."""
    scores = frames.stored_scorecard(raw_scores)
    found = search(scores, C.ref("vehiculo_label"), query)
    chart = found.select("vehiculo_label", "promedio_calificacion", "n_resenas")
    return {
        "vehiculos": ranking.named_order(found, order, copies=True),
        "top": ranking.named_order(chart, order).limit(n),
        "top_resenas": ranking.top(
            found.select("vehiculo_label", "n_resenas"), n, ranking.falling("n_resenas")),
    }


def vehicle_list(raw_scores: DataFrame, query: str = "", order: str = "promedio_calificacion",
                 direction: str = "desc", top: int = ranking.DEFAULT_TOP,
                 page_rows: int | None = None, start: int = 0,
                 after: str | None = None) -> dict[str, DataFrame]:
    """Matching vehicles by any column: their number, the table, the chart of the first ``top``.

    The table is whole, or with ``page_rows`` one page of it, after the first ``start`` rows. With
    ``after``, empty for the first page, it is the page after that place, see ``paging.seek_page``; a
    deep page then costs no more than the first.
    """
    scores = frames.stored_scorecard(raw_scores)
    found = search(scores, C.ref("vehiculo_label"), query)

    def listed(shown: Sequence[str], n: int | None, start: int = 0) -> DataFrame:
        return ranking.column_order(
            found, shown, order, "promedio_calificacion", direction == V.ASCENDING, n, start)

    if after is None:
        table = listed(found.columns, page_rows, start)
    else:
        table = paging.seek_page(found, found.columns, order, "promedio_calificacion",
                                 direction == V.ASCENDING, page_rows or ranking.DEFAULT_TOP, after or None)
    return {
        "total": metrics.table_size(found),
        "tabla": table,
        "grafica": listed(["vehiculo_label", "promedio_calificacion"], top),
    }


def _score_columns(scores: DataFrame) -> tuple[str, str, str | None, str | None]:
    """Names of id, mean, review count and rating count; the last two may be absent."""
    return (
        pick(scores, V.SCORE_ID, default=scores.columns[0]),
        pick(scores, V.SCORE_MEAN, default=scores.columns[min(1, len(scores.columns) - 1)]),
        pick(scores, V.SCORE_REVIEWS),
        pick(scores, V.SCORE_RATINGS),
    )


def vehicle_search(scores: DataFrame, query: str = "", order: str | None = None,
                   n: int = 20) -> dict[str, DataFrame]:
    """Vehicles whose id contains the query, by any column, highest first."""
    key, mean, reviews, ratings = _score_columns(scores)
    found = search(scores, C.ref(key), query)
    wanted = (order or mean).lower()
    shown = [c for c in (key, mean, ratings, reviews) if c]
    chart = ranking.column_order(found, [key, mean], wanted, mean, n=n)
    return {
        "total": metrics.table_size(found),
        "tabla": ranking.column_order(found, shown, wanted, mean),
        "grafica": chart.select(C.text(C.ref(key)).alias("vehiculo_label"), C.ref(mean)),
    }


def vehicle_detail(scores: DataFrame, wanted: str) -> dict[str, DataFrame]:
    """One vehicle by exact id: its row, its measures as rows, its rank. Unknown id: no rows.

    The rank by number of ratings is by mean when the table has no such number.
    """
    key, mean, reviews, ratings = _score_columns(scores)
    shown = [c for c in (key, mean, ratings, reviews) if c]
    renamed = project(scores, {
        key: key, "promedio_calificacion": mean,
        **({"n_calificaciones": ratings} if ratings else {}),
        **({"n_resenas": reviews} if reviews else {}),
    })
    return {
        "detalle": scores.where(same_text(scores, key, wanted)).select(
            *[C.ref(c) for c in shown]),
        "metricas": metrics_long(
            renamed, key, wanted, ["promedio_calificacion", "n_calificaciones", "n_resenas"]),
        "puesto": ranking.rank_of(scores, key, wanted, {
            "rank_promedio": mean, "rank_conteo": ratings or mean}),
    }


# ---- brands ------------------------------------------------------------------------------

def brands_page(scores: DataFrame, query: str = "", at_least: int = 0, n: int = 20,
                one_pass: bool = False) -> dict[str, DataFrame]:
    """Brands with enough ratings: the table by mean, the top by reviews, the top by mean.

    With ``one_pass`` the table of brands is stored and gives all parts.
    """
    brand = must_pick(scores, V.SCORE_BRAND, "brand")
    key, mean, reviews, ratings = _score_columns(scores)
    found = search(scores, C.ref(brand), query)
    brands = metrics.brand_rollup(found, brand, key, mean, ratings, reviews)
    if ratings and at_least > 0:
        brands = ranking.supported(brands, "total_calificaciones", at_least)
    if one_pass:
        brands = stored(brands, "brands-page")
    parts = {
        "total": metrics.table_size(brands),
        "tabla": ranking.report_order(brands, ranking.falling("rating_promedio")),
        "top_rating": ranking.top(brands, n, ranking.falling("rating_promedio")),
    }
    if reviews:
        parts["top_resenas"] = ranking.top(brands, n, ranking.falling("total_resenas"))
    return parts


def brand_detail(scores: DataFrame, wanted: str, at_least: int = 0, n: int = 20,
                 query: str = "") -> dict[str, DataFrame]:
    """One brand by exact name: its summary row, its best and its most reviewed vehicles.

    A brand that the search ``query`` does not find has no rows. The filter comes before the aggregation, so other brands are not summed. ``at_least`` may
    hide the summary row of a brand with few ratings, not its vehicles.
    """
    brand = must_pick(scores, V.SCORE_BRAND, "brand")
    key, mean, reviews, ratings = _score_columns(scores)
    own = search(scores.where(same_text(scores, brand, wanted)), C.ref(brand), query)
    summary = metrics.brand_rollup(own, brand, key, mean, ratings, reviews)
    if ratings and at_least > 0:
        summary = ranking.supported(summary, "total_calificaciones", at_least)
    parts = {
        "resumen": summary,
        "top_rating": ranking.top(own.select(C.ref(key), C.ref(mean)), n, ranking.falling(mean)),
    }
    if reviews:
        parts["top_resenas"] = ranking.top(
            own.select(C.ref(key), C.ref(reviews)), n, ranking.falling(reviews))
    return parts


# ---- ratings and reviews -----------------------------------------------------------------

def ratings_page(raw_ratings: DataFrame, one_pass: bool = False) -> dict[str, DataFrame]:
    """Number and mean of all ratings, and how many there are of each star from 1 to 5.

    Both come from one global aggregation, of which each part computes only what it shows. With
    ``one_pass`` its single row is stored, so that showing both reads the ratings once.
    """
    ratings = frames.star_ratings(raw_ratings)
    totals = metrics.rating_totals("estrellas_num")
    wide = ratings.agg(*totals, *metrics.star_counts("estrellas_num"))
    if one_pass:
        wide = stored(wide, "ratings-page")
    return {
        "resumen": wide.select("total_calif", "promedio_global"),
        "distribucion": metrics.stars_long(wide).select("estrellas", "n"),
    }


def reviews_page(raw_reviews: DataFrame, n: int = 20,
                 one_pass: bool = False) -> dict[str, DataFrame]:
    """Totals of all reviews and the n busiest users.

    With ``one_pass`` the counts per user are stored and give both parts.
    """
    reviews = frames.user_reviews(raw_reviews)
    if one_pass:
        counts = stored(metrics.user_counts(reviews), "reviews-page")
        summary = metrics.review_summary_of_counts(counts)
        named = counts.where(C.ref("username").isNotNull())
    else:
        summary, named = metrics.review_summary(reviews), metrics.named_user_counts(reviews)
    return {
        "resumen": summary,
        "usuarios": ranking.top(named, n, ranking.falling("n_resenas")),
    }


# ---- stored series -----------------------------------------------------------------------

def stored_ratings_page(histogram: DataFrame | None,
                        series: DataFrame | None) -> dict[str, DataFrame]:
    """Star histogram and monthly series from stored results, whichever of them exist, in order.
    """
    parts = {}
    if histogram is not None:
        star, n = pick(histogram, V.STORED_STAR), pick(histogram, V.STORED_STAR_COUNT)
        if star and n:
            parts["distribucion"] = project(
                histogram, {"calificacion": star, "n": n}).orderBy("calificacion")
    if series is not None:
        month, n = pick(series, V.STORED_MONTH), pick(series, V.STORED_MONTH_COUNT)
        if month and n:
            parts["mensual"] = project(
                series, {"ym": C.text(C.ref(month)), "n_calif": n}).orderBy("ym")
    return parts


def stored_reviews_page(daily: DataFrame | None, users: DataFrame | None, query: str = "",
                        n: int = 10) -> dict[str, DataFrame]:
    """Daily series and users, searched by name, busiest first, from stored results."""
    parts = {}
    if daily is not None:
        date, count = pick(daily, V.STORED_DAY), pick(daily, V.STORED_REVIEW_COUNT)
        if date and count:
            parts["diarias"] = project(
                daily, {"fecha_d": C.moment(daily, date), "n_resenas": count}).orderBy("fecha_d")
    if users is not None:
        user, count = pick(users, V.STORED_USER), pick(users, V.STORED_REVIEW_COUNT)
        if user and count:
            found = search(project(users, {"usuario": user, "n_resenas": count}),
                           C.ref("usuario"), query)
            parts["total"] = metrics.table_size(found)
            parts["usuarios"] = ranking.report_order(found, ranking.falling("n_resenas"))
            parts["top"] = ranking.top(found, n, ranking.falling("n_resenas"))
    return parts
