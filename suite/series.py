"""Histograms, series, user activity and one-row summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ratelens.operators import metrics
from ratelens.plans import dashboards, reports
from ratelens.sources import frames
from suite.cases import case, half_up, ratings, reviews, rounded, stars, table


# ---- stars -------------------------------------------------------------------------------

@case("star_histogram", """
    select case when l_returnflag <> 'R' then ceil(l_quantity / 10) end as calificacion,
           count(*) as n
    from lineitem group by 1
""")
def star_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_returnflag") != "R", stars()).alias("Estrellas"))
    return reports.ratings_report(raw)["distribucion_estrellas"]


def _dense_sql(value: str) -> str:
    return f"""
        select cast(s.s as int) as estrellas, count(l_quantity) as n
        from generate_series(1, 5) as s(s)
        left join lineitem on round_even({value}, 0) = s.s
        group by s.s
    """


@case("star_histogram_dense", _dense_sql("l_quantity / 10"))
def star_histogram_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "lineitem").select((F.col("l_quantity") / 10).alias("estrellas"))
    return dashboards.ratings_page(raw)["distribucion"]


@case("star_histogram_sparse", _dense_sql("l_quantity / 25"))
def star_histogram_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No rating reaches three stars; the empty ones still appear."""
    raw = table(spark, sf_dir, "lineitem").select((F.col("l_quantity") / 25).alias("estrellas"))
    return dashboards.ratings_page(raw)["distribucion"]


SQL_DIRTY_STARS = """
    select case when l_returnflag = 'R' then null else l_quantity end as v from lineitem
"""


@case("rating_summary", f"""
    select count(*) as total_calif, round_even(avg(v), 2) as promedio_global
    from ({SQL_DIRTY_STARS})
""")
def rating_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some ratings are not numbers: they count, but not in the mean."""
    raw = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_returnflag") == "R", "sin dato").otherwise(
            F.col("l_quantity").cast("string")).alias("Num_Estrellas"))
    return dashboards.ratings_page(raw)["resumen"]


# ---- days and months ---------------------------------------------------------------------

@case("monthly_ratings", """
    select strftime(l_shipdate, '%Y-%m') as ym, count(*) as n_calif from lineitem group by 1
""")
def monthly_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.ratings_report(ratings(spark, sf_dir))["calificaciones_mensual"]


@case("daily_reviews", """
    select cast(ts as date) as fecha_d, count(*) as n_resenas from events group by 1
""")
def daily_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.reviews_report(reviews(spark, sf_dir))["resenas_diarias"]


@case("daily_reviews_undated", """
    select case when event_type <> 'error' then cast(ts as date) end as fecha_d,
           count(*) as n_resenas
    from events group by 1
""")
def daily_reviews_undated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates as text, some of them unreadable."""
    raw = table(spark, sf_dir, "events").select(
        F.when(F.col("event_type") == "error", "sin fecha").otherwise(
            F.col("ts").cast("string")).alias("creadoEn"))
    return reports.reviews_report(raw)["resenas_diarias"]


@case("monthly_ratings_one_pass", """
    select strftime(l_shipdate, '%Y-%m') as ym, count(*) as n_calif from lineitem group by 1
""")
def monthly_ratings_one_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the counts per star and month, which give the histogram too."""
    return reports.ratings_report(ratings(spark, sf_dir), one_pass=True)["calificaciones_mensual"]


# ---- users -------------------------------------------------------------------------------

@case("user_activity", f"""
    select conv_id as usuario, count(*) as n_resenas,
           {half_up('avg(length(text))', 6)} as longitud_media_resena
    from conversations group by 1
""")
def user_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("userName"), F.col("text").alias("texto"),
        F.lit("2024-01-01").alias("fecha")).withColumnRenamed("userName", "user")
    return rounded(reports.reviews_report(raw)["usuarios_agg"], 6, "longitud_media_resena")


@case("user_activity_documents", f"""
    select source as usuario, count(*) as n_resenas,
           {half_up('avg(length(text))', 6)} as longitud_media_resena
    from documents group by 1
""")
def user_activity_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "documents").select(
        F.col("source").alias("Author"), F.col("text").alias("Reseña"))
    users = metrics.user_activity(frames.reviews_by_id(raw))
    return rounded(users, 6, "longitud_media_resena")


@case("user_activity_count", """
    select nullif(cast(user_id as varchar), '7') as usuario, count(*) as n_resenas
    from events group by 1
""")
def user_activity_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No text, and reviews without a user form a group of their own."""
    raw = reviews(spark, sf_dir).select(
        F.nullif("username", F.lit("7")).alias("username"), "fecha")
    return reports.reviews_report(raw)["usuarios_agg"]


@case("named_user_counts", """
    select cast(user_id as varchar) as username, count(*) as n_resenas
    from events where user_id <> 7 group by 1
""")
def named_user_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews without a user are left out."""
    raw = reviews(spark, sf_dir).withColumn("username", F.nullif("username", F.lit("7")))
    return metrics.named_user_counts(frames.user_reviews(raw))


@case("top_users", """
    select cast(user_id as varchar) as username, count(*) as n_resenas
    from events group by 1 order by 2 desc, 1 limit 20
""")
def top_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.reviews_page(reviews(spark, sf_dir))["usuarios"]


@case("review_summary", """
    select count(*) as total_resenas, count(distinct nullif(user_id, 7)) as total_usuarios,
           round_even(count(*) / greatest(count(distinct nullif(user_id, 7)), 1), 2)
               as promedio_resenas_usuario
    from events
""")
def review_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = reviews(spark, sf_dir).withColumn("username", F.nullif("username", F.lit("7")))
    return dashboards.reviews_page(raw)["resumen"]


@case("review_summary_one_pass", """
    select count(*) as total_resenas, count(distinct nullif(user_id, 7)) as total_usuarios,
           round_even(count(*) / greatest(count(distinct nullif(user_id, 7)), 1), 2)
               as promedio_resenas_usuario
    from events
""")
def review_summary_one_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the counts per user, which give the busiest users too."""
    raw = reviews(spark, sf_dir).withColumn("username", F.nullif("username", F.lit("7")))
    return dashboards.reviews_page(raw, one_pass=True)["resumen"]


# ---- statistics of a table ---------------------------------------------------------------

def _profile_sql(table_name: str, column: str, digits: int) -> str:
    return f"""
        select '{column}' as columna, count({column}) as n,
               {half_up(f'avg({column})', digits)} as media,
               {half_up(f'stddev({column})', digits)} as desviacion,
               cast(min({column}) as double) as minimo, cast(max({column}) as double) as maximo
        from {table_name}
    """


def _profiles_sql(table_name: str, digits: int, *columns: str) -> str:
    return " union all ".join(_profile_sql(table_name, c, digits) for c in columns)


@case("table_describe", _profiles_sql("customer", 6, "c_custkey", "c_nationkey", "c_acctbal"))
def table_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = table(spark, sf_dir, "customer")
    profile = metrics.describe_numbers(users, ["c_custkey", "c_nationkey", "c_acctbal"])
    return rounded(profile, 6, "media", "desviacion")


@case("ratings_describe", _profiles_sql("lineitem", 8, "l_quantity", "l_linenumber", "l_tax"))
def ratings_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = table(spark, sf_dir, "lineitem")
    profile = metrics.describe_numbers(facts, ["l_quantity", "l_linenumber", "l_tax"])
    return rounded(profile, 8, "media", "desviacion")


@case("users_describe", f"""
    select 'count' as summary, cast(count(c_acctbal) as double) as c_acctbal,
           cast(count(c_name) as varchar) as c_name from customer
    union all select 'mean', {half_up('avg(c_acctbal)', 6)}, null from customer
    union all select 'stddev', {half_up('stddev(c_acctbal)', 6)}, null from customer
    union all select 'min', min(c_acctbal), min(c_name) from customer
    union all select 'max', max(c_acctbal), max(c_name) from customer
""")
def users_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text form of the statistics, its numbers read back to compare them."""
    users = table(spark, sf_dir, "customer").select("c_acctbal", "c_name")
    return reports.users_profile(users)["describe"].select(
        "summary", F.round(F.col("c_acctbal").try_cast("double"), 6).alias("c_acctbal"), "c_name")


@case("users_total", "select count(*) as total from customer")
def users_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.users_profile(table(spark, sf_dir, "customer"))["total"]
