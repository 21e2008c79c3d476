"""Scorecards per vehicle, label, model and brand; key checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ratelens.operators import joins, metrics, ranking
from ratelens.plans import dashboards, reports
from ratelens.sources import frames, writers
from suite.cases import (
    SQL_GAPPY, SQL_RATINGS, SQL_REVIEWS, case, catalogue, gappy_catalogue, half_up, json_id,
    ratings, reviews, rounded, stars, table,
)


# ---- per label and year ------------------------------------------------------------------

def _label_sql(label: str, source: str) -> str:
    return f"""
        with r as ({SQL_RATINGS}), c as ({source})
        select {label} as vehiculo, anio, 'N/A' as estado,
               {half_up('avg(stars)', 2)} as promedio_calificacion, count(*) as n_resenas
        from r join c on r.id = c.id group by 1, 2
    """


SQL_FULL = "select p_partkey as id, p_brand as b, p_name as m, p_size as anio from part"
SQL_LABEL_ID = "coalesce(nullif(trim(concat_ws(' ', b, m)), ''), 'ID ' || cast(c.id as varchar))"
SQL_LABEL_PART = (
    "case when b is not null and m is not null then b || ' ' || m else coalesce(m, b) end")


@case("scorecard_named", _label_sql(SQL_LABEL_ID, SQL_FULL))
def scorecard_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.named_scorecard(
        ratings(spark, sf_dir), catalogue(spark, sf_dir), "id", check_overlap=False)


@case("scorecard_checked", _label_sql(SQL_LABEL_ID, SQL_FULL))
def scorecard_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.named_scorecard(ratings(spark, sf_dir), catalogue(spark, sf_dir), "id")


@case("scorecard_label_id", _label_sql(SQL_LABEL_ID, SQL_GAPPY))
def scorecard_label_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.named_scorecard(
        ratings(spark, sf_dir), gappy_catalogue(spark, sf_dir), "id", check_overlap=False)


@case("scorecard_label_model", _label_sql(SQL_LABEL_PART, SQL_GAPPY))
def scorecard_label_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.named_scorecard(
        ratings(spark, sf_dir), gappy_catalogue(spark, sf_dir), "part", check_overlap=False)


@case("scorecard_label_unknown",
      _label_sql(f"coalesce({SQL_LABEL_PART}, 'Desconocido')", SQL_GAPPY))
def scorecard_label_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.named_scorecard(
        ratings(spark, sf_dir), gappy_catalogue(spark, sf_dir), "unknown", check_overlap=False)


@case("scorecard_duplicate_ids", f"""
    with r as ({SQL_RATINGS}),
    c as (select p_partkey as id, p_brand as b, p_name as m, p_size as anio from part
          union all select p_partkey, p_brand, null, p_size from part
          union all select null, p_brand, p_name, p_size from part)
    select {SQL_LABEL_ID} as vehiculo, anio, 'N/A' as estado,
           {half_up('avg(stars)', 2)} as promedio_calificacion, count(*) as n_resenas
    from r join c on r.id = c.id group by 1, 2
""")
def scorecard_duplicate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every id twice under two labels, and as many rows without an id."""
    full = catalogue(spark, sf_dir)
    twice = (
        full.unionByName(full.withColumn("modelo", F.lit(None).cast("string")))
        .unionByName(full.withColumn("id_vehiculo", F.lit(None).cast("bigint")))
    )
    return reports.named_scorecard(ratings(spark, sf_dir), twice, "id", check_overlap=False)


SQL_ONE_ID = """
    select case when p_size <= 17 then 7 else p_partkey end as id, p_brand as b, p_name as m,
           p_size as anio
    from part
"""


def one_id_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the catalogue rows carry the same id."""
    return catalogue(spark, sf_dir).withColumn(
        "id_vehiculo", F.when(F.col("anio") <= 17, 7).otherwise(F.col("id_vehiculo")))


@case("scorecard_hot_id", _label_sql(SQL_LABEL_ID, SQL_ONE_ID))
def scorecard_hot_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids with 50 rows or more are split into shares; normally a million is hot."""
    return reports.named_scorecard(
        ratings(spark, sf_dir), one_id_catalogue(spark, sf_dir), "id", check_overlap=False,
        hot_rows=50)


@case("scorecard_preview", f"""
    with s as ({_label_sql(SQL_LABEL_ID, SQL_FULL)})
    select * from s order by n_resenas desc, vehiculo, anio limit 5
""")
def scorecard_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = scorecard_named(spark, sf_dir)
    return writers.preview(scores, 5, ranking.falling("n_resenas"))


# ---- whole catalogue, rated or not -------------------------------------------------------

SQL_STAR_EVENTS = """
    select user_id as id,
           case when event_type <> 'error'
                then floor(cast(json_extract_string(props, '$.k') as bigint) / 20) + 1
           end as stars
    from events
"""


def star_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings that cover a part of the catalogue, some of them without stars."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("carroId"),
        F.when(F.col("event_type") != "error", F.floor(json_id().cast("bigint") / 20) + 1)
        .alias("estrellas"))


def named_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id_vehiculo"), F.col("p_name").alias("vehiculo"),
        F.col("p_size").alias("anio"))


@case("catalog_scorecard", f"""
    with a as (select id, avg(stars) as mean, count(*) as n
               from ({SQL_STAR_EVENTS}) where stars is not null group by id)
    select p_partkey as id_vehiculo, p_name as vehiculo_label,
           coalesce({half_up('mean', 6)}, 0.0) as promedio_calificacion,
           coalesce(n, 0) as n_resenas, n is not null as calificado
    from part left join a on p_partkey = id
""")
def catalog_scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = reports.full_catalogue_scorecard(
        star_events(spark, sf_dir), named_parts(spark, sf_dir))
    return rounded(scored, 6, "promedio_calificacion")


@case("catalog_scorecard_hot_id", f"""
    with a as (select id, avg(stars) as mean, count(*) as n
               from ({SQL_STAR_EVENTS}) where stars is not null group by id),
    c as (select case when p_size <= 17 then 7 when p_size > 45 then null else p_partkey end as k,
                 p_name
          from part)
    select k as id_vehiculo, p_name as vehiculo_label,
           coalesce({half_up('mean', 6)}, 0.0) as promedio_calificacion,
           coalesce(n, 0) as n_resenas, n is not null as calificado
    from c left join a on k = id
""")
def catalog_scorecard_hot_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the rows under one id, others without id, many of them alike."""
    hot = named_parts(spark, sf_dir).withColumn(
        "id_vehiculo",
        F.when(F.col("anio") <= 17, 7).when(F.col("anio") <= 45, F.col("id_vehiculo")))
    scored = reports.full_catalogue_scorecard(star_events(spark, sf_dir), hot, hot_rows=50)
    return rounded(scored, 6, "promedio_calificacion")


@case("catalog_scorecard_copies", f"""
    with a as (select id, avg(stars) as mean, count(*) as n
               from ({SQL_STAR_EVENTS}) where stars is not null group by id),
    c as (select * from part union all select * from part union all select * from part)
    select p_partkey as id_vehiculo, p_name as vehiculo_label,
           coalesce({half_up('mean', 6)}, 0.0) as promedio_calificacion,
           coalesce(n, 0) as n_resenas, n is not null as calificado
    from c left join a on p_partkey = id
""")
def catalog_scorecard_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every catalogue row three times; all of them are kept."""
    once = named_parts(spark, sf_dir)
    scored = reports.full_catalogue_scorecard(
        star_events(spark, sf_dir), once.unionByName(once).unionByName(once))
    return rounded(scored, 6, "promedio_calificacion")


@case("coverage_counts", f"""
    select 'catalogo' as tabla, count(*) as n_filas, count(distinct p_partkey) as n_claves
    from part
    union all
    select 'calificaciones', count(*), count(distinct id)
    from ({SQL_STAR_EVENTS}) where stars is not null and id is not null
""")
def coverage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.coverage(star_events(spark, sf_dir), named_parts(spark, sf_dir))


# ---- ratings and reviews side by side ----------------------------------------------------

def gappy_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings with some ids and some stars missing."""
    return table(spark, sf_dir, "lineitem").select(
        F.nullif("l_suppkey", F.lit(7)).alias("carroId"),
        F.when(F.col("l_returnflag") != "R", stars()).alias("estrellas"))


def gappy_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews of vehicles that only partly occur among the ratings, some without id."""
    return table(spark, sf_dir, "events").select(
        (F.nullif("user_id", F.lit(7)) * 2).alias("idVehiculo"),
        F.col("event_type").alias("comentario"))


SQL_GAPPY_FACTS = """
    a as (select cast(nullif(l_suppkey, 7) as varchar) as id,
                 avg(case when l_returnflag <> 'R' then ceil(l_quantity / 10) end) as mean,
                 count(*) as n
          from lineitem group by 1),
    b as (select cast(nullif(user_id, 7) * 2 as varchar) as id, count(*) as n,
                 avg(length(event_type)) as len
          from events group by 1)
"""


@case("rating_review_outer", f"""
    with {SQL_GAPPY_FACTS}
    select coalesce(a.id, b.id) as id_vehiculo,
           {half_up('a.mean', 6)} as promedio_calificacion, a.n as n_calificaciones,
           coalesce(b.n, 0) as n_resenas,
           coalesce({half_up('b.len', 1)}, 0.0) as longitud_media_resena
    from a full join b on a.id = b.id
""")
def rating_review_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = reports.vehicles_report(gappy_ratings(spark, sf_dir), gappy_reviews(spark, sf_dir))
    return rounded(both, 6, "promedio_calificacion")


@case("rating_review_outer_notext", f"""
    with {SQL_GAPPY_FACTS}
    select coalesce(a.id, b.id) as id_vehiculo,
           {half_up('a.mean', 6)} as promedio_calificacion, a.n as n_calificaciones,
           coalesce(b.n, 0) as n_resenas
    from a full join b on a.id = b.id
""")
def rating_review_outer_notext(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = reports.vehicles_report(
        gappy_ratings(spark, sf_dir), gappy_reviews(spark, sf_dir).drop("comentario"))
    return rounded(both, 6, "promedio_calificacion")


@case("rating_only_scorecard", f"""
    with {SQL_GAPPY_FACTS}
    select id as id_vehiculo, {half_up('mean', 6)} as promedio_calificacion,
           n as n_calificaciones, cast(0 as bigint) as n_resenas,
           cast(0 as double) as longitud_media_resena
    from a
""")
def rating_only_scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews that name no vehicle."""
    both = reports.vehicles_report(
        gappy_ratings(spark, sf_dir), gappy_reviews(spark, sf_dir).drop("idVehiculo"))
    return rounded(both, 6, "promedio_calificacion")


# ---- matched by name ---------------------------------------------------------------------

def spelled_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names in two spellings, the first of them twice."""
    names = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("Model"))
    return names.unionByName(names).unionByName(names.select(F.upper("Model").alias("Model")))


SQL_MODELS = """
    select s_name as "Model" from supplier union all select s_name from supplier
    union all select upper(s_name) from supplier
"""


def _raw_name(number: str):
    return F.concat(F.lit("  SUPPLIER#"), F.lpad(F.col(number) + 5, 9, "0"), F.lit(" "))


def _raw_name_sql(number: str) -> str:
    return f"'  SUPPLIER#' || lpad(cast({number} + 5 as varchar), 9, '0') || ' '"


@case("model_rating_by_text", f"""
    with r as (select {_raw_name_sql('l_suppkey')} as raw, ceil(l_quantity / 10) as stars
               from lineitem),
    c as ({SQL_MODELS})
    select "Model", {half_up('avg(stars)', 6)} as promedio_calificacion,
           count(*) as total_calificaciones
    from r left join c on lower(trim(raw)) = lower(trim("Model")) group by 1
""")
def model_rating_by_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "lineitem").select(
        _raw_name("l_suppkey").alias("carroId"), stars().alias("estrellas"))
    return rounded(reports.ratings_by_model(raw, spelled_models(spark, sf_dir)), 6,
                   "promedio_calificacion")


@case("model_review_by_text", f"""
    with r as (select {_raw_name_sql('user_id')} as raw from events), c as ({SQL_MODELS})
    select "Model", count(*) as n_resenas
    from r left join c on lower(trim(raw)) = lower(trim("Model")) group by 1
""")
def model_review_by_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "events").select(_raw_name("user_id").alias("Modelo"))
    return reports.reviews_by_model(raw, spelled_models(spark, sf_dir))


@case("model_rating_hot_name", f"""
    with r as (select {_raw_name_sql('l_suppkey')} as raw, ceil(l_quantity / 10) as stars
               from lineitem),
    c as ({SQL_MODELS})
    select "Model", {half_up('avg(stars)', 6)} as promedio_calificacion,
           count(*) as total_calificaciones
    from r left join c on lower(trim(raw)) = lower(trim("Model")) group by 1
""")
def model_rating_hot_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names with two spellings or more are joined apart."""
    raw = table(spark, sf_dir, "lineitem").select(
        _raw_name("l_suppkey").alias("carroId"), stars().alias("estrellas"))
    return rounded(reports.ratings_by_model(raw, spelled_models(spark, sf_dir), hot_rows=2), 6,
                   "promedio_calificacion")


@case("model_rating_one_spelling", f"""
    with r as (select {_raw_name_sql('l_suppkey')} as raw, ceil(l_quantity / 10) as stars
               from lineitem),
    c as (select lower(trim("Model")) as k, min("Model") as "Model" from ({SQL_MODELS}) group by 1)
    select "Model", {half_up('avg(stars)', 6)} as promedio_calificacion,
           count(*) as total_calificaciones
    from r left join c on lower(trim(raw)) = k group by 1
""")
def model_rating_one_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "lineitem").select(
        _raw_name("l_suppkey").alias("carroId"), stars().alias("estrellas"))
    return rounded(
        reports.ratings_by_model(raw, spelled_models(spark, sf_dir), one_per_key=True), 6,
        "promedio_calificacion")


# ---- keys --------------------------------------------------------------------------------

@case("key_overlap", """
    with l as (select distinct p_partkey as k from part),
         r as (select distinct user_id * 2 as k from events)
    select (select count(*) from l join r using (k)) as n_comunes,
           (select count(*) from l) as n_izquierda, (select count(*) from r) as n_derecha
""")
def key_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    other = table(spark, sf_dir, "events").select((F.col("user_id") * 2).alias("k"))
    return joins.key_overlap(table(spark, sf_dir, "part"), "p_partkey", other, "k")


@case("common_keys", """
    select p_partkey as clave from part intersect select user_id * 2 from events
""")
def common_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    other = table(spark, sf_dir, "events").select((F.col("user_id") * 2).alias("k"))
    return joins.common_keys(table(spark, sf_dir, "part"), "p_partkey", other, "k")


@case("distinct_keys", "select distinct nullif(l_suppkey, 7) as \"carroId\" from lineitem")
def distinct_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.distinct_keys(gappy_ratings(spark, sf_dir), "carroId")


@case("key_counts", """
    select 'calificaciones' as tabla, count(*) as n_filas,
           count(distinct nullif(l_suppkey, 7)) + max(case when l_suppkey = 7 then 1 else 0 end)
               as n_claves
    from lineitem
""")
def key_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.key_counts(gappy_ratings(spark, sf_dir), "carroId", "calificaciones")


# ---- scorecard with all measures, and its brands ------------------------------------------

SQL_SCORES = f"""
    a as (select id, avg(stars) as mean, count(*) as n from ({SQL_STAR_EVENTS}) group by id),
    b as (select id, count(*) as n, avg(length(comentario)) as len
          from ({SQL_REVIEWS}) group by id),
    s as (select p_partkey as id_vehiculo, case when p_size > 5 then p_brand end as marca,
                 mean as promedio_calificacion, coalesce(a.n, 0) as n_calificaciones,
                 coalesce(b.n, 0) as n_resenas,
                 coalesce({half_up('len', 1)}, 0.0) as longitud_media_resena
          from part left join a on p_partkey = a.id left join b on p_partkey = b.id)
"""


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vehicles, some rated, some reviewed, some without a brand."""
    vehicles = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id_vehiculo"),
        F.when(F.col("p_size") > 5, F.col("p_brand")).alias("marca"))
    reviewed = frames.reviews_by_id(reviews(spark, sf_dir))
    return metrics.vehicle_scorecard(
        vehicles, frames.ratings_by_number(star_events(spark, sf_dir)),
        reviewed.withColumn("id_vehiculo", F.col("id_vehiculo").try_cast("bigint")))


@case("vehicle_scorecard", f"""
    with {SQL_SCORES}
    select id_vehiculo, marca, {half_up('promedio_calificacion', 6)} as promedio_calificacion,
           n_calificaciones, n_resenas, longitud_media_resena
    from s
""")
def vehicle_scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(scores(spark, sf_dir), 6, "promedio_calificacion")


SQL_BRANDS = f"""
    {SQL_SCORES},
    g as (select marca,
                 {half_up('''case when sum(n_calificaciones) > 0
                     then coalesce(sum(promedio_calificacion * n_calificaciones), 0)
                          / sum(n_calificaciones) end''', 6)} as rating_promedio,
                 count(distinct id_vehiculo) as n_vehiculos,
                 cast(sum(n_resenas) as bigint) as total_resenas,
                 cast(sum(n_calificaciones) as bigint) as total_calificaciones
          from s group by marca)
"""


def _brand_round(df: DataFrame) -> DataFrame:
    return rounded(df, 6, "rating_promedio")


@case("brand_rollup", f"with {SQL_BRANDS} select * from g")
def brand_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _brand_round(dashboards.brands_page(scores(spark, sf_dir))["tabla"])


@case("brand_rollup_min", f"""
    with {SQL_BRANDS} select * from g
    where total_calificaciones >= (select avg(total_calificaciones) from g)
""")
def brand_rollup_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands with at least the average number of ratings; the bound follows the data."""
    brands = joins.stored(metrics.brand_rollup(scores(spark, sf_dir)), "brands")
    bound = brands.agg(F.avg("total_calificaciones")).scalar()
    return _brand_round(brands.where(F.col("total_calificaciones") >= bound))


@case("brand_support", f"with {SQL_BRANDS} select * from g where total_calificaciones >= 100")
def brand_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _brand_round(dashboards.brands_page(scores(spark, sf_dir), at_least=100)["tabla"])


@case("brand_rollup_simple", f"""
    with {SQL_SCORES}
    select marca, {half_up('avg(promedio_calificacion)', 6)} as rating_promedio,
           count(distinct id_vehiculo) as n_vehiculos,
           cast(sum(n_resenas) as bigint) as total_resenas
    from s group by marca
""")
def brand_rollup_simple(spark: SparkSession, sf_dir: str) -> DataFrame:
    unweighted = scores(spark, sf_dir).drop("n_calificaciones")
    return _brand_round(dashboards.brands_page(unweighted)["tabla"])


@case("brand_search", f"""
    with {SQL_BRANDS} select * from g where regexp_matches(marca, 'brand#1[0-5]$', 'i')
""")
def brand_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _brand_round(
        dashboards.brands_page(scores(spark, sf_dir), query="brand#1[0-5]$")["tabla"])


@case("brand_one_pass", f"with {SQL_BRANDS} select * from g")
def brand_one_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _brand_round(dashboards.brands_page(scores(spark, sf_dir), one_pass=True)["tabla"])


@case("brand_total", f"with {SQL_BRANDS} select count(*) as total from g")
def brand_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.brands_page(scores(spark, sf_dir))["total"]


@case("brand_top_reviews", f"""
    with {SQL_BRANDS} select * from g
    order by total_resenas desc nulls last, marca nulls last limit 5
""")
def brand_top_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    rolled = _brand_round(metrics.brand_rollup(scores(spark, sf_dir)))
    return ranking.top(rolled, 5, ranking.falling("total_resenas"))


@case("brand_top_rating", f"""
    with {SQL_BRANDS} select * from g
    order by rating_promedio desc nulls last, marca nulls last limit 5
""")
def brand_top_rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    rolled = _brand_round(metrics.brand_rollup(scores(spark, sf_dir)))
    return ranking.top(rolled, 5, ranking.falling("rating_promedio"))


@case("brand_detail", f"with {SQL_BRANDS} select * from g where marca = 'Brand#7'")
def brand_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _brand_round(dashboards.brand_detail(scores(spark, sf_dir), "Brand#7")["resumen"])


@case("brand_detail_top_rating", f"""
    with {SQL_SCORES}
    select id_vehiculo, {half_up('promedio_calificacion', 6)} as promedio_calificacion
    from s where marca = 'Brand#7' order by 2 desc nulls last, 1 limit 10
""")
def brand_detail_top_rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = rounded(scores(spark, sf_dir), 6, "promedio_calificacion")
    return dashboards.brand_detail(rated, "Brand#7", n=10)["top_rating"]


@case("brand_detail_top_reviews", f"""
    with {SQL_SCORES}
    select id_vehiculo, n_resenas from s where marca = 'Brand#7'
    order by 2 desc nulls last, 1 limit 10
""")
def brand_detail_top_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.brand_detail(scores(spark, sf_dir), "Brand#7", n=10)["top_resenas"]
