"""Broken records, pages by place, results kept up to date, sketches, mixed types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ratelens.operators import joins, metrics, paging, ranking, ranks, sketches
from ratelens.plans import dashboards, incremental
from ratelens.sources import clustered, frames, publish, readers, writers
from ratelens.sources.records import Records, read_csv_apart
from ratelens.sources.shared import new_folder
from ratelens.sources.unions import union_widened
from suite.cases import SQL_RATINGS, SQL_REVIEWS, case, half_up, ratings, reviews, rounded, table
from suite.pages import SQL_STORED, SQL_VEHICLES, stored, vehicles


# ---- broken records ----------------------------------------------------------------------

# A field is missing, one is too many, or a quote does not close, in some rows.
SQL_LINES = """
    select *, case p_partkey % 10
        when 1 then p_partkey || ',' || p_name || ',' || p_brand
        when 2 then p_partkey || ',"' || p_name || ' ""x"", y",' || p_brand || ',' || p_size || ',9'
        when 3 then p_partkey || ',' || p_brand || ',' || p_size || ',"' || p_name
        else p_partkey || ',"' || p_name || ' ""x"", y",' || p_brand || ',' || p_size end as registro
    from part
"""


def _lines(spark: SparkSession, sf_dir: str) -> Records:
    part, comma = table(spark, sf_dir, "part"), F.lit(",")
    name = F.concat(F.lit('"'), "p_name", F.lit(' ""x"", y"'))
    line = (
        F.when(F.col("p_partkey") % 10 == 1, F.concat("p_partkey", comma, "p_name", comma, "p_brand"))
        .when(F.col("p_partkey") % 10 == 2,
              F.concat("p_partkey", comma, name, comma, "p_brand", comma, "p_size", F.lit(",9")))
        .when(F.col("p_partkey") % 10 == 3,
              F.concat("p_partkey", comma, "p_brand", comma, "p_size", F.lit(',"'), "p_name"))
        .otherwise(F.concat("p_partkey", comma, name, comma, "p_brand", comma, "p_size")))
    path = new_folder(spark, "lines")
    part.select(line.alias("value")).write.text(path)
    return read_csv_apart(spark, path, "k bigint, nombre string, marca string, anio int", header=False)


@case("csv_whole_records", """
    select p_partkey as k, p_name || ' "x", y' as nombre, p_brand as marca, p_size as anio
    from part where p_partkey % 10 not in (1, 2, 3)
""")
def csv_whole_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of a file that are not broken."""
    return _lines(spark, sf_dir).good


@case("csv_broken_records", f"""
    select case p_partkey % 10 when 1 then 'faltan campos' when 2 then 'sobran campos'
           else 'comillas' end as motivo, registro
    from ({SQL_LINES}) where p_partkey % 10 in (1, 2, 3)
""")
def csv_broken_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The others, with the reason."""
    return _lines(spark, sf_dir).bad.select("motivo", "registro")


# ---- published results -------------------------------------------------------------------

@case("published_again", f"with {SQL_STORED} select * from s where n_resenas >= 20")
def published_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A result that replaced another one, read from its place."""
    path, scores = new_folder(spark, "published"), stored(spark, sf_dir)
    writers.write_table(scores, path)
    writers.write_table(scores.where("n_resenas >= 20"), path)
    return publish.read_published(spark, path).withColumnRenamed("vehiculo", "vehiculo_label")


# ---- pages by place ----------------------------------------------------------------------

def _page(df: DataFrame, number: int, n: int, shown: list[str], column: str, ascending: bool) -> DataFrame:
    """Page ``number``, found by going from page to page; the places of n rows are fetched for each."""
    place = None
    for _ in range(number - 1):
        page = paging.seek_page(df, shown, column, shown[0], ascending, n, place)
        place = paging.next_place([r[paging.PLACE] for r in page.collect()], place)
    return paging.seek_page(df, shown, column, shown[0], ascending, n, place).drop(paging.PLACE)


@case("vehicles_third_page", f"""
    with {SQL_VEHICLES} select * from v
    order by promedio_calificacion desc nulls last, id_vehiculo, n_calificaciones, n_resenas limit 100 offset 200
""")
def vehicles_third_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = vehicles(spark, sf_dir)
    return _page(scores, 3, 100, scores.columns, "promedio_calificacion", False)


@case("events_page_of_ties", """
    select event_type, event_id, user_id from events order by event_type, event_id limit 40 offset 120
""")
def events_page_of_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column with few values decides the order, so all rows of a page are ties."""
    return _page(table(spark, sf_dir, "events"), 4, 40, ["event_type", "event_id", "user_id"], "event_type", True)


@case("ratings_page_of_copies", """
    select l_returnflag, l_linestatus from lineitem order by l_returnflag desc, l_linestatus limit 500 offset 1000
""")
def ratings_page_of_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that are alike in all columns."""
    return _page(table(spark, sf_dir, "lineitem"), 3, 500, ["l_returnflag", "l_linestatus"], "l_returnflag", False)


@case("vehicles_clamped", f"""
    with {SQL_STORED} (select vehiculo_label, promedio_calificacion from s
    order by promedio_calificacion desc, vehiculo_label, anio limit 50)
    union all (select vehiculo_label, promedio_calificacion from s
    order by promedio_calificacion desc, vehiculo_label, anio limit 20)
""")
def vehicles_clamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """List lengths as a browser sends them: one too large, one that is no number."""
    scores = stored(spark, sf_dir)
    lists = [dashboards.vehicle_list(scores, top=ranking.clamp_top(asked))["grafica"] for asked in ("75", "muchos")]
    return lists[0].unionAll(lists[1])


# ---- kept up to date ---------------------------------------------------------------------

def _in_two_runs(spark: SparkSession, facts: DataFrame, kind: incremental.Kind, split: str) -> str:
    """The store after a run over some files and one after more have come."""
    source, store = new_folder(spark, "source"), new_folder(spark, "store")
    for i, part in enumerate((split, f"not ({split})")):
        facts.where(part).write.parquet(f"{source}/{i}")
        incremental.update(spark, kind, source, store)
    return store


@case("monthly_ratings_kept", """
    select strftime(l_shipdate, '%Y-%m') as ym, count(*) as n_calif from lineitem group by 1
""")
def monthly_ratings_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _in_two_runs(spark, ratings(spark, sf_dir), incremental.RATINGS, "carroId % 3 = 0")
    return incremental.ratings_report(spark, store)["calificaciones_mensual"]


@case("daily_reviews_kept", """
    select cast(ts as date) as fecha_d, count(*) as n_resenas from events group by 1
""")
def daily_reviews_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _in_two_runs(spark, reviews(spark, sf_dir), incremental.REVIEWS, "length(username) < 3")
    incremental.compact(spark, store)
    return incremental.reviews_report(spark, store)["resenas_diarias"]


@case("user_activity_kept", """
    select cast(user_id as varchar) as usuario, count(*) as n_resenas,
           cast(round(cast(avg(length(event_type)) as decimal(28, 12)), 6) as double) as longitud_media_resena
    from events group by 1
""")
def user_activity_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _in_two_runs(spark, reviews(spark, sf_dir), incremental.REVIEWS, "comentario = 'view'")
    return rounded(incremental.reviews_report(spark, store)["usuarios_agg"], 6, "longitud_media_resena")


# ---- sketches ----------------------------------------------------------------------------

# Six standard errors, and one key for small numbers.
MARGIN = 6 * sketches.standard_error()


@case("users_by_week_about", """
    select date_trunc('week', ts)::date as semana, count(*) as n_filas,
           count(distinct user_id) as n_usuarios, true as cerca
    from events group by 1
""")
def users_by_week_about(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users a week from stored sketches of days, held against the exact number."""
    facts = frames.reviews_by_id(reviews(spark, sf_dir))
    days = joins.stored(sketches.daily_sketches(facts, "fecha_d", "usuario"), "sketches")
    week = F.date_trunc("week", "fecha_d").cast("date").alias("semana")
    exact = facts.groupBy(week).agg(F.countDistinct("usuario").alias("n_usuarios"))
    near = F.abs(F.col("n_claves") - F.col("n_usuarios")) <= 1 + MARGIN * F.col("n_usuarios")
    return sketches.distinct_of_sketches(days, week).join(exact, "semana").select(
        "semana", "n_filas", "n_usuarios", near.alias("cerca"))


@case("review_summary_about", """
    select count(*) as total_resenas, true as cerca from events
""")
def review_summary_about(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = reviews(spark, sf_dir)
    days = joins.stored(sketches.daily_sketches(frames.reviews_by_id(raw), "fecha_d", "usuario"), "sketches")
    exact = metrics.review_summary(raw).select(F.col("total_usuarios").alias("n"))
    return sketches.review_summary_of_sketches(days).select(
        "total_resenas", (F.abs(F.col("total_usuarios") - exact.scalar()) <= 1 + MARGIN * exact.scalar()).alias("cerca"))


@case("coverage_about", """
    select 'lineitem' as tabla, count(*) as n_filas, true as cerca from lineitem
    union all select 'part', count(*), true from part
""")
def coverage_about(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and about how many keys, against the exact numbers."""
    parts = []
    for name, key in (("lineitem", "l_partkey"), ("part", "p_partkey")):
        facts = table(spark, sf_dir, name)
        exact = metrics.key_counts(facts, key, name).select("n_claves").scalar()
        near = F.abs(F.col("n_claves") - exact) <= 1 + MARGIN * exact
        parts.append(sketches.key_counts_about(facts, key, name).select("tabla", "n_filas", near.alias("cerca")))
    return parts[0].unionAll(parts[1])


# ---- mixed types -------------------------------------------------------------------------

@case("union_of_types", """
    select cast(p_partkey as varchar) as id, cast(p_size as double) as anio, p_retailprice as precio,
           null::timestamp as alta, p_name as nombre from part
    union all select 'x' || s_suppkey, s_acctbal, cast(s_suppkey as double), null, null from supplier
    union all select null, null, null, cast(ts as date)::timestamp, null from events
    union all select null, null, null, ts, null from events
""")
def union_of_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A number and a text id, integers and doubles, dates and timestamps, absent columns."""
    part, events = table(spark, sf_dir, "part"), table(spark, sf_dir, "events")
    return union_widened([
        part.select(F.col("p_partkey").alias("id"), F.col("p_size").alias("anio"),
                    F.col("p_retailprice").alias("precio"), F.lit(None).alias("alta"), F.col("p_name").alias("nombre")),
        table(spark, sf_dir, "supplier").select(
            F.concat(F.lit("x"), "s_suppkey").alias("id"), F.col("s_acctbal").alias("anio"),
            F.col("s_suppkey").alias("precio")),
        events.select(F.col("ts").cast("date").alias("alta")),
        events.select(F.col("ts").alias("alta")),
    ])


# ---- places of all, lookups, joins of stored tables --------------------------------------

@case("vehicle_ranks", f"""
    with {SQL_VEHICLES}
    select *, rank() over (order by promedio_calificacion desc nulls last) as rank_promedio,
           rank() over (order by n_resenas desc) as rank_resenas, count(*) over () as n_total
    from v
""")
def vehicle_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The places of all vehicles at once."""
    return ranks.rank_all(vehicles(spark, sf_dir), {
        "rank_promedio": "promedio_calificacion", "rank_resenas": "n_resenas"})


@case("rating_ranks", """
    select l_orderkey, l_linenumber, l_quantity,
           rank() over (order by l_quantity desc) as rank_cantidad, count(*) over () as n_total
    from lineitem
""")
def rating_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fact by a column with fifty values, so all places are shared."""
    facts = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return ranks.rank_all(facts, {"rank_cantidad": "l_quantity"})


@case("vehicle_detail_lookup", f"with {SQL_VEHICLES} select * from v where id_vehiculo = '42'")
def vehicle_detail_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A text id in a table that is laid out for it."""
    path = new_folder(spark, "lookup")
    clustered.write_lookup(vehicles(spark, sf_dir), path, "id_vehiculo")
    return dashboards.vehicle_detail(readers.read_table(spark, path), "42")["detalle"]


@case("rating_review_buckets", f"""
    with a as (select id, {half_up('avg(stars)', 6)} as promedio_calificacion, count(*) as n_calificaciones
               from ({SQL_RATINGS}) group by id),
    b as (select id, count(*) as n_resenas, {half_up('avg(length(comentario))', 1)} as longitud_media_resena
          from ({SQL_REVIEWS}) group by id)
    select coalesce(a.id, b.id) as id_vehiculo, promedio_calificacion, n_calificaciones,
           coalesce(n_resenas, 0) as n_resenas, coalesce(longitud_media_resena, 0.0) as longitud_media_resena
    from a full join b on a.id = b.id
""")
def rating_review_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both aggregates stored in buckets by id and joined bucket by bucket."""
    rated = rounded(metrics.vehicle_ratings(frames.ratings_by_number(ratings(spark, sf_dir))), 6, "promedio_calificacion")
    reviewed = frames.reviews_by_id(reviews(spark, sf_dir))
    reviewed = metrics.vehicle_reviews(reviewed.withColumn("id_vehiculo", F.col("id_vehiculo").try_cast("bigint")))
    sides = []
    for name, side in (("rated", rated), ("reviewed", reviewed)):
        path = new_folder(spark, name)
        clustered.write_bucketed(side, path, "id_vehiculo", 8)
        sides.append(clustered.read_bucketed(spark, path))
    return sides[0].join(sides[1], "id_vehiculo", "full_outer").fillna({"n_resenas": 0, "longitud_media_resena": 0})
