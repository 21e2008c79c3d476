"""Sources, sinks, column names, conversions and sampling."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ratelens.functions import convert as C
from ratelens.operators import metrics, ranking
from ratelens.operators.sampling import hash_sample
from ratelens.plans import dashboards, jobs, reports
from ratelens.sources import frames, names, readers, writers
from ratelens.sources.shared import new_folder
from suite.cases import SQL_RATINGS, case, half_up, ratings, reviews, rounded, table


# ---- files written and read back ---------------------------------------------------------

PART_SCHEMA = ("p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
               "p_retailprice double")


@case("csv_roundtrip", "select * from part")
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "parts-csv")
    writers.write_csv(table(spark, sf_dir, "part"), path)
    return readers.read_csv(spark, path, PART_SCHEMA)


@case("csv_text_roundtrip", "select * from conversations")
def csv_text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts with quotes, commas, line breaks and outer blanks."""
    path = new_folder(spark, "texts-csv")
    writers.write_csv(table(spark, sf_dir, "conversations"), path)
    return readers.read_csv(
        spark, path, "conv_id bigint, turn bigint, role string, text string")


@case("csv_reviews_report", """
    select role as usuario, count(*) as n_resenas,
           cast(round(cast(avg(length(text)) as decimal(28, 12)), 6) as double)
               as longitud_media_resena
    from conversations group by 1
""")
def csv_reviews_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews whose texts hold line breaks, written and read by defaults, then reported on."""
    path = new_folder(spark, "reviews-csv")
    writers.write_csv(table(spark, sf_dir, "conversations").select(
        F.col("role").alias("username"), F.col("text").alias("comentario"),
        F.lit("2024-01-02").alias("fecha"), F.col("conv_id").alias("idVehiculo")), path)
    users = jobs.report_by_view(spark, "resenas", reviews=path)["usuarios_agg"]
    return rounded(users, 6, "longitud_media_resena")


@case("csv_untyped", """
    select cast(c_custkey as varchar) as c_custkey, c_name, c_acctbal from customer
""")
def csv_untyped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No schema given: everything is text until converted."""
    path = new_folder(spark, "users-csv")
    writers.write_csv(table(spark, sf_dir, "customer"), path)
    raw = readers.read_csv(spark, path)
    return raw.select("c_custkey", "c_name", C.number(raw, "c_acctbal").alias("c_acctbal"))


@case("sorted_export", f"""
    select id as id_vehiculo, {half_up('avg(stars)', 6)} as promedio_calificacion,
           count(*) as n_calificaciones
    from ({SQL_RATINGS}) group by 1
""")
def sorted_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = metrics.vehicle_ratings(frames.ratings_by_number(ratings(spark, sf_dir)))
    path = new_folder(spark, "sorted-csv")
    writers.write_sorted(scored, path, ranking.falling("promedio_calificacion"))
    back = readers.read_csv(spark, path, scored.schema)
    return back.withColumn("promedio_calificacion", F.round("promedio_calificacion", 6))


@case("report_file", """
    select cast(user_id as varchar) as username, count(*) as n_resenas
    from events group by 1 order by 2 desc, 1 limit 20
""")
def report_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A top list as a single file."""
    users = dashboards.reviews_page(reviews(spark, sf_dir))["usuarios"]
    path = new_folder(spark, "top-users-csv")
    writers.write_report(users, path, at_most=20)
    return readers.read_csv(spark, path, "username string, n_resenas bigint")


@case("two_places", """
    select cast(ts as date) as fecha_d, count(*) as n_resenas from events group by 1
""")
def two_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report saved to two folders; the second is read back."""
    first, second = new_folder(spark, "first"), new_folder(spark, "second")
    report = reports.reviews_report(reviews(spark, sf_dir))
    jobs.save({"resenas_diarias": report["resenas_diarias"]}, first, second,
              write=writers.write_csv)
    return readers.read_csv(spark, f"{second}/resenas_diarias", "fecha_d date, n_resenas bigint")


@case("stored_histogram", """
    select ceil(l_quantity / 10) as calificacion, count(*) as n from lineitem group by 1
""")
def stored_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "histogram")
    writers.write_table(
        reports.ratings_report(ratings(spark, sf_dir))["distribucion_estrellas"], path)
    return dashboards.stored_ratings_page(readers.read_table(spark, path), None)["distribucion"]


@case("stored_months", """
    select strftime(l_shipdate, '%Y-%m') as ym, count(*) as n_calif from lineitem group by 1
""")
def stored_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The month column survives a CSV file as text, because it is read with a schema."""
    path = new_folder(spark, "months-csv")
    writers.write_csv(
        reports.ratings_report(ratings(spark, sf_dir))["calificaciones_mensual"], path)
    series = readers.read_csv(spark, path, "ym string, n_calif bigint")
    return dashboards.stored_ratings_page(None, series)["mensual"]


@case("stored_days", """
    select date_trunc('day', ts)::timestamp as fecha_d, count(*) as n_resenas
    from events group by 1
""")
def stored_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "days-csv")
    writers.write_csv(reports.reviews_report(reviews(spark, sf_dir))["resenas_diarias"], path)
    daily = readers.read_csv(spark, path, "fecha_d string, n_resenas bigint")
    return dashboards.stored_reviews_page(daily, None)["diarias"]


@case("stored_users_total", "select count(distinct user_id) as total from events")
def stored_users_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "users")
    writers.write_table(reports.reviews_report(reviews(spark, sf_dir))["usuarios_agg"], path)
    return dashboards.stored_reviews_page(None, readers.read_table(spark, path))["total"]


@case("source_total", "select count(*) as total, 'guardado' as origen from part")
def source_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table is missing, so the stored one is counted."""
    return readers.source_total(
        spark, lambda: readers.read_table(spark, f"{sf_dir}/no_such_table.parquet"),
        lambda: table(spark, sf_dir, "part"))


@case("source_freshness", """
    select 'part.parquet' as archivo, count(*) as n_filas, true as con_fecha from part
    union all select 'supplier.parquet', count(*), true from supplier
    union all select 'customer.parquet', count(*), true from customer
""")
def source_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files, their rows and whether their time is known, of three tables as they are read."""
    files = [readers.read_files(table(spark, sf_dir, t)) for t in ("part", "supplier", "customer")]
    return readers.union_by_name(files).select(
        "archivo", "n_filas", F.col("modificado").isNotNull().alias("con_fecha"))


@case("source_required", """
    select 'PATH_NOT_FOUND' as condicion, count(*) as n_filas from part
""")
def source_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A required table that is there is read; one that is not fails by this condition."""
    try:
        readers.read_table(spark, f"{sf_dir}/no_such_table.parquet")
        condition = None
    except AnalysisException as problem:
        condition = problem.getCondition()
    return table(spark, sf_dir, "part").agg(
        F.lit(condition).alias("condicion"), F.count(F.lit(1)).alias("n_filas"))


@case("source_empty_catalogue", """
    select cast(p_partkey as varchar) as id_vehiculo, p_brand as marca, p_name as nombre_vehiculo
    from part
""")
def source_empty_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed catalogue without rows, which missing files give, united with one from a table."""
    empty = reports.build_catalogue(spark, [f"{sf_dir}/no_such_*.csv"])
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("id"), F.col("p_brand").alias("make"),
        F.col("p_name").alias("modelo"))
    return empty.unionByName(reports.catalogue_from(parts))


@case("users_profile_run", """
    select summary, c_custkey, c_name from (
        select 'count' as summary, cast(count(c_custkey) as varchar) as c_custkey,
               cast(count(c_name) as varchar) as c_name, 1 as k from customer
        union all select 'min', min(cast(c_custkey as varchar)), min(c_name), 2 from customer
        union all select 'max', max(cast(c_custkey as varchar)), max(c_name), 3 from customer)
""")
def users_profile_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The users by name of the run: their statistics, as text."""
    path = new_folder(spark, "users-csv")
    writers.write_csv(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), path)
    run = jobs.report_by_type(spark, "usuarios", autos=path, users=path)
    return run["usuarios_describe"].where("summary in ('count', 'min', 'max')")


# ---- catalogue ---------------------------------------------------------------------------

@case("catalog_union_dedup", """
    select p_partkey as id_vehiculo, p_brand as marca, p_name as nombre_vehiculo from part
    union all select p_partkey, null, p_name from part
""")
def catalog_union_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three sources: one padded, its copy, and one without brands."""
    parts = table(spark, sf_dir, "part")
    padded = parts.select(
        F.col("p_partkey").alias("id_auto"),
        F.concat(F.lit("\t"), "p_brand", F.lit(" ")).alias("brand"),
        F.concat(F.lit(" "), "p_name", F.lit("\n")).alias("descripcion"))
    unbranded = parts.select(
        F.col("p_partkey").alias("id_auto"), F.col("p_name").alias("descripcion"))
    return reports.catalogue_from(readers.union_by_name([padded, unbranded, padded]))


@case("catalog_files", """
    select cast(p_partkey as varchar) as id_vehiculo, p_brand as marca,
           p_name as nombre_vehiculo
    from part
    union all select cast(p_partkey as varchar), null, p_type from part
""")
def catalog_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two groups of CSV files with different columns, and a third that is not there."""
    parts, base = table(spark, sf_dir, "part"), new_folder(spark, "catalogue-csv")
    writers.write_csv(parts.select(
        F.col("p_partkey").alias("id"), F.col("p_brand").alias("make"),
        F.col("p_name").alias("modelo")), f"{base}/a")
    writers.write_csv(parts.select(
        F.col("p_type").alias("modelo"), F.col("p_partkey").alias("id")), f"{base}/b")
    return reports.build_catalogue(
        spark, [f"{base}/a/*.csv", f"{base}/b/*.csv", f"{base}/c/*.csv"])


def _autos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("Model"),
        F.col("p_size").alias("Year"), F.col("p_type").alias("Status"),
        F.col("p_retailprice").alias("Price"), F.round(F.col("p_retailprice") * 2, 2).alias("MSRP"))


@case("catalog_projection", """
    select p_name as "Model", p_size as "Year", p_type as "Status", p_retailprice as "Price",
           cast(round(cast(p_retailprice * 2 as decimal(28, 12)), 2) as double) as "MSRP"
    from part
""")
def catalog_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.catalogue_listing(_autos(spark, sf_dir))


# ---- sampling ----------------------------------------------------------------------------

SQL_HASH = "cast('0x' || substr(md5('42|' || cast(p_partkey as varchar)), 1, 8) as bigint)"
SQL_DRAWN = f"part where {SQL_HASH} < 214748364"


@case("hash_sample", f"select p_partkey, p_name, p_brand from {SQL_DRAWN}")
def hash_sample_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    return hash_sample(parts, ["p_partkey"], 0.05)


@case("hash_sample_capped", f"""
    select p_partkey, p_name from {SQL_DRAWN} order by {SQL_HASH}, p_partkey limit 50
""")
def hash_sample_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return hash_sample(parts, ["p_partkey"], 0.05, at_most=50)


@case("sampled_catalogue", f"""
    with d as (select * from {SQL_DRAWN}),
    a as (select id, avg(stars) as mean, count(*) as n from ({SQL_RATINGS}) group by id)
    select p_name as vehiculo, p_size as anio, p_type as estado,
           coalesce({half_up('mean', 2)}, 0.0) as promedio_calificacion,
           coalesce(n, 0) as n_resenas
    from d left join a on p_partkey = id
""")
def sampled_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.sampled_catalogue(
        _autos(spark, sf_dir), frames.ratings_by_number(ratings(spark, sf_dir)), "id")


# ---- conversions -------------------------------------------------------------------------

@case("coerced_values", """
    with t as (
        select event_id, case when event_type = 'error' then 'bad'
                              when event_type = 'view' then 'NaN'
                              when event_id % 7 = 0 then cast(round(value) as varchar) || 'e2'
                              when event_id % 7 = 1 then '-' || cast(value as varchar)
                              when event_id % 7 = 2 then ' ' || cast(value as varchar) || ' '
                              when event_id % 7 = 3 then ''
                              else cast(value as varchar) end as v,
               case event_type when 'error' then 'x' else cast(ts as varchar) end as d
        from events)
    select event_id, nullif(try_cast(v as double), 'NaN'::double) as numero,
           coalesce(nullif(try_cast(v as double), 'NaN'::double), 0.0) as numero_o_cero,
           cast(trunc(nullif(try_cast(v as double), 'NaN'::double)) as bigint) as entero,
           cast(0 as bigint) as ausente,
           try_cast(d as date) as dia, try_cast(d as timestamp) as momento
    from t
""")
def coerced_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers and dates kept as text: exponents, signs, blanks, nothing, and some unreadable."""
    kind = F.col("event_type")
    raw = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(kind == "error", "bad").when(kind == "view", "NaN")
        .when(F.col("event_id") % 7 == 0, F.concat(F.round("value").cast("string"), F.lit("e2")))
        .when(F.col("event_id") % 7 == 1, F.concat(F.lit("-"), F.col("value").cast("string")))
        .when(F.col("event_id") % 7 == 2, F.concat(F.lit(" "), F.col("value").cast("string"), F.lit(" ")))
        .when(F.col("event_id") % 7 == 3, "")
        .otherwise(F.col("value").cast("string")).alias("v"),
        F.when(kind == "error", "x").otherwise(F.col("ts").cast("string")).alias("d"))
    return names.project(raw, {
        "event_id": "event_id",
        "numero": C.number(raw, "v"),
        "numero_o_cero": C.number_or_zero(raw, "v"),
        "entero": C.whole(raw, "v"),
        "ausente": C.whole_or_zero(raw, "no_such_column"),
        "dia": C.day(raw, "d"),
        "momento": C.moment(raw, "d"),
    })


# ---- column names ------------------------------------------------------------------------

@case("normalized_columns", """
    select event_id as carro_id, event_type as resena, ts as creado_en, user_id as id_usuario
    from events
""")
def normalized_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("carroId"), F.col("event_type").alias("Reseña"),
        F.col("ts").alias("creado en"), F.col("user_id").alias("id-Usuario"))
    renamed = names.snake_columns(raw)
    names.require(renamed, ["carro_id", "resena", "creado_en", "id__usuario"])
    return renamed.withColumnRenamed("id__usuario", "id_usuario")


@case("picked_columns", """
    select event_id as id_vehiculo, event_type as resena,
           cast(ts as date) as fecha_d, user_id as usuario
    from events
""")
def picked_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns found by alias, in order of priority when several are there."""
    raw = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("carroId"), F.col("value").alias("idvehiculo"),
        F.col("event_type").alias("Comentario"), F.col("ts").alias("Fecha"),
        F.lit("no").alias("createdAt"), F.col("user_id").alias("Username"))
    return frames.reviews_by_id(raw)


@case("discovered_scorecard", """
    select p_name as vehiculo_label, p_retailprice as promedio_calificacion,
           cast(p_size as bigint) as n_resenas, p_brand as marca
    from part
""")
def discovered_scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.stored_scorecard(table(spark, sf_dir, "part").select(
        F.col("p_name").alias("Nombre_Auto"), F.col("p_retailprice").alias("Avg_Rating"),
        F.col("p_size").cast("string").alias("Total_Reseñas"), F.col("p_brand").alias("marca")))


@case("discovered_ratings", """
    select l_partkey as auto, cast(l_quantity as varchar) as "Total_Estrellas",
           l_shipdate as fecha_alta, l_quantity as estrellas_num
    from lineitem
""")
def discovered_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.star_ratings(table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("auto"),
        F.col("l_quantity").cast("string").alias("Total_Estrellas"),
        F.col("l_shipdate").cast("string").alias("fecha_alta")))


@case("discovered_reviews", """
    select cast(user_id as varchar) as username, event_type as comentario, ts as fecha
    from events
""")
def discovered_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.user_reviews(table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("username"),
        F.col("event_type").alias("Mi_Comentario"), F.col("ts").cast("string").alias("fecha")))
