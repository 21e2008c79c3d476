"""Searches, sort orders, top lists, detail and rank, as the dashboard pages ask for them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ratelens.functions.match import search
from ratelens.operators import joins, metrics, ranking, reshape
from ratelens.plans import dashboards, reports
from suite.cases import SQL_RATINGS, case, catalogue, half_up, ratings, reviews, rounded, table

# ---- vehicles by named order -------------------------------------------------------------

SQL_STORED = f"""
    s as (select trim(p_brand || ' ' || p_name) as vehiculo_label, p_size as anio,
                 'N/A' as estado, {half_up('avg(stars)', 2)} as promedio_calificacion,
                 count(*) as n_resenas
          from ({SQL_RATINGS}) join part on id = p_partkey group by 1, 2)
"""
QUERY = "bolt|RING"
SQL_FOUND = "s where regexp_matches(vehiculo_label, 'bolt|ring', 'i')"


def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.named_scorecard(
        ratings(spark, sf_dir), catalogue(spark, sf_dir), check_overlap=False)


def _order_case(name: str, order: str, sql_order: str) -> None:
    @case(name, f"""
        with {SQL_STORED}
        select vehiculo_label, promedio_calificacion, n_resenas from {SQL_FOUND}
        order by {sql_order}, vehiculo_label, anio limit 20
    """)
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return dashboards.vehicles_page(stored(spark, sf_dir), QUERY, order)["top"]


_order_case("vehicles_best", "mejor", "promedio_calificacion desc, n_resenas desc")
_order_case("vehicles_worst", "peor", "promedio_calificacion, n_resenas desc")
_order_case("vehicles_most", "mas_resenas", "n_resenas desc, promedio_calificacion desc")
_order_case("vehicles_least", "menos_resenas", "n_resenas, promedio_calificacion desc")


@case("vehicles_listing", f"with {SQL_STORED} select * from {SQL_FOUND}")
def vehicles_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.vehicles_page(stored(spark, sf_dir), QUERY)["vehiculos"]


@case("vehicles_top_reviews", f"""
    with {SQL_STORED} select vehiculo_label, n_resenas from s
    order by n_resenas desc, vehiculo_label, anio limit 20
""")
def vehicles_top_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.vehicles_page(stored(spark, sf_dir))["top_resenas"]


# ---- vehicles by any column --------------------------------------------------------------

@case("vehicles_any_order", f"""
    with {SQL_STORED} select vehiculo_label, promedio_calificacion from s
    order by anio, vehiculo_label limit 400
""")
def vehicles_any_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.vehicle_list(
        stored(spark, sf_dir), order="anio", direction="asc", top=400)["grafica"]


@case("vehicles_table", f"with {SQL_STORED} select * from s")
def vehicles_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table. An unknown column is asked for, so the mean decides."""
    return dashboards.vehicle_list(stored(spark, sf_dir), order="no_existe")["tabla"]


@case("vehicles_table_page", f"""
    with {SQL_STORED} select * from s
    order by promedio_calificacion desc, vehiculo_label, anio limit 300 offset 200
""")
def vehicles_table_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """300 rows after the first 200."""
    return dashboards.vehicle_list(stored(spark, sf_dir), page_rows=300, start=200)["tabla"]


@case("vehicles_unknown_order", f"""
    with {SQL_STORED}
    select vehiculo_label, promedio_calificacion, n_resenas from s
    order by promedio_calificacion desc, n_resenas desc, vehiculo_label, anio limit 20
""")
def vehicles_unknown_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order that nobody knows is the best first."""
    return dashboards.vehicles_page(stored(spark, sf_dir), order="otro")["top"]


@case("vehicles_count", f"with {SQL_STORED} select count(*) as total from {SQL_FOUND}")
def vehicles_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.vehicle_list(stored(spark, sf_dir), QUERY)["total"]


# ---- one vehicle -------------------------------------------------------------------------

SQL_VEHICLES = f"""
    a as (select id, avg(stars) as mean, count(*) as n from ({SQL_RATINGS}) group by id),
    b as (select cast(json_extract_string(props, '$.k') as bigint) as id, count(*) as n
          from events group by 1),
    v as (select cast(coalesce(a.id, b.id) as varchar) as id_vehiculo,
                 {half_up('mean', 6)} as promedio_calificacion,
                 a.n as n_calificaciones, coalesce(b.n, 0) as n_resenas
          from a full join b on a.id = b.id)
"""


def vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scorecard as a stored table, which the pages read; an id then is a filter on the scan."""
    both = reports.vehicles_report(
        ratings(spark, sf_dir), reviews(spark, sf_dir).drop("comentario"))
    return joins.stored(rounded(both, 6, "promedio_calificacion"), "vehicles")


@case("vehicle_search", f"""
    with {SQL_VEHICLES} select * from v where id_vehiculo like '%1%'
""")
def vehicle_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.vehicle_search(vehicles(spark, sf_dir), "1", order="N_Resenas")["tabla"]


@case("vehicle_search_top", f"""
    with {SQL_VEHICLES}
    select id_vehiculo as vehiculo_label, promedio_calificacion from v
    order by promedio_calificacion desc nulls last, id_vehiculo limit 20
""")
def vehicle_search_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.vehicle_search(vehicles(spark, sf_dir))["grafica"]


@case("vehicle_detail", f"with {SQL_VEHICLES} select * from v where id_vehiculo = '42'")
def vehicle_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.vehicle_detail(vehicles(spark, sf_dir), "42")["detalle"]


SQL_METRICS = """
    select id_vehiculo, 'promedio_calificacion' as metrica,
           coalesce(promedio_calificacion, 0.0) as valor from m
    union all
    select id_vehiculo, 'n_calificaciones', cast(coalesce(n_calificaciones, 0) as double) from m
    union all
    select id_vehiculo, 'n_resenas', cast(n_resenas as double) from m
"""


@case("vehicle_metrics_long", f"""
    with {SQL_VEHICLES}, m as (select * from v where id_vehiculo = '42') {SQL_METRICS}
""")
def vehicle_metrics_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.vehicle_detail(vehicles(spark, sf_dir), "42")["metricas"]


@case("vehicle_rank", f"""
    with {SQL_VEHICLES}, m as (select * from v where id_vehiculo = '42')
    select '42' as id_vehiculo,
           1 + count(*) filter (v.promedio_calificacion > m.promedio_calificacion)
               as rank_promedio,
           1 + count(*) filter (v.n_calificaciones > m.n_calificaciones) as rank_conteo,
           count(*) as n_total
    from v, m
""")
def vehicle_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.vehicle_detail(vehicles(spark, sf_dir), "42")["puesto"]


@case("vehicle_rank_by_reviews", f"""
    with {SQL_VEHICLES}, m as (select * from v where id_vehiculo = '7')
    select '7' as id_vehiculo, 1 + count(*) filter (v.n_resenas > m.n_resenas) as rank_resenas,
           count(*) as n_total
    from v, m
""")
def vehicle_rank_by_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.rank_of(
        vehicles(spark, sf_dir), "id_vehiculo", "7", {"rank_resenas": "n_resenas"})


# ---- best and worst with enough ratings --------------------------------------------------

@case("top_supported", f"""
    with {SQL_VEHICLES} select * from v where n_calificaciones >= 25
    order by promedio_calificacion desc, id_vehiculo limit 11
""")
def top_supported(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.top_supported(vehicles(spark, sf_dir), 11, at_least=25)


@case("bottom_supported", f"""
    with {SQL_VEHICLES} select * from v where n_calificaciones >= 25
    order by promedio_calificacion, id_vehiculo limit 11
""")
def bottom_supported(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.top_supported(vehicles(spark, sf_dir), 11, at_least=25, worst=True)


# ---- text search -------------------------------------------------------------------------

@case("user_search", """
    select source as usuario, count(*) as n_resenas
    from documents where regexp_matches(source, 'SRC1.', 'i') group by 1
""")
def user_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = table(spark, sf_dir, "documents").groupBy(F.col("source").alias("username")).agg(
        F.count(F.lit(1)).alias("n_resenas"))
    return dashboards.stored_reviews_page(None, users, query="SRC1.")["usuarios"]


@case("user_search_top", """
    select source as usuario, count(*) as n_resenas
    from documents where regexp_matches(source, 'src', 'i') group by 1
    order by 2 desc, 1 limit 10
""")
def user_search_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = table(spark, sf_dir, "documents").groupBy(F.col("source").alias("username")).agg(
        F.count(F.lit(1)).alias("n_resenas"))
    return dashboards.stored_reviews_page(None, users, query="src")["top"]


@case("review_text_search", """
    select doc_id, lang from documents where regexp_matches(text, '(thor|ÈN).*\\bof\\b', 'i')
""")
def review_text_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A regular expression over whole texts, accented letters included."""
    return search(table(spark, sf_dir, "documents"), F.col("text"), r"(thor|ÈN).*\bof\b").select(
        "doc_id", "lang")


@case("review_text_search_literal", """
    select doc_id, lang from documents where contains(lower(text), lower('ING. I'))
""")
def review_text_search_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dot stands for itself."""
    return search(
        table(spark, sf_dir, "documents"), F.col("text"), "ING. I", literal=True,
    ).select("doc_id", "lang")


# ---- long form of measures the page lacks -------------------------------------------------

@case("user_metrics_long", """
    with m as (select count(*) as n from events where user_id = 5)
    select '5' as username, 'n_resenas' as metrica, cast(n as double) as valor from m
    union all select '5', 'n_calificaciones', 0.0 from m
""")
def user_metrics_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = metrics.named_user_counts(reviews(spark, sf_dir))
    return reshape.metrics_long(users, "username", "5", ["n_resenas", "n_calificaciones"])
