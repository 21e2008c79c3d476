"""Register of queries and their SQL, and the given tables in the shape the package expects."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def case(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its name; without SQL only its rows can be checked."""
    def register(query: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"two queries named {name}")
        QUERIES[name] = query
        if sql is not None:
            SQL[name] = sql
        return query
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    """Round unrounded means, so that the last bit of a sum does not decide a comparison."""
    return df.withColumns({n: F.round(n, digits) for n in names})


def half_up(expression: str, digits: int) -> str:
    """SQL that rounds like Spark: on the decimal digits of the number, halves away from zero."""
    return f"cast(round(cast({expression} as decimal(28, 12)), {digits}) as double)"


# ---- the given tables as ratings, reviews and catalogue ------------------------------------

def stars() -> Column:
    """1 to 5 stars from a quantity of 1 to 50."""
    return F.ceil(F.col("l_quantity") / 10).cast("double")


def json_id() -> Column:
    return F.get_json_object("props", "$.k")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("carroId"), stars().alias("estrellas"),
        F.col("l_shipdate").alias("creado_en"))


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("username"),
        F.col("event_type").alias("comentario"), F.col("ts").alias("fecha"),
        json_id().alias("idVehiculo"))


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id_vehiculo"), F.col("p_brand").alias("marca"),
        F.col("p_name").alias("modelo"), F.col("p_size").alias("anio"))


def gappy_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue with missing brands and models, some rows missing both."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("ID_Vehiculo"),
        F.when(F.col("p_type") != "ECONOMY", F.col("p_brand")).alias("Marca"),
        F.when(F.col("p_size") > 10, F.col("p_name")).alias("Modelo"),
        F.col("p_size").alias("Anio"))


SQL_RATINGS = """
    select l_partkey as id, ceil(l_quantity / 10) as stars, l_shipdate as dated from lineitem
"""
SQL_REVIEWS = """
    select cast(user_id as varchar) as username, event_type as comentario, ts as fecha,
           cast(json_extract_string(props, '$.k') as bigint) as id
    from events
"""
SQL_GAPPY = """
    select p_partkey as id, case when p_type <> 'ECONOMY' then p_brand end as b,
           case when p_size > 10 then p_name end as m, p_size as anio
    from part
"""
