"""Every query against its SQL on the same files, and what must hold for every plan and table."""

import datetime

import pytest
from conftest import plan_of, rows

import __spark_entry__ as entry
from ratelens.operators import joins
from suite.cases import QUERIES, SQL
from suite.compare import differences, oracle

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return oracle(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_result_as_sql(spark, duck, name):
    assert differences(spark, duck, SF_DIR, name) == []


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_product_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "Window"):
        assert unwanted not in plan


def test_entry(spark):
    made = entry.entry(spark)
    assert made.columns == ["vehiculo", "anio", "estado", "promedio_calificacion", "n_resenas"]
    assert made.count() > 0


def test_scorecard_scan_reads_two_fact_columns(spark):
    plan = plan_of(QUERIES["scorecard_named"](spark, SF_DIR))
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in plan
    assert "PushedFilters: [IsNotNull(l_partkey)]" in plan


def test_ratings_are_aggregated_before_they_are_shuffled(spark):
    plan = plan_of(QUERIES["scorecard_named"](spark, SF_DIR))
    tree = plan[:plan.index("(1) Scan")].splitlines()
    scans = [i for i, line in enumerate(tree) if "Scan parquet" in line]
    fact = tree[scans[-1] - 5:scans[-1]]
    assert any("HashAggregate" in line for line in fact)
    assert not any("Join" in line or "Exchange" in line for line in fact[2:])


@pytest.mark.parametrize("name", [
    "vehicles_best", "vehicles_top_reviews", "vehicles_table_page", "vehicles_any_order", "top_users",
    "brand_top_reviews", "brand_detail_top_rating", "top_supported"])
def test_top_lists_do_not_sort_everything(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_rank_does_not_move_rows_to_one_task(spark):
    """The only exchange into one partition carries one partial result per task."""
    plan = plan_of(QUERIES["vehicle_rank"](spark, SF_DIR))
    assert "rangepartitioning" not in plan and "Sort [" not in plan


@pytest.mark.parametrize("name, count, table", [
    ("scorecard_named", "n_resenas", "lineitem"), ("star_histogram", "n", "lineitem"),
    ("star_histogram_dense", "n", None), ("monthly_ratings", "n_calif", "lineitem"),
    ("daily_reviews", "n_resenas", "events"), ("user_activity_count", "n_resenas", "events"),
    ("user_activity", "n_resenas", "conversations"), ("brand_rollup", "total_resenas", "events"),
    ("rating_only_scorecard", "n_calificaciones", "lineitem"),
])
def test_group_counts_add_up(spark, name, count, table):
    total = QUERIES[name](spark, SF_DIR).agg({count: "sum"}).head()[0]
    if table:
        assert total == spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()
    else:
        assert total == spark.read.parquet(f"{SF_DIR}/lineitem.parquet").where(
            "l_quantity > 5").count()


@pytest.mark.parametrize("name, key", [
    ("scorecard_named", ["vehiculo", "anio"]), ("star_histogram", ["calificacion"]),
    ("monthly_ratings", ["ym"]), ("daily_reviews", ["fecha_d"]), ("user_activity", ["usuario"]),
    ("brand_rollup", ["marca"]), ("model_rating_by_text", ["Model"]),
])
def test_group_keys_are_unique(spark, name, key):
    made = QUERIES[name](spark, SF_DIR)
    assert made.select(*key).distinct().count() == made.count()


def test_reports_come_in_order(spark):
    users = rows(QUERIES["user_activity"](spark, SF_DIR))
    assert [r[1] for r in users] == sorted((r[1] for r in users), reverse=True)
    days = [r[0] for r in rows(QUERIES["daily_reviews"](spark, SF_DIR))]
    assert days == sorted(days) and isinstance(days[0], datetime.date)
    scored = rows(QUERIES["catalog_scorecard"](spark, SF_DIR))
    assert [r[2] for r in scored] == sorted((r[2] for r in scored), reverse=True)


@pytest.mark.parametrize("name", [
    "scorecard_label_id", "scorecard_duplicate_ids", "catalog_scorecard", "vehicle_scorecard",
    "model_rating_by_text", "model_review_by_text", "brand_rollup"])
def test_hot_keys_change_no_result(spark, duck, monkeypatch, name):
    """Every key with two rows or more is treated as hot."""
    split = []
    find = joins.hot_keys

    def find_small(df, key, min_rows):
        split.append(find(df, key, 2 if "duplicate" in name or "model" in name else 1))
        return split[-1]

    monkeypatch.setattr(joins, "hot_keys", find_small)
    assert differences(spark, duck, SF_DIR, name) == []
    assert split
