import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from ratelens.functions import convert as C
from ratelens.functions.match import both_present, contains, same_text, search


def column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


def applied(df, expression):
    return [r[0] for r in rows(df.select(expression))]


def test_whole_from_text(spark):
    df = column(spark, ["7", " 7 ", "5.7", "-5.7", "x", "", None, "NaN", "9007199254740993", "1e30"])
    assert applied(df, C.whole(df, "v")) == [
        7, 7, 5, -5, None, None, None, None, 9007199254740993, None]


def test_whole_from_numbers(spark):
    doubles = column(spark, [5.7, float("nan"), None, 3.0], "double")
    assert applied(doubles, C.whole(doubles, "v")) == [5, None, None, 3]
    ints = column(spark, [5, None], "int")
    assert applied(ints, C.whole(ints, "v")) == [5, None]


def test_number_has_no_nan(spark):
    df = column(spark, ["5", "4.5", " 3 ", "bad", None, "NaN"])
    assert applied(df, C.number(df, "v")) == [5.0, 4.5, 3.0, None, None, None]
    doubles = column(spark, [1.5, float("nan"), None], "double")
    assert applied(doubles, C.number(doubles, "v")) == [1.5, None, None]


def test_zero_for_missing_bad_and_absent(spark):
    df = column(spark, ["5.5", "bad", None])
    assert applied(df, C.number_or_zero(df, "v")) == [5.5, 0.0, 0.0]
    assert applied(df, C.whole_or_zero(df, "v")) == [5, 0, 0]
    assert applied(df, C.number_or_zero(df, "absent")) == [0.0] * 3
    assert applied(df, C.whole_or_zero(df, "absent")) == [0] * 3


def test_day_and_moment(spark):
    df = column(spark, [
        "2024-01-02", "2024-01-02 10:00:00", "2024-01-02T10:00:00Z", "x", "2024-02-31", None])
    day = datetime.date(2024, 1, 2)
    assert applied(df, C.day(df, "v")) == [day, day, day, None, None, None]
    ten = datetime.datetime(2024, 1, 2, 10)
    assert applied(df, C.moment(df, "v")) == [
        datetime.datetime(2024, 1, 2), ten, ten, None, None, None]
    assert applied(df, C.month(C.day(df, "v")))[:4] == ["2024-01"] * 3 + [None]


@pytest.mark.parametrize("zone", ["UTC", "America/Mexico_City", "Asia/Tokyo"])
def test_days_and_months_ignore_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = column(spark, ["2024-01-31 23:59:59", "2024-02-01 00:00:00"])
        df = df.select(C.moment(df, "v").alias("v"))
        assert applied(df, C.month(C.day(df, "v"))) == ["2024-01", "2024-02"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_trim_and_strip_differ_on_tabs(spark):
    df = column(spark, [" a b ", "\ta\n", " a ", None])
    assert applied(df, C.trimmed(F.col("v"))) == ["a b", "\ta\n", " a ", None]
    assert applied(df, C.stripped(F.col("v"))) == ["a b", "a", "a", None]


def test_text_key_keeps_accents(spark):
    df = column(spark, [" León ", "LEÓN", "LEON"])
    assert applied(df, C.text_key(F.col("v"))) == ["león", "león", "leon"]


def test_length_counts_characters(spark):
    df = column(spark, ["ñandú ", "", None])
    assert applied(df, C.n_chars(F.col("v"))) == [6, 0, None]


def test_odd_column_names(spark):
    df = spark.createDataFrame([("1",)], "`a.b c` string")
    assert rows(df.select(C.whole(df, "a.b c").alias("n"))) == [(1,)]


def test_search(spark):
    df = column(spark, ["RESEÑA", "reseña", "abc", "a.c", "nan", None])

    def found(query, literal=False):
        return [r[0] for r in rows(search(df, F.col("v"), query, literal))]

    assert found("reseña") == ["RESEÑA", "reseña"]
    assert found("a.c") == ["abc", "a.c"]
    assert found("A.C", literal=True) == ["a.c"]
    assert found("RESEÑ", literal=True) == ["RESEÑA", "reseña"]
    assert found("nan") == ["nan"]
    assert len(found("  ")) == len(found(None)) == 6
    assert found(r"\S{6}") == ["RESEÑA", "reseña"]


def test_exact_lookup_and_presence(spark):
    df = spark.createDataFrame([(7, "a"), (70, None), (None, "b")], "k long, v string")
    assert rows(df.where(same_text(df, "k", "7"))) == [(7, "a")]
    for absent in ("07", "+7", "7.0", "x", "", "9" * 30, "٧"):
        assert df.where(same_text(df, "k", absent)).isEmpty()
    assert rows(df.where(same_text(df, "v", "b"))) == [(None, "b")]
    assert rows(df.where(both_present(F.col("k"), F.col("v")))) == [(7, "a")]
    assert applied(df, contains(F.col("v"), "B")) == [False, None, True]
