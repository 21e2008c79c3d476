from conftest import rows
from pyspark.sql import functions as F

from ratelens.functions.labels import LABELS

NAMES = [
    ("Seat", "Ibiza", 1), ("Seat", None, 2), (None, "Ibiza", 3), (None, None, 4), ("", "", 5),
    (" ", None, 6), ("", "Ibiza", 7), (None, None, None),
]


def labels(spark, kind):
    df = spark.createDataFrame(NAMES, "b string, m string, k long")
    return [r[0] for r in rows(df.select(LABELS[kind](F.col("b"), F.col("m"), F.col("k"))))]


def test_label_with_id(spark):
    assert labels(spark, "id") == [
        "Seat Ibiza", "Seat", "Ibiza", "ID 4", "ID 5", "ID 6", "Ibiza", None]


def test_label_with_part(spark):
    assert labels(spark, "part") == ["Seat Ibiza", "Seat", "Ibiza", None, " ", " ", " Ibiza", None]


def test_label_with_unknown(spark):
    assert labels(spark, "unknown") == [
        "Seat Ibiza", "Seat", "Ibiza", "Desconocido", " ", " ", " Ibiza", "Desconocido"]
