import string

import pytest
from conftest import rows
from hypothesis import given, strategies as st

from ratelens import vocabulary as V
from ratelens.sources import names


@pytest.mark.parametrize("name, expected", [
    ("carroId", "carro_id"), ("Reseña", "resena"), ("creadoEn", "creado_en"), ("ID", "i_d"),
    ("idVehiculo", "id_vehiculo"), ("fecha alta", "fecha_alta"), ("a -- b", "a_b"),
    ("_x_", "x"), ("", ""), ("Ñandú Ágil", "nandu__agil"), ("id-Usuario", "id__usuario"),
    ("a b_", "a_b"), ("straße", "stra_e"),
])
def test_snake_name(name, expected):
    assert names.snake_name(name) == expected


@given(st.text(alphabet=string.ascii_letters + string.digits + "_ -ñÁ.", max_size=12))
def test_snake_name_is_stable(name):
    once = names.snake_name(name)
    assert names.snake_name(once) == once
    assert once == once.strip("_").lower()
    assert set(once) <= set(string.ascii_lowercase + string.digits + "_")


def test_snake_columns(spark):
    df = spark.createDataFrame([(1, 2)], "carroId int, `Reseña` int")
    assert names.snake_columns(df).columns == ["carro_id", "resena"]
    with pytest.raises(ValueError, match="clash"):
        names.snake_columns(spark.createDataFrame([(1, 2)], "carroId int, carro_id int"))


def test_pick(spark):
    df = spark.createDataFrame([(1, 2, 3)], "carroid int, carro_id int, Rating int")
    assert names.pick(df, V.VEHICLE_ID) == "carro_id"
    assert names.pick(df, V.RATING) is None
    assert names.pick(df, V.RATING, any_case=True) == "Rating"
    assert names.pick(df, V.USER, default=df.columns[0]) == "carroid"
    with pytest.raises(names.MissingColumns, match="user.*carroid"):
        names.must_pick(df, V.USER, "user")


def test_require(spark):
    df = spark.createDataFrame([(1, 2)], "Marca int, modelo int")
    assert names.require(df, ["marca", "modelo"], any_case=True) == {
        "marca": "Marca", "modelo": "modelo"}
    with pytest.raises(names.MissingColumns, match=r"\['anio'\]"):
        names.require(df, ["marca", "anio"], any_case=True)
    with pytest.raises(names.MissingColumns, match=r"\['marca'\]"):
        names.require(df, ["marca"])


def test_discovery(spark):
    df = spark.createDataFrame([(1, "a", 2)], "x int, `Mi Vehículo` string, Fecha_alta int")
    assert names.find_token(df, V.LABEL_TOKENS) == "Mi Vehículo"
    assert names.find_prefix(df, V.DATE_PREFIXES) == "Fecha_alta"
    assert names.find_prefix(df, ("alta",)) is None
    assert names.first_text_column(df) == "Mi Vehículo"


def test_project_and_constant(spark):
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    made = names.with_constant(names.project(df, {"z": "y", "w": df.x + 1}), "estado", "N/A",
                               "string")
    assert made.columns == ["z", "w", "estado"]
    assert rows(made) == [("a", 2, "N/A")]
