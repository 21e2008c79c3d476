"""Raw tables to the typed columns the reports work on.

Each function selects and converts in one step, so a scan reads only the columns in use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ratelens import vocabulary as V
from ratelens.functions import convert as C
from ratelens.sources.names import (
    MissingColumns, find_prefix, find_token, first_text_column, must_pick, pick, project, require,
    snake_columns,
)


def ratings_by_id(raw: DataFrame) -> DataFrame:
    """``calificacion``, plus ``id_vehiculo`` and ``fecha`` where the table has them."""
    df = snake_columns(raw)
    columns = {"calificacion": C.number(df, must_pick(df, V.RATING, "rating"))}
    key, date = pick(df, V.VEHICLE_ID), pick(df, V.RATING_DATE)
    if key:
        columns["id_vehiculo"] = C.key(df, key)
    if date:
        columns["fecha"] = C.day(df, date)
    return project(df, columns)


def reviews_by_id(raw: DataFrame) -> DataFrame:
    """``id_vehiculo``, ``usuario``, ``resena``, ``fecha_d``: those the table has."""
    df = snake_columns(raw)
    key, user = pick(df, V.VEHICLE_ID), pick(df, V.USER)
    words, date = pick(df, V.REVIEW_TEXT), pick(df, V.REVIEW_DATE)
    columns = {}
    if key:
        columns["id_vehiculo"] = C.key(df, key)
    if user:
        columns["usuario"] = C.ref(user)
    if words:
        columns["resena"] = C.text(C.ref(words))
    if date:
        columns["fecha_d"] = C.day(df, date)
    return project(df, columns)


def ratings_by_number(raw: DataFrame) -> DataFrame:
    """``id_vehiculo`` (integer) and ``calificacion``.

    The id may be in an unnamed first column. The stars may not: taking the id for a rating
    would give a plausible wrong answer, so their absence is an error.
    """
    key = pick(raw, ("carroid", *V.VEHICLE_ID), default=raw.columns[0], any_case=True)
    stars = must_pick(raw, ("estrellas", *V.RATING), "rating", any_case=True)
    if key == stars:
        raise MissingColumns(f"no vehicle id column, got {raw.columns}")
    return project(raw, {"id_vehiculo": C.whole(raw, key), "calificacion": C.number(raw, stars)})


def catalogue(raw: DataFrame) -> DataFrame:
    """``id_vehiculo``, ``marca``, ``modelo``, ``anio``; all four must be there in any case."""
    found = require(raw, ("id_vehiculo", "marca", "modelo", "anio"), any_case=True)
    return project(raw, {
        "id_vehiculo": C.whole(raw, found["id_vehiculo"]),
        "marca": C.trimmed(C.ref(found["marca"])),
        "modelo": C.trimmed(C.ref(found["modelo"])),
        "anio": C.whole(raw, found["anio"]).try_cast("int"),
    })


def labelled_catalogue(raw: DataFrame) -> DataFrame:
    """``id_vehiculo``, ``vehiculo_label``, ``anio`` of a catalogue that holds ready names."""
    found = require(raw, ("id_vehiculo", "vehiculo", "anio"), any_case=True)
    return project(raw, {
        "id_vehiculo": C.whole(raw, found["id_vehiculo"]),
        "vehiculo_label": C.text(C.ref(found["vehiculo"])),
        "anio": found["anio"],
    })


def stored_scorecard(raw: DataFrame) -> DataFrame:
    """A stored scorecard with ``vehiculo_label``, mean and review count under their fixed names.

    Columns are found by parts of their names; other columns stay as they are. A table without
    any fitting name column takes its first text column, or a constant, as the label. Missing or
    bad numbers count as 0.
    """
    df = raw
    if "vehiculo_label" not in df.columns:
        named = find_token(df, V.LABEL_TOKENS)
        if named:
            df = df.withColumnRenamed(named, "vehiculo_label")
        else:
            words = first_text_column(df)
            df = df.withColumn("vehiculo_label", C.ref(words) if words else F.lit(V.DEFAULT_LABEL))
    df = _rename_by_token(df, "promedio_calificacion", V.MEAN_TOKENS)
    df = _rename_by_token(df, "n_resenas", V.REVIEW_COUNT_TOKENS)
    return df.withColumns({
        "promedio_calificacion": C.number_or_zero(df, "promedio_calificacion"),
        "n_resenas": C.whole_or_zero(df, "n_resenas"),
    })


def star_ratings(raw: DataFrame) -> DataFrame:
    """All columns plus ``estrellas_num``; a column named ``fecha...`` becomes a timestamp."""
    stars, date = find_token(raw, V.STAR_TOKENS), find_prefix(raw, V.DATE_PREFIXES)
    if stars is None:
        raise MissingColumns(f"no star column, got {raw.columns}")
    df = raw.withColumn("estrellas_num", C.number(raw, stars))
    return df.withColumn(date, C.moment(df, date)) if date else df


def user_reviews(raw: DataFrame) -> DataFrame:
    """``username`` must be there; the comment column is found by name; ``fecha`` is a timestamp."""
    require(raw, ["username"])
    df = _rename_by_token(raw, "comentario", V.COMMENT_TOKENS)
    return df.withColumn("fecha", C.moment(df, "fecha")) if "fecha" in df.columns else df


def _rename_by_token(df: DataFrame, name: str, tokens: tuple[str, ...]) -> DataFrame:
    if name in df.columns:
        return df
    found = find_token(df, tokens)
    return df.withColumnRenamed(found, name) if found else df
