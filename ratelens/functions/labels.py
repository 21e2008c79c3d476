"""Readable vehicle labels from brand, model and id."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from ratelens import vocabulary as V


def name_or_id(brand: Column, model: Column, key: Column) -> Column:
    """'brand model' from whatever is present; 'ID n' when both are missing or blank."""
    name = F.trim(F.concat_ws(" ", brand, model))
    return F.coalesce(
        F.nullif(name, F.lit("")), F.concat(F.lit(V.ID_LABEL_PREFIX), key.cast("string"))
    )


def name_or_part(brand: Column, model: Column, key: Column) -> Column:
    """'brand model' if both are present, else the model, else the brand, else null."""
    return F.coalesce(F.concat(brand, F.lit(" "), model), model, brand)


def name_or_unknown(brand: Column, model: Column, key: Column) -> Column:
    """As ``name_or_part``, with a fixed word instead of null."""
    return F.coalesce(name_or_part(brand, model, key), F.lit(V.UNKNOWN_LABEL))


LABELS: dict[str, Callable[[Column, Column, Column], Column]] = {
    "id": name_or_id,
    "part": name_or_part,
    "unknown": name_or_unknown,
}
