"""Wide rows to long rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ratelens.functions.convert import number_or_zero, ref
from ratelens.functions.match import same_text


def metrics_long(scores: DataFrame, key: str, wanted: str, metrics: Sequence[str]) -> DataFrame:
    """(key, metrica, valor) rows for one vehicle; a metric the table lacks is 0."""
    one = scores.where(same_text(scores, key, wanted))
    wide = one.select(ref(key), *[number_or_zero(one, m).alias(m) for m in metrics])
    return wide.unpivot([key], list(metrics), "metrica", "valor")
