"""CSV whose broken records are set aside instead of ending the run."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ratelens.functions.convert import ref
from ratelens.sources.lines import joined_lines
from ratelens.sources.names import MissingColumns
from ratelens.sources.readers import read_csv
from ratelens.sources.shared import stored

# Why a record is set aside.
QUOTES, FEWER, MORE, VALUE = "comillas", "faltan campos", "sobran campos", "valor"


@dataclass(frozen=True)
class Records:
    """``good`` has the columns of the schema; ``bad`` has ``archivo``, ``bloque``, ``registro``, ``motivo``.

    ``bloque`` is the offset of the piece of the file that holds the record, ``registro`` its line.
    """

    good: DataFrame
    bad: DataFrame


def read_csv_apart(spark: SparkSession, path: str | Sequence[str],
                   schema: T.StructType | str | None = None, header: bool = True,
                   strict: bool = False) -> Records:
    """The records of CSV files with one record a line, whole ones and broken ones apart.

    Broken are lines with a quoted field that does not close, and those with fewer or more fields
    than the schema; each line that is not blank is in exactly one of both tables. So a text that
    someone else's program wrote over several lines gives broken lines, never a cut text. A value
    that its type cannot hold is null, as with ``read_csv``; with ``strict`` its record is broken.

    Lines that repeat the header are no records. A file without one is an error, as its columns
    could be others, unless ``header`` is false. Without a schema all columns are text, named as in
    the header of the first file. The files are read once, at once, into a table in the shared folder.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if schema is None:
        schema = read_csv(spark, paths).schema
    elif isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    names = schema.fieldNames()
    lines = spark.read.text(paths).where(F.trim("value") != "").select(
        F.col("value").alias("registro"), F.col("_metadata.file_path").alias("archivo"),
        F.col("_metadata.file_block_start").alias("bloque"))
    fields = [f"f{i}" for i in range(len(names))]
    text = ", ".join(f"{f} string" for f in fields)
    parsed = lines.withColumn("motivo", _broken(F.col("registro"), len(names))) \
        .withColumn("v", F.when(F.col("motivo").isNull(), F.from_csv("registro", text, {"escape": '"'})))
    if header:
        shown = ["" if re.fullmatch(r"_c\d+", n) else n for n in names]
        is_header = F.lit(True)
        for field, name in zip(fields, shown):
            is_header &= F.trim(F.coalesce(F.col(f"v.{field}"), F.lit(""))) == name
        parsed = parsed.withColumn("cabecera", F.col("motivo").isNull() & is_header)
    values = [_typed(F.col(f"v.{field}"), f) for field, f in zip(fields, schema.fields)]
    if strict:
        unfit = F.lit(False)
        for (value, given) in values:
            unfit |= given.isNotNull() & value.isNull()
        unfit &= ~F.col("cabecera") if header else F.lit(True)
        parsed = parsed.withColumn("motivo", F.coalesce("motivo", F.when(unfit, VALUE)))
    kept = stored(parsed.select(
        "archivo", "bloque", "motivo", F.when(F.col("motivo").isNotNull(), F.col("registro")).alias("registro"),
        *(["cabecera"] if header else []),
        *[value.alias(field) for field, (value, _) in zip(fields, values)]), "records")
    records = kept
    if header:
        without = kept.groupBy("archivo").agg(F.bool_or("cabecera").alias("_has")).where(~F.col("_has")).take(5)
        if without:
            raise MissingColumns(f"no header {names} in {[r['archivo'] for r in without]}")
        records = kept.where(~F.col("cabecera"))
    return Records(
        records.where(F.col("motivo").isNull()).select(*[ref(f).alias(n) for f, n in zip(fields, names)]),
        records.where(F.col("motivo").isNotNull()).select("archivo", "bloque", "registro", "motivo"))


def _broken(line: Column, n: int) -> Column:
    """Why a line is no record of n fields, or null."""
    single = F.replace(line, F.lit('""'), F.lit(""))             # two quotes are one inside a field
    bare = F.regexp_replace(single, r'(^|,)"[^"]*"(?=,|$)', "$1")
    n_fields = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    return F.when(bare.rlike(r'(^|,)"'), QUOTES).when(n_fields < n, FEWER).when(n_fields > n, MORE)


def _typed(value: Column, field: T.StructField) -> tuple[Column, Column]:
    """The value in its type, and as it was given."""
    text = joined_lines(value)
    return (text if isinstance(field.dataType, T.StringType) else text.try_cast(field.dataType)), value
