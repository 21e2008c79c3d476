"""Tables from files. Any path Spark can read works; nothing looks at the local disk."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ratelens.functions.convert import ref
from ratelens.sources.lines import joined_lines
from ratelens.sources.unions import union_widened

EMPTY_CATALOGUE = T.StructType([
    T.StructField("id_vehiculo", T.StringType()),
    T.StructField("marca", T.StringType()),
    T.StructField("nombre_vehiculo", T.StringType()),
])


def _csv_options(multi_line: bool) -> dict[str, object]:
    # A doubled quote inside a quoted field is one quote, as spreadsheet programs write it. A record
    # with too few or too many fields fails; for that all fields are parsed, also those not asked for.
    return {"header": True, "escape": '"', "multiLine": multi_line, "mode": "FAILFAST",
            "columnPruning": False}


def read_csv(spark: SparkSession, path: str | Sequence[str],
             schema: T.StructType | str | None = None, infer: bool = False,
             multi_line: bool = False) -> DataFrame:
    """CSV with a header row.

    Give a schema: it costs no extra pass, and a month such as ``2023-11`` stays text. Without
    one every column is text, to be converted by the caller. ``infer`` reads the whole file once
    more to guess the types. Files whose header differs from the schema are an error, not a
    silent shift of columns; only a header with unnamed columns, which Spark calls ``_c0`` and so
    on, cannot be checked. An empty text comes back as null, and so does a value that its type
    cannot hold. Texts that ``write_csv`` has put on one line get their line breaks back. In files
    of others a quoted text may go over several lines; they need ``multi_line``, with which Spark
    cannot split a file. Without it such a record fails the read and never becomes several rows.
    """
    paths = [path] if isinstance(path, str) else list(path)
    reader = spark.read.options(**_csv_options(multi_line))
    if infer:
        return _with_line_breaks(reader.option("inferSchema", True).csv(paths))
    if schema is None:
        names = reader.csv(paths).columns
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    elif isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    unnamed = any(re.fullmatch(r"_c\d+", n) for n in schema.fieldNames())
    as_text = T.StructType([T.StructField(n, T.StringType()) for n in schema.fieldNames()])
    raw = _with_line_breaks(reader.schema(as_text).option("enforceSchema", unnamed).csv(paths))
    return raw.select(*[
        ref(f.name) if isinstance(f.dataType, T.StringType) else ref(f.name).try_cast(f.dataType).alias(f.name)
        for f in schema.fields])


def _with_line_breaks(df: DataFrame) -> DataFrame:
    return df.select(*[joined_lines(ref(c)).alias(c) if kind == "string" else ref(c)
                       for c, kind in df.dtypes])


def read_csv_groups(spark: SparkSession, globs: Sequence[str],
                    multi_line: bool = False) -> DataFrame | None:
    """Union by column name of several groups of CSV files; None when no file is found.

    Files under one glob share a header; groups may differ, and columns a group lacks are null.
    """
    groups = [optional(lambda g=g: read_csv(spark, g, multi_line=multi_line)) for g in globs]
    return union_by_name([g for g in groups if g is not None])


def union_by_name(tables: Sequence[DataFrame]) -> DataFrame | None:
    """All rows of all tables, columns matched by name, absent ones null; duplicates stay.

    Columns that differ in type get one that holds the values of all, see ``unions``.
    """
    return union_widened(tables)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Stored Parquet. A missing path is Spark's PATH_NOT_FOUND error, which names the path."""
    return spark.read.parquet(path)


def optional(read: Callable[[], DataFrame]) -> DataFrame | None:
    """The table, or None when its path does not exist; other errors are raised."""
    try:
        return read()
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def or_empty(read: Callable[[], DataFrame], spark: SparkSession,
             schema: T.StructType | str) -> DataFrame:
    """The table, or one with the given columns and no rows when its path does not exist."""
    found = optional(read)
    return empty_table(spark, schema) if found is None else found


def empty_table(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    """No rows, typed columns."""
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in wanted.fields])


def empty_catalogue(spark: SparkSession) -> DataFrame:
    return empty_table(spark, EMPTY_CATALOGUE)


def source_total(spark: SparkSession, read_raw: Callable[[], DataFrame],
                 read_stored: Callable[[], DataFrame]) -> DataFrame:
    """One row ``total``, ``origen``: rows of the raw table, else of the stored one, else 0.

    Only a table whose path does not exist falls through to the next; other errors are raised.
    ``origen`` names the table that was counted: ``original``, ``guardado`` or null.
    """
    for origin, read in (("original", read_raw), ("guardado", read_stored)):
        found = optional(read)
        if found is not None:
            return found.agg(F.count(F.lit(1)).alias("total"), F.lit(origin).alias("origen"))
    return spark.range(1).select(F.lit(0).cast("bigint").alias("total"),
                                 F.lit(None).cast("string").alias("origen"))


def read_files(df: DataFrame) -> DataFrame:
    """``archivo``, ``n_filas``, ``modificado``: the files a table is read from, rows and time of each.

    For a table read from files, before any other operation on it.
    """
    return df.groupBy(F.col("_metadata.file_name").alias("archivo")).agg(
        F.count(F.lit(1)).alias("n_filas"),
        F.max("_metadata.file_modification_time").alias("modificado"))


def freshness(spark: SparkSession, path: str) -> DataFrame:
    """One row per file with size and time of last change; no rows for a missing path.

    Spark's file listing answers this; the content column is not selected, so no file is opened.
    """
    files = or_empty(
        lambda: spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path),
        spark, "path string, modificationTime timestamp, length bigint")
    return files.select(
        F.regexp_extract("path", r"([^/]+)$", 1).alias("archivo"),
        F.col("length").alias("n_bytes"),
        F.date_format("modificationTime", "yyyy-MM-dd HH:mm:ss").alias("modificado"),
    )
