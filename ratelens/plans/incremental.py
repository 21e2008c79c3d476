"""Series and counts kept up to date: a run reads only files that are new or have changed.

Of each source file the sums that add up (per day, and per star or user) are stored, marked with the
file's name, time and size, in a folder for each run. A ledger lists the marks of the files that count
and the run that has their sums. Results add the sums of those, so they equal a run over all files: a
changed file replaces its old sums, a file that is gone takes its sums with it. Sums that the ledger
does not name, as a run leaves them that ends before it writes the ledger, never count. ``compact``
brings what counts into one folder and removes the others.

    store/sums/lote=<run>/     Parquet: marca, keys, sums
    store/ledger/              Parquet, published whole
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ratelens.functions import convert as C
from ratelens.operators import metrics, ranking
from ratelens.sources import frames
from ratelens.sources.publish import read_published, remove_others
from ratelens.sources.readers import empty_table, optional, read_csv
from ratelens.sources.shared import stored
from ratelens.sources.writers import write_table

LEDGER = "archivo string, modificado timestamp, n_bytes bigint, marca string, lote string"
Read = Callable[[SparkSession, Sequence[str]], DataFrame]


@dataclass(frozen=True)
class Kind:
    """What is summed: typed columns of the facts, the keys with their types, and sums that add up."""

    typed: Callable[[DataFrame], DataFrame]
    keys: dict[str, str]
    sums: Callable[[DataFrame], list[Column]]


def _rating_sums(df: DataFrame) -> list[Column]:
    return [metrics.n_rows("n")]


def _review_sums(df: DataFrame) -> list[Column]:
    length = C.n_chars(F.col("resena") if "resena" in df.columns else F.lit(None))
    return [metrics.n_rows("n"), F.sum(length).cast("bigint").alias("chars"), F.count(length).alias("texts")]


RATINGS = Kind(frames.ratings_by_id, {"fecha": "date", "calificacion": "double"}, _rating_sums)
REVIEWS = Kind(frames.reviews_by_id, {"fecha_d": "date", "usuario": "string"}, _review_sums)


def source_files(spark: SparkSession, source: str) -> DataFrame:
    """``archivo``, ``modificado``, ``n_bytes``, ``marca``, ``ruta`` of each file below a folder.

    From the listing; no file is opened. Marks and hidden files are left out.
    """
    files = optional(lambda: spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source))
    if files is None:
        return empty_table(spark, "archivo string, modificado timestamp, n_bytes bigint, marca string, ruta string")
    mark = F.concat_ws("|", "_metadata.file_path", F.unix_micros("modificationTime"), "length")
    return files.select(
        F.col("_metadata.file_path").alias("archivo"), F.col("modificationTime").alias("modificado"),
        F.col("length").alias("n_bytes"), F.md5(mark).alias("marca"), F.col("path").alias("ruta"))


def ledger(spark: SparkSession, store: str) -> DataFrame:
    """The files whose sums count, with their run; no rows before the first run."""
    found = optional(lambda: read_published(spark, f"{store}/ledger"))
    return empty_table(spark, LEDGER) if found is None else found


def read_parquet_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    return spark.read.parquet(*paths)


def read_csv_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    return read_csv(spark, paths)


def update(spark: SparkSession, kind: Kind, source: str, store: str,
           read: Read = read_parquet_files) -> list[str]:
    """Bring the store up to date with the files below ``source``; the paths that were read.

    ``read`` makes a table of some files, by default Parquet files of one schema. One run at a time
    for a store. The names of new files are fetched, their rows never are.
    """
    listed = source_files(spark, source)
    known = ledger(spark, store).select("marca", "lote")
    fresh = listed.join(known, "marca", "left_anti").select("ruta", "archivo", "marca").collect()
    gone = known.join(listed, "marca", "left_anti")
    if not fresh and gone.isEmpty():
        return []
    run = uuid.uuid4().hex
    if fresh:
        marks = spark.createDataFrame([(f["archivo"], f["marca"]) for f in fresh], "archivo string, marca string")
        facts = read(spark, [f["ruta"] for f in fresh])
        _sums_of_files(kind, facts).join(marks, "archivo").drop("archivo").write.parquet(f"{store}/sums/lote={run}")
    marked = [f["marca"] for f in fresh]
    new = spark.createDataFrame([(m, run) for m in marked], "marca string, lote string")
    write_table(stored(listed.drop("ruta").join(known.unionByName(new), "marca"), "ledger"), f"{store}/ledger")
    return sorted(f["ruta"] for f in fresh)


def _sums_of_files(kind: Kind, facts: DataFrame) -> DataFrame:
    """The sums of each file the table is read from."""
    typed = kind.typed(facts)
    keys = [(F.col(k) if k in typed.columns else F.lit(None)).cast(t).alias(k) for k, t in kind.keys.items()]
    return typed.groupBy(F.col("_metadata.file_path").alias("archivo"), *keys).agg(*kind.sums(typed))


def sums(spark: SparkSession, store: str) -> DataFrame | None:
    """The stored sums that count, of all files; None before the first run over any file."""
    found = optional(lambda: spark.read.parquet(f"{store}/sums"))
    if found is None:
        return None
    return found.join(ledger(spark, store).select("marca", "lote"), ["marca", "lote"], "left_semi")


def compact(spark: SparkSession, store: str) -> None:
    """Bring all sums that count into one folder and remove the others. Results stay the same."""
    counted, run = sums(spark, store), uuid.uuid4().hex
    if counted is None:
        return
    counted.drop("lote").write.parquet(f"{store}/sums/lote={run}")
    write_table(stored(ledger(spark, store).withColumn("lote", F.lit(run)), "ledger"), f"{store}/ledger")
    remove_others(spark, f"{store}/sums", f"lote={run}")


def ratings_report(spark: SparkSession, store: str) -> dict[str, DataFrame]:
    """``reports.ratings_report`` of all files, from the store."""
    counted = sums(spark, store)
    if counted is None:
        counted = empty_table(spark, "fecha date, calificacion double, n bigint")
    return {
        "distribucion_estrellas": counted.groupBy("calificacion").agg(F.sum("n").alias("n")).orderBy("calificacion"),
        "calificaciones_mensual": counted.groupBy(C.month(F.col("fecha")).alias("ym"))
        .agg(F.sum("n").alias("n_calif")).orderBy("ym"),
    }


def reviews_report(spark: SparkSession, store: str) -> dict[str, DataFrame]:
    """``reports.reviews_report`` of all files, from the store; users are texts."""
    counted = sums(spark, store)
    if counted is None:
        counted = empty_table(spark, "fecha_d date, usuario string, n bigint, chars bigint, texts bigint")
    return {
        "resenas_diarias": metrics.daily_of_counts(counted).orderBy("fecha_d"),
        "usuarios_agg": ranking.report_order(metrics.activity_of_counts(counted), ranking.falling("n_resenas")),
    }
