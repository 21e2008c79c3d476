"""Intermediate tables of the operators, and their input in a fixed shape."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

from ratelens.sources.shared import stored as kept  # noqa: F401


WORKERS = {"MALLOC_MMAP_THRESHOLD_": "1048576", "MALLOC_TRIM_THRESHOLD_": "1048576",
           "ARROW_DEFAULT_MEMORY_POOL": "system"}
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def prepared(spark: SparkSession) -> None:
    """Settings of the session that the operators count on, where the user has not made them.

    Arrow batches of texts hold 4 MB at most, or one text, so that memory follows bytes and not rows.
    Python workers on machines that have this folder can import the package from it; where it is
    installed, or shipped with ``--py-files``, that changes nothing. Workers live on between tasks;
    they give the memory of large arrays back at once instead of keeping it for the next ones.
    """
    if spark.conf.get(BATCH_BYTES) == "67108864b":      # Spark's default
        spark.conf.set(BATCH_BYTES, "4m")
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    for name, value in WORKERS.items():
        environment.setdefault(name, value)
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id, as ``doc_id`` (long), and the text, as ``text``; other columns cannot clash."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepared(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
