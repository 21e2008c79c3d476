"""Pipeline over a corpus of documents: each stage works on all that its predecessor kept.

Stages take and return the columns of ``documents`` (the last returns piece ids). Between stages the
rows are written as Parquet to the folder named in ``spark.checkpoint.dir`` and read again. No stage
tells rows apart by doc_id alone, so null and repeated ids pass like any others. An empty table stays
empty through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ratelens.llm.decontamination import without_leaks
from ratelens.llm.jaccard import one_per_component
from ratelens.llm.language import identify, in_language, learned
from ratelens.llm.pieces import MODEL, encode
from ratelens.llm.secrets import mask_secrets
from ratelens.llm.tables import kept, prepared, table


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in a learned language, in ``lang``: those without letters and in no such language go."""
    prepared(spark)
    model = learned(docs)
    judged = identify(docs, model).where(in_language(model))
    return judged.withColumn("lang", F.col("lang_pred")).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of linked texts stays: the one with the smallest doc_id."""
    prepared(spark)
    return one_per_component(docs, "0.85", 4)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no item of ``benchmark``."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with secrets in the text masked and ``n_chars`` the new length."""
    prepared(spark)
    masked = mask_secrets(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``lang``, ``source`` and the piece ids of the text."""
    prepared(spark)
    ids = encode(docs, MODEL, keep=("lang", "source"), batch_chars=1 << 19)
    return ids.select("doc_id", "lang", "source", "ids", F.coalesce(F.size("ids"), F.lit(0)).alias("n_ids"))


STAGES = [
    ("language identification", keep_known_languages),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("secret scan", hide_secrets),
    ("SentencePiece encoding", to_pieces),
]

# Language identification and the secrets' randomness tests are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = kept(stage(spark, docs, sf_dir), f"stage{i + 1}")
    return docs
