import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType())])

# Columns with names that operators use inside.
CLASHES = ["set_id", "token", "spans", "found", "held", "block", "words", "score", "lang_pred", "of",
           "root", "judged", "ids", "failed", "host", "path"]


@pytest.fixture
def documents(spark):
    """A table of documents from (doc_id, text) or (doc_id, text, lang)."""
    def make(*rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", None if r[1] is None else len(r[1]))
                for r in rows]
        return spark.createDataFrame(full, DOCUMENTS)
    return make


@pytest.fixture
def odd_documents(documents):
    """Nulls, empty and very long texts, ties, repeated rows and ids, clashing extra columns."""
    from pyspark.sql import functions as F

    long = " ".join(f"word{i % 977} another{i % 13}" for i in range(20_000))
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "a b c d e f g"), (5, "a b c d e f g"),
            (5, "other words under the same id here"), (None, "a text without an id at all"), (None, None),
            (7, long), (8, long + " end"), (9, "😀 日本語 ▁ \x00 ñ"), (10, "A B C D E F G", None)]
    return documents(*rows).withColumns({c: F.lit("x") for c in CLASHES})
