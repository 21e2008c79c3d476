import random
import string
import zlib

import numpy as np

from ratelens.llm.language import _lowest, fit, held_out, identify, in_language, language_report, learned


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language_report(docs).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    assert len(rows) == docs.count()
    out = [r for r in rows if r.held_out]
    assert {r.doc_id for r in out} == {r.doc_id for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    assert sum(r.lang_pred == r.lang for r in out) / len(out) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_labels_of_held_out_rows_do_not_matter(documents):
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 4 != 2]
    out = [i for i in range(40) if zlib.crc32(str(i).encode()) % 4 == 2]
    learn = [(i, "der die das und nicht" if i % 2 else "the and that of with", "de" if i % 2 else "en") for i in ids]
    judged = language_report(documents(*learn, *[(i, "und die nicht", "en") for i in out])).where("held_out").collect()
    assert judged and all(r.lang_pred == "de" for r in judged)


def test_odd_rows(odd_documents, documents):
    rows = language_report(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    by = {(r.doc_id, r.lang_pred) for r in rows}
    assert {(1, "und"), (2, "und"), (3, "und"), (None, "und")} <= by
    assert language_report(documents()).collect() == []


def test_nothing_to_learn_from(documents):
    rows = language_report(documents((1, "some text", None), (2, None))).collect()
    assert [(r.lang_pred, r.score) for r in rows] == [("und", 0.0)] * 2


def test_columns_of_the_same_names_are_replaced(documents):
    docs = documents((1, "the and", "en"), (3, "der und", "de")).selectExpr("*", "'x' as score", "1 as lang_pred")
    got = identify(docs, fit(docs))
    assert got.columns.count("score") == 1 and dict(got.dtypes)["score"] == "double"


def test_null_id_is_never_held_out(documents):
    assert documents((None, "x")).select(held_out().alias("h")).first().h is False


def test_texts_in_no_learned_language_are_told_apart(spark, documents):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = learned(docs)
    letters = random.Random(1)
    foreign = {
        "fi": "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on "
              "annettu järki ja omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä.",
        "pl": "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw.",
        "ru": "Все люди рождаются свободными и равными в своем достоинстве и правах.",
        "el": "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια και τα δικαιώματα.",
        "zh": "人人生而自由，在尊严和权利上一律平等。",
        "random": " ".join("".join(letters.choices(string.ascii_lowercase, k=6)) for _ in range(60)),
        "few": " ".join("".join(letters.choices("qxzjwkvy", k=6)) for _ in range(60))}
    rows = documents(*[(i, text) for i, text in enumerate(foreign.values())])
    assert identify(rows, model).where(in_language(model)).count() == 0
    # Texts of the learned languages that the model has not seen stay, but for about the stated share.
    unseen = docs.where(held_out())
    assert identify(unseen, model).where(in_language(model)).count() >= 0.98 * unseen.count()


def test_least_share_is_that_of_the_stated_part_of_the_texts():
    assert _lowest(np.arange(198) / 198) is None
    assert _lowest(np.arange(399)[::-1] / 399) == 1 / 399
