import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from ratelens.llm.quality import POLICIES, RULES, _failures, ablations, kept, ledger, mask, measured, quality_report

BLANK = " \t\n\x0b\x0c\r"


def words_of(text):
    for c in BLANK:
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def brute(text):
    text = text or ""
    w = words_of(text)
    lines = [x for x in text.split("\n") if words_of(x)]
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    covered = {i + k for i, x in enumerate(windows) if windows.count(x) > 1 for k in range(8)}
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
            "n_lines": len(lines), "n_distinct_words": len(set(w)),
            "n_exclamations": text.count("!"), "n_capitals": sum("A" <= c <= "Z" for c in text)}


REPEAT = "a b c d e f g h i"
TEXTS = ["", None, BLANK * 3, "one", REPEAT, f"{REPEAT} {REPEAT}", f"x {REPEAT} y {REPEAT} z " + "q " * 9, "a " * 40,
         "line one\nline two\n\nline one\n \nline two", "## ** <a> | b & c%$", "É ñ 😀 SHOUT!! LOUD!!", "w" * 5000,
         "\x00 nul \x85 next wide", "a\r\nb\r\na\r\nb", " ".join(f"v{i % 50}" for i in range(120))]


def test_measurements_same_as_brute_force(documents):
    rows = quality_report(documents(*enumerate(TEXTS))).orderBy("doc_id").collect()
    for row, text in zip(rows, TEXTS, strict=True):
        expected = brute(text)
        assert {k: row[k] for k in expected} == expected, text
        n = expected["n_words"]
        assert row.base_failed == (n < 20 or 100 * expected["n_repeat_words"] > 30 * n)
        assert not (row.base_failed and row.kept)


def test_good_texts_of_the_corpus_stay(spark):
    path = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{path}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_report(docs.join(labels.select("doc_id", "quality"), "doc_id")).join(
        labels.select("doc_id", "quality"), "doc_id").where("not base_failed")
    by = {r.quality: (r.kept, r.n) for r in rows.groupBy("quality").agg(
        F.sum(F.col("kept").cast("int")).alias("kept"), F.count("*").alias("n")).collect()}
    assert by[1][0] > 0.99 * by[1][1]
    assert by[0][0] < 0.05 * by[0][1]


def test_policies_read_only_the_ledger(documents):
    rows = ledger(documents((1, "## " * 30), (2, " ".join(f"good{i}" for i in range(30))), (3, "few")))
    assert [r.k for r in rows.orderBy("doc_id").select(kept("base").alias("k")).collect()] == [False, True, False]
    assert mask(["few_words", "symbols"]) == 0b101
    assert sorted(bit for bit, _ in RULES.values()) == list(range(len(RULES)))
    assert set(POLICIES["base"]) < set(POLICIES["1"]) < set(POLICIES["2"])


def test_ablations(spark):
    rows = spark.createDataFrame([(0,), (1,), (1,), (3,), (4,), (128,)], "failed long")
    got = {r.rule: (r.n_failed, r.n_only_this) for r in ablations(rows, "1").collect()}
    assert got == {"few_words": (3, 2), "repeated_windows": (1, 0), "symbols": (1, 1), "repeated_lines": (0, 0)}
    assert ablations(rows.limit(0), "1").collect() == []


def test_built_in_functions_only(documents):
    plan = plan_of(_failures(measured(documents((1, "x")))))
    assert not any(x in plan for x in ("EvalPython", "MapIn", "FlatMapGroups", "Exchange"))


@pytest.mark.parametrize("column", ["doc_id", "n_words", "kept", "failed"])
def test_odd_rows_and_empty_table(odd_documents, documents, column):
    assert quality_report(odd_documents).select(column).count() == odd_documents.count()
    assert quality_report(documents()).select(column).collect() == []
