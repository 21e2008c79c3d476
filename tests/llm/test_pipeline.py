from llm.test_jaccard import brute, shingles
from llm.test_secrets import base_spans

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from ratelens.llm import pieces, queries
from ratelens.llm.pieces import decode

SF_DIR = "/root/testdata/sf0.001"


def stages(spark, docs, sf_dir=SF_DIR):
    """The result of every stage, each computed from the one before."""
    out = []
    for _, stage in pipeline.STAGES:
        rows = stage(spark, docs if not out else out[-1], sf_dir)
        out.append(spark.createDataFrame(rows.collect(), rows.schema))
    return out


def test_each_stage_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    known, single, clean, masked, ids = stages(spark, docs)
    assert all(df.columns == docs.columns for df in (known, single, clean, masked))
    given = {r.doc_id: r for r in docs.collect()}
    # Every text of the corpus is in a learned language; labels that were there are found again.
    kept = {r.doc_id: r for r in known.collect()}
    assert kept.keys() == given.keys()
    assert sum(kept[i].lang == given[i].lang for i in kept) > 0.97 * len(kept)
    # One document of each group.
    first = {d for d, _, root in brute([(i, r.text) for i, r in given.items()]) if d == root}
    assert {r.doc_id for r in single.collect()} == first
    # No item of the benchmark, and nothing else is lost.
    items = [r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    leaks = {i for i in first if any(t.lower() in given[i].text.lower() for t in items)}
    assert {r.doc_id for r in clean.collect()} == first - leaks and leaks
    # No secret; texts without any are as they were.
    changed = 0
    for r in masked.collect():
        assert base_spans(r.text) == [] and r.n_chars == len(r.text)
        changed += r.text != given[r.doc_id].text
        assert (r.text != given[r.doc_id].text) == bool(base_spans(given[r.doc_id].text))
    assert changed
    texts = {r.doc_id: r.text for r in masked.collect()}
    assert {r.doc_id: r.decoded for r in decode(ids, pieces.MODEL).collect()} == texts


def test_run_is_the_stages(spark):
    whole = pipeline.run(spark, SF_DIR)
    last = stages(spark, spark.read.parquet(f"{SF_DIR}/documents.parquet"))[-1]
    assert sorted(map(repr, whole.collect())) == sorted(map(repr, last.collect()))


def test_odd_rows_and_empty_table(spark, odd_documents, documents):
    odd = documents(*[(r.doc_id, r.text) for r in odd_documents.collect()])
    known, single, *_, ids = stages(spark, odd)
    # Rows without a letter go; of the others one for each group of linked texts stays.
    filled = [r for r in odd.collect() if r.text and any(c.isalpha() for c in r.text)]
    assert known.count() == len(filled)
    assert single.count() == 6 and ids.count() == 6
    assert all(df.count() == 0 for df in stages(spark, documents()))


def test_all_are_registered():
    names = set(entry.queries())
    assert names >= set(queries.QUERIES) | {"pipeline"}
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(queries.SQL) <= set(queries.QUERIES) and "pipeline" not in entry.oracle_sql()
    assert shingles(None) == set()
