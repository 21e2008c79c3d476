import random

import numpy as np
import pytest

from ratelens.llm import decontamination as D
from ratelens.llm.decontamination import common_words, leaks, randomised_svd, without_leaks


@pytest.fixture
def benchmark(spark):
    def make(*rows):
        return spark.createDataFrame(list(rows), "item_id long, text string")
    return make


def in_common(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_longest_common_subsequence():
    rng = random.Random(1)
    for _ in range(200):
        a, b = (rng.choices(range(6), k=rng.randint(1, 30)) for _ in range(2))
        assert common_words(a, b) == in_common(a, b)


def test_randomised_svd_finds_the_leading_space():
    rng = np.random.default_rng(2)
    rows = rng.standard_normal((60, 5)) @ rng.standard_normal((5, 300))
    axes = randomised_svd(rows, 5, 0)
    assert np.allclose(rows @ axes @ axes.T, rows, atol=1e-8)


def test_same_as_brute_force_over_the_corpus(spark):
    docs, bench = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    items = [(r.item_id, r.text.lower()) for r in bench.collect()]
    whole = {(r.doc_id, i) for r in docs.collect() for i, t in items if t in r.text.lower()}
    got = {(r.doc_id, r.item_id) for r in leaks(docs, bench).collect()}
    assert len(whole) > 10 and whole <= got and len(got - whole) <= 2


def words(rng, n):
    return ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 9))) for _ in range(n)]


def test_paraphrases_and_clean_texts(documents, benchmark):
    rng = random.Random(4)
    common = words(rng, 30)
    items = [[w for x in words(rng, 24) for w in (x, rng.choice(common))][:40] for _ in range(30)]
    rows = []
    for i, item in enumerate(items):
        around = [rng.choice(common) if rng.random() < 0.4 else w for w in words(rng, 200)]
        changed = [w if rng.random() > 0.15 else "".join(words(rng, 1)) for w in item]
        rows += [(3 * i, " ".join(around[:90] + item + around[90:])),
                 (3 * i + 1, " ".join(around[:20] + changed + around[20:])),
                 (3 * i + 2, " ".join(around))]
    got = {(r.doc_id, r.item_id) for r in leaks(documents(*rows), benchmark(
        *[(i, " ".join(x)) for i, x in enumerate(items)])).collect()}
    assert {(3 * i, i) for i in range(30)} <= got
    assert sum((3 * i + 1, i) in got for i in range(30)) >= 28
    assert all(d // 3 == i and d % 3 < 2 for d, i in got)


def test_many_spaces_and_passes(documents, benchmark, monkeypatch):
    monkeypatch.setattr(D, "BLOCK_ITEMS", 4)
    monkeypatch.setattr(D, "PASS_BLOCKS", 2)
    rng = random.Random(5)
    items = [" ".join(words(rng, 20)) for _ in range(30)]
    docs = documents(*[(i, " ".join(words(rng, 30)) + " " + x) for i, x in enumerate(items)], (99, " ".join(words(rng, 50))))
    bench = benchmark(*enumerate(items))
    assert {(r.doc_id, r.item_id) for r in leaks(docs, bench).collect()} == {(i, i) for i in range(30)}
    assert [r.doc_id for r in without_leaks(docs, bench).collect()] == [99]


def test_odd_rows_and_empty_tables(odd_documents, documents, benchmark):
    odd = benchmark((1, None), (2, ""), (None, "a text without an id at all"), (4, "one"), (4, "one"))
    got = [(r.doc_id, r.item_id) for r in leaks(odd_documents, odd).collect()]
    assert sorted(got, key=repr) == sorted([(None, None), (4, 4), (4, 4)], key=repr)
    kept = without_leaks(odd_documents, odd)
    assert kept.columns == odd_documents.columns and kept.count() == odd_documents.count() - 2
    assert leaks(documents(), odd).collect() == [] and leaks(odd_documents, benchmark((1, "x")).limit(0)).collect() == []
    assert without_leaks(odd_documents, benchmark((1, "x")).limit(0)).count() == odd_documents.count()


def test_copies_of_a_passage_in_a_third_of_the_rows(documents, spark):
    """Its words weigh little and the others much, so its cosine is low in all rows."""
    sizes = (17, 33, 40, 59)
    items = [" ".join(f"item{n}word{i}" for i in range(n)) for n in sizes]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")

    def around(i, inside):
        return " ".join([*(f"before{i}x{k}" for k in range(70)), inside, *(f"after{i}x{k}" for k in range(70))])
    held = [(i, around(i, " ".join(items))) for i in range(0, 50)]
    held += [(100 + i * 10 + j, around(100 + i * 10 + j, item)) for i in range(3) for j, item in enumerate(items)]
    most = [(200 + j, around(200 + j, " ".join(item.split()[:-(-n * 13 // 20)])))
            for j, (n, item) in enumerate(zip(sizes, items))]
    plain = [(1000 + i, around(1000 + i, "nothing")) for i in range(100)]
    got = {(r.doc_id, r.item_id) for r in leaks(documents(*held, *most, *plain), benchmark).collect()}
    expected = {(i, j) for i in range(50) for j in range(4)}
    expected |= {(100 + i * 10 + j, j) for i in range(3) for j in range(4)} | {(200 + j, j) for j in range(4)}
    assert got == expected
