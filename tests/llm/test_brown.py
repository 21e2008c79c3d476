import math
import zlib
from collections import Counter

import numpy as np
import pytest

from ratelens.llm import brown
from ratelens.llm.brown import exchange, scores


def brute(rows):
    """The base columns by counting in one dictionary."""
    count, tokens = Counter(), []
    for doc, text in rows:
        own = (text or "").encode().lower().split() + [None]
        held = doc is not None and zlib.crc32(str(doc).encode()) % 5 == 1
        tokens.append((doc, held, own))
        if not held:
            count.update(own)
    n, v = sum(count.values()), len(count)
    return [(d, h, len(t), sum(count[w] > 0 for w in t), n,
             sum(math.log10((count[w] + .5) / (n + .5 * (v + 1))) for w in t)) for d, h, t in tokens]


def same(got, expected):
    got = sorted((tuple(r)[:6] for r in got), key=lambda r: repr(r[:5]))
    expected = sorted(expected, key=lambda r: repr(r[:5]))
    assert [r[:5] for r in got] == [r[:5] for r in expected]
    assert np.allclose([r[5] for r in got], [r[5] for r in expected], rtol=1e-9)


def test_base_columns_and_gain_over_the_corpus(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    got = scores(docs).collect()
    same(got, brute([tuple(r) for r in docs.collect()]))
    out = [r for r in got if r.held_out]
    # The model predicts texts that it has not seen better than words alone do.
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_many_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(brown, "BLOCK_TOKENS", 500)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(60)
    same(scores(docs).collect(), brute([tuple(r) for r in docs.collect()]))


def test_scores_do_not_depend_on_the_layout(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    whole = {r.doc_id: r for r in scores(docs.coalesce(1)).collect()}
    monkeypatch.setattr(brown, "BLOCK_TOKENS", 700)
    for parts in (7, 40):
        for r in scores(docs.repartition(parts, "doc_id")).collect():
            assert math.isclose(r.score, whole[r.doc_id].score, rel_tol=1e-9)
            assert math.isclose(r.base_score, whole[r.doc_id].base_score, rel_tol=1e-9)


def test_units_are_what_has_the_share(spark, monkeypatch):
    monkeypatch.setattr(brown, "BLOCK_TOKENS", 300)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = brown.texts(docs.repartition(5, "doc_id")).withColumn("held", brown.held_out())
    blocks = brown.kept(brown._blocks(rows), "blocks")
    count = Counter()
    for doc, text in (tuple(r) for r in docs.collect()):
        if not (doc is not None and zlib.crc32(str(doc).encode()) % 5 == 1):
            count.update((text or "").encode().lower().split())
    total = sum(count.values())
    assert len(brown._frequent(blocks, total)[0]) == sum(c >= brown.UNIT_SHARE * total for c in count.values())


def test_odd_rows_and_empty_table(odd_documents, documents):
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    got = scores(odd_documents).collect()
    same(got, brute(rows))
    assert all(math.isfinite(r.score) and r.score <= 0 for r in got)
    assert scores(documents()).collect() == []


def test_nothing_to_learn_from(documents):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    got = scores(documents((held, "a b"))).collect()
    same(got, brute([(held, "a b")]))


def test_exchange_finds_alternating_classes():
    # Units 0-3 follow 4-7 and the other way round; 8 is the end.
    pairs = np.zeros((9, 9))
    pairs[:4, 4:8] = pairs[4:8, :4] = 10
    of = exchange(pairs, classes=2)
    assert len(set(of[:4])) == 1 and len(set(of[4:8])) == 1 and of[0] != of[4] and of[8] == 2


def test_exchange_never_lowers_the_likelihood():
    rng = np.random.default_rng(1)
    pairs = rng.poisson(2.0, (31, 31)).astype(float)

    def likelihood(of):
        count = np.zeros((6, 6))
        np.add.at(count, (of[:, None].repeat(31, 1), of[None, :].repeat(31, 0)), pairs)
        h = brown._h
        return h(count).sum() - h(count.sum(0)).sum() - h(count.sum(1)).sum()
    values = [likelihood(exchange(pairs, 5, sweeps)) for sweeps in range(6)]
    assert all(b >= a - 1e-9 for a, b in zip(values, values[1:])) and values[-1] > values[0]


@pytest.mark.parametrize("size", [0, 1, 100])
def test_words_with_ends(size):
    values = np.arange(size)
    lengths = np.array([size // 2, 0, size - size // 2])
    out = brown._with_ends(values, lengths, -1)
    assert out[out >= 0].tolist() == values.tolist() and np.flatnonzero(out < 0).tolist() == brown._ends(lengths).tolist()


def test_words_move_to_the_best_class_by_themselves():
    rng = np.random.default_rng(2)
    text = np.append(rng.integers(0, 40, 3000) * rng.integers(0, 2, 3000), 40)     # 40 is the end
    k = 5
    of = np.append(rng.integers(0, k, 40), k)
    before = np.concatenate([[40], text[:-1]])

    def counted(of):
        count = np.zeros((k + 1, k + 1))
        np.add.at(count, (of[before], of[text]), 1)
        return count

    def likelihood(word, c):
        changed = of.copy()
        changed[word] = c
        count = counted(changed)
        return brown._h(count).sum() - brown._h(count.sum(0)).sum() - brown._h(count.sum(1)).sum()
    around = np.zeros((40, 2 * k + 3))
    for a, b in zip(before, text):
        if a == b:
            around[b, -1] += 1
            continue
        if b < 40:
            around[b, of[a]] += 1
        if a < 40:
            around[a, k + 1 + of[b]] += 1
    values = np.array([[likelihood(w, c) for c in range(k)] for w in range(40)])
    got = brown.moved(counted(of), of[:40], around)
    assert np.allclose(values[np.arange(40), got], values.max(axis=1), rtol=1e-9) and (got != of[:40]).any()
    # A word that was not counted stays.
    assert brown.moved(counted(of), of[:3], np.zeros((3, 2 * k + 3))).tolist() == of[:3].tolist()


def test_rare_words_of_one_ending_are_told_apart_by_their_neighbours(documents, monkeypatch):
    monkeypatch.setattr(brown, "UNIT_SHARE", 0.05)
    monkeypatch.setattr(brown, "BLOCK_TOKENS", 100)
    learn = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 5 != 1]
    right, wrong = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 5 == 1][:2]
    rows = [(d, f"le a{i % 60}x da lo b{i % 60}x du" if i % 2 else "le aax da lo bbx du")
            for i, d in enumerate(learn[:300])]
    asked = [(right, "le a7x da lo b9x du"), (wrong, "le b9x da lo a7x du")]
    for parts in (1, 9):
        got = {r.doc_id: r for r in scores(documents(*rows, *asked).repartition(parts, "doc_id")).collect()}
        # The same words: counts and endings cannot tell the two texts apart, only the words' own neighbours.
        assert math.isclose(got[right].base_score, got[wrong].base_score)
        assert got[right].score > got[wrong].score + 2


def test_words_with_many_tokens_in_one_block(documents, monkeypatch):
    monkeypatch.setattr(brown, "UNIT_SHARE", 2.0)       # so that no word is a unit by itself
    rows = [(d, "a b " * 400 + "c c c") for d in range(20)]
    got = scores(documents(*rows).coalesce(1)).collect()
    same(got, brute(rows))
    assert all(math.isfinite(r.score) and r.score <= 0 for r in got)
