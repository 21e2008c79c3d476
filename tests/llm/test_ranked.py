import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from ratelens.llm import ranked
from ratelens.llm.ranked import Block, Item, best_of_block, ranked_documents, units_of

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def brute(docs, items, k):
    """Everything scored, in plain Python."""
    held = [(i, Counter(terms_of(t))) for i, t in docs]
    n = sum(bool(c) for _, c in held)
    total = sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item_id, text in items:
        scored = []
        for doc_id, c in held:
            m = 75 + (25 * sum(c.values()) * n) // max(total, 1)
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                        for t in terms_of(text) if t in c)
            if score > 0 and doc_id is not None:
                scored.append((-score, doc_id))
        out += [(item_id, r + 1, d, -s) for r, (s, d) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def corpus(rng, n):
    """Common words, rare words, a text that a third of the rows hold, ties."""
    words = [f"w{i}" for i in range(60)] + ["The", "the", "of", "é", "日本"]
    shared = " ".join(rng.choices(words, k=30))
    rows = []
    for i in range(n):
        text = shared if i % 3 == 0 else " ".join(rng.choices(words, weights=[1 / (j + 1) for j in range(65)], k=rng.randint(0, 50)))
        rows.append((i, text + rng.choice(["", ".", f" rare{i}", ", rare7!"])))
    return rows


@pytest.mark.parametrize("block, items_at_once, k", [(10_000, 100, 20), (60, 3, 5), (500, 7, 1)])
def test_same_as_scoring_everything(spark, documents, monkeypatch, block, items_at_once, k):
    monkeypatch.setattr(ranked, "BLOCK_TOKENS", block)
    monkeypatch.setattr(ranked, "ITEMS", items_at_once)
    rng = random.Random(block)
    docs = corpus(rng, 300) + [(None, "w1 w2 w3 rare7"), (7, "w1 w1 w2"), (7, "w1 w1 w2"), (400, None), (401, ""), (402, " .,")]
    items = [(i, " ".join(rng.choices([f"w{j}" for j in range(60)] + ["rare7", "rare8", "rare30", "nowhere", "OF"], k=rng.randint(1, 30))))
             for i in range(12)] + [(50, None), (51, ""), (52, "nowhere"), (3, "w1 w2"), (3, "w1 w2"), (None, "w5 rare7")]
    asked = spark.createDataFrame(items, "item_id long, text string").repartition(3)
    got = ranked_documents(documents(*docs).repartition(4), asked, k).collect()
    assert sorted([tuple(r) for r in got], key=repr) == brute(docs, items, k)


def test_odd_tables(spark, odd_documents, documents):
    items = spark.createDataFrame([(1, "one word1 another2", "x")], "item_id long, text string, score string")
    docs = [(r.doc_id, r.text) for r in odd_documents.select("doc_id", "text").collect()]
    assert sorted(tuple(r) for r in ranked_documents(odd_documents, items).collect()) == brute(docs, [(1, "one word1 another2")], 20)
    assert ranked_documents(documents(), items).collect() == []
    assert ranked_documents(odd_documents, items.limit(0)).collect() == []


def random_block(rng, n_docs, n_terms):
    block = Block(np.arange(n_docs), {}, {}, {})
    for t in range(n_terms):
        docs = np.array(sorted(rng.sample(range(n_docs), rng.randint(1, n_docs))))
        block.docs[t] = docs
        block.gains[t] = np.array([rng.randint(1, 1000) for _ in docs], np.int64)
        block.tops[t] = int(block.gains[t].max())
    return block


def test_pairs_tighten_the_bound_and_lose_nothing():
    rng, tighter = random.Random(5), 0
    for _ in range(200):
        block = random_block(rng, 40, 9)
        item = Item(1, {t: rng.choice([1, 1, 1, 2]) for t in range(9)})
        item.pairs = [p for p in ranked.item_pairs(list(item.times), {t: len(block.docs[t]) for t in item.times})]
        joint = {p: int(j.max()) for p in item.pairs if len(j := ranked.joint_impacts(block, *p))}
        scores = np.zeros(40, np.int64)
        for t, n in item.times.items():
            scores[block.docs[t]] += block.gains[t] * n
        units = units_of(item, block.tops, joint)
        assert sorted(t for _, ts in units for t in ts) == list(range(9))
        bound = sum(b for b, _ in units)
        assert scores.max() <= bound <= sum(block.tops[t] * n for t, n in item.times.items())
        tighter += bound < sum(block.tops[t] * n for t, n in item.times.items())
        least = int(np.sort(scores)[-rng.randint(1, 30)])
        got = sorted(best_of_block(block, item, units, 40, least))
        assert got == sorted((int(s), -i) for i, s in enumerate(scores) if s >= max(least, 1))
    assert tighter > 50


def test_blocks_below_the_score_to_beat_are_left_out():
    block = random_block(random.Random(6), 10, 2)
    assert best_of_block(block, Item(1, {0: 1, 1: 1}), [(5, (0,)), (6, (1,))], 3, 12) == []
