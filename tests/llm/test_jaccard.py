import itertools
import random

import pytest

from ratelens.llm import jaccard
from ratelens.llm.components import smallest_reachable
from ratelens.llm.jaccard import jaccard_components, one_per_component


def shingles(text, k=4):
    words = [w for w in (text or "").encode().lower().split()]
    if not words:
        return set()
    return {tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))}


def brute(rows):
    """Component of each row by comparing every two rows."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if sets[i] and sets[j] and 100 * both >= 85 * len(sets[i] | sets[j]):
            root[find(j)] = find(i)
    ids = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            r = find(i)
            ids[r] = min(ids.get(r, doc), doc)
    return sorted(((d, len(s), ids.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)


def corpus(seed, n=120, size=60):
    """Families of edited copies, a passage that many share, and exact copies."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(4000)]
    passage = rng.choices(words, k=30)
    rows, bases = [], [rng.choices(words, k=size) for _ in range(4)]
    for i in range(n):
        kind = rng.random()
        if kind < 0.6:
            text = list(rng.choice(bases))
            for _ in range(rng.randint(0, 4)):
                text[rng.randrange(len(text))] = rng.choice(words)
        elif kind < 0.8:
            text = passage + rng.choices(words, k=rng.randint(0, 40))
        else:
            text = rng.choices(words, k=rng.randint(1, 80))
        rows.append((i, " ".join(text)))
    return rows + rows[:7]


@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_brute_force(documents, seed):
    rows = corpus(seed)
    got = jaccard_components(documents(*rows)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)


def test_families_of_many_blocks(documents, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", 8)
    rows = corpus(3, n=150)
    got = jaccard_components(documents(*rows)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)


def test_hot_tokens_keep_their_links(documents, monkeypatch):
    monkeypatch.setattr(jaccard, "LEAST_HOT", 2)
    monkeypatch.setattr(jaccard, "_MOST_COUNT", 3)
    rows = corpus(4, n=80)
    got = jaccard_components(documents(*rows)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)


def test_link_exactly_at_the_threshold(documents):
    # 17 of 20 shingles: 100 * 17 == 85 * 20.
    base = [f"a{i}" for i in range(20)]
    longer = base + ["x1", "x2", "x3"]
    rows = [(1, " ".join(base)), (2, " ".join(longer)), (3, " ".join(longer + ["x4"]))]
    assert sorted((tuple(r) for r in jaccard_components(documents(*rows)).collect()), key=repr) == brute(rows)


def test_odd_rows(odd_documents):
    got = sorted((tuple(r) for r in jaccard_components(odd_documents).collect()), key=repr)
    assert got == brute([(r.doc_id, r.text) for r in odd_documents.collect()])


def test_empty_table(documents):
    got = jaccard_components(documents())
    assert got.columns == ["doc_id", "n_shingles", "component_id"] and got.collect() == []


def test_one_row_of_each_component(odd_documents):
    kept = one_per_component(odd_documents)
    assert kept.columns == odd_documents.columns
    got = sorted(((r.doc_id, (r.text or "")[:9]) for r in kept.collect()), key=repr)
    # 10 is linked with 5, 8 with 7; rows without words all stay.
    assert got == sorted([(1, ""), (2, ""), (3, " \n\t "), (4, "one"), (5, "a b c d e"), (5, "other wor"),
                          (None, "a text wi"), (None, ""), (7, "word0 ano"), (9, "😀 日本語 ▁ \x00")], key=repr)


def test_smallest_reachable_on_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 101)], "a long, b long")
    got = dict(smallest_reachable(links, "a", "b").collect())
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}
