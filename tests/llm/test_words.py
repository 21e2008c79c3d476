import random

import numpy as np
import pyarrow as pa
import pytest

from ratelens.llm import words as W
from ratelens.llm.words import shingles_of, trimmed, words_of


def spelled(texts):
    out = []
    for words in words_of(pa.array(texts, pa.string())):
        for i in range(len(words.first) - 1):
            out.append([bytes(words.data[a:b]) for a, b in zip(
                words.begin[words.first[i]:words.first[i + 1]], words.end[words.first[i]:words.first[i + 1]])])
    return out


TEXTS = ["one two", "", None, " \t\n", "x", "é\x0bñ \x85 a b", "end ", " start", "no\x00break", "A B a b"]


@pytest.mark.parametrize("size", [1, 7, 1 << 20])
def test_words_are_those_of_split(monkeypatch, size):
    monkeypatch.setattr(W, "CHUNK_BYTES", size)
    assert spelled(TEXTS) == [(t or "").encode().split() for t in TEXTS]
    assert spelled([]) == []


def test_slices_of_a_column():
    column = pa.array(TEXTS, pa.string()).slice(3, 4)
    found = [n for words in words_of(column) for n in np.diff(words.first)]
    assert found == [len((t or "").encode().split()) for t in TEXTS[3:7]]


def test_equal_words_have_equal_hashes():
    rng = random.Random(1)
    text = " ".join("".join(rng.choices("abAB", k=rng.randint(1, 4))) for _ in range(2000))
    (words,) = words_of(pa.array([text]))
    hashes, plain = words.hashes(), text.lower().split()
    assert len(set(hashes.tolist())) == len(set(plain))
    assert len(set(zip(hashes.tolist(), plain))) == len(set(plain))


def test_hashes_do_not_depend_on_the_chunk(monkeypatch):
    texts = [f"word{i % 9} other" for i in range(50)]
    whole = [h for w in words_of(pa.array(texts)) for h in w.hashes().tolist()]
    monkeypatch.setattr(W, "CHUNK_BYTES", 10)
    assert [h for w in words_of(pa.array(texts)) for h in w.hashes().tolist()] == whole


def test_trimmed():
    (words,) = words_of(pa.array(["(one)### ... two. *** x", ]))
    cut = trimmed(words)
    assert [bytes(cut.data[a:b]) for a, b in zip(cut.begin, cut.end)] == [b"one", b".", b"two", b"*", b"x"]


def test_shingles():
    texts = ["a b c d e", "A b C d e", "a b c", "a b", "", None, "b c d e a b c d"]
    sets = [set(s.tolist()) for words in words_of(pa.array(texts)) for _, s in shingles_of(words, 4)]
    assert [len(s) for s in sets] == [2, 2, 1, 1, 0, 0, 5]
    assert sets[0] == sets[1] and len(sets[0] & sets[6]) == 2 and not sets[2] & sets[3]
