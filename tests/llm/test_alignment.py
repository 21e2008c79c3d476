import hashlib
import random
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from ratelens.llm import alignment
from ratelens.llm.alignment import aligned_documents, bitmaps, block_counts, inverted, pair_counts, read_bitmaps
from ratelens.llm.byte_tokens import byte_characters
from ratelens.llm.tables import texts

FILES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [None, "", " ", "  ", "\n", "a", " a", "a  b", "x \n y\n\nz ", "own ▁ mark", "▁", "日本語 😀 é", "\x00\t\r\n", "<|endoftext|>",
       "<s> a</s> <0x41> <unk>", "ﬁ ① e\u0301", "\u3000 x\u3000y", "a" * 500, "it's  'tis"]


@pytest.fixture(scope="module")
def plain():
    a = Tokenizer.from_file(FILES[0])
    a.encode_special_tokens = True
    b, back = sentencepiece.SentencePieceProcessor(model_file=FILES[1]), {c: i for i, c in enumerate(byte_characters())}

    def both(text):
        """(id, bytes) of the tokens of whole texts, by the libraries themselves."""
        encoded = a.encode(" " + text, add_special_tokens=False)
        ours = [(i, bytes(back[c] for c in t)) for i, t in zip(encoded.ids, encoded.tokens)]
        ids = b.encode(text)
        theirs = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i)
                   else b.id_to_piece(i).replace("▁", " ").encode()) for i in ids]
        same = b"".join(x for _, x in ours) == b"".join(x for _, x in theirs) == (" " + text).encode()
        return (ours, theirs) if text and same else ([], [])
    return both


def spans(tokens):
    ends = np.cumsum([len(x) for _, x in tokens]).tolist() if tokens else []
    return [(i, e - len(x), e) for (i, x), e in zip(tokens, ends)]


def brute(docs, plain):
    made, count, held = [], Counter(), defaultdict(set)
    for place, (doc_id, text) in enumerate(docs):
        a, b = (spans(x) for x in plain(text or ""))
        links, j = [], 0
        for i, x, y in a:
            while j < len(b) and b[j][2] <= x:
                j += 1
            n = j
            while n < len(b) and b[n][1] < y:
                links.append((i, b[n][0]))
                n += 1
        cuts = sorted({y for *_, y in a} & {y for *_, y in b})
        within = {cut: ([], []) for cut in cuts}
        for side, tokens in enumerate((a, b)):
            for i, _, y in tokens:
                within[cuts[bisect_left(cuts, y)]][side].append(str(i))
        groups = ["|".join(map(",".join, within[cut])) for cut in cuts]
        made.append((doc_id, len(a), len(b), len(groups), links, groups))
        count.update(links)
        for link in links:
            held[link].add(place)
    most = defaultdict(int)
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    return sorted([(d, na, nb, ng, len(links), sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links),
                    hashlib.sha256(";".join(groups).encode()).hexdigest() if na else "",
                    sum(len(held[x]) == 1 for x in links)) for d, na, nb, ng, links, groups in made], key=repr), count, held


def some_docs(n=120):
    rng = random.Random(8)
    letters = ["the ", "ing", " of", "é", "日", "  ", "\n", "'s", "x", "q", "0", "1", "▁", ".", " ", "tion ", "queue "]
    rows = [(i, "".join(rng.choices(letters, weights=[9] * 4 + [1] * 9 + [9] * 4, k=rng.randint(1, 60)))) for i in range(n)]
    return rows + [(1000 + i, t) for i, t in enumerate(ODD)] + [(2000 + i, "the same text again") for i in range(n // 2)] + [(2000, "x y"), (None, "no id")]


@pytest.mark.parametrize("links, docs_a_block, slice_", [(1 << 22, 1 << 16, 1 << 21), (300, 1 << 16, 50), (1 << 22, 7, 1 << 21)])
def test_same_as_by_hand(spark, documents, plain, monkeypatch, links, docs_a_block, slice_):
    monkeypatch.setattr(alignment, "BLOCK_LINKS", links)
    monkeypatch.setattr(alignment, "BLOCK_DOCS", docs_a_block)
    monkeypatch.setattr(alignment, "SLICE_LINKS", slice_)
    rows = some_docs()
    expected, count, held = brute(rows, plain)
    got = [tuple(r) for r in aligned_documents(documents(*rows).repartition(3), *FILES).collect()]
    assert sorted(got, key=repr) == expected


def test_whole_texts_of_the_given_table(spark, plain):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    expected, _, _ = brute([(r.doc_id, r.text) for r in docs.collect()], plain)
    assert sorted([tuple(r) for r in aligned_documents(docs, *FILES).collect()], key=repr) == expected


def test_counts_of_pairs(spark, documents, plain):
    rows = some_docs(40)
    _, count, held = brute(rows, plain)
    counted = block_counts(inverted(texts(documents(*rows).repartition(4)), *FILES))
    got = {(r.a_id, r.b_id): (r.n_links, r.n_docs) for r in pair_counts(counted, 32000).collect()}
    assert got == {pair: (n, len(held[pair])) for pair, n in count.items()}


@pytest.mark.parametrize("n_docs", [1, 8, 9, 300, 5000])
def test_bitmaps_hold_what_went_in(n_docs):
    rng = np.random.default_rng(n_docs)
    postings = np.unique(rng.integers(0, 50, 4000) << 16 | rng.integers(0, n_docs, 4000))
    counts = rng.choice([1, 1, 1, 2, 3, 9, 70], len(postings))
    row = dict(zip(("keys", "planes", "sizes", "sparse", "dense"), bitmaps(postings, counts, n_docs)), n_docs=n_docs)
    keys, weights, of, place = read_bitmaps(row)
    back = Counter()
    for i, p in zip(of, place):
        back[int(keys[i]) << 16 | int(p)] += int(weights[i])
    assert back == dict(zip(postings.tolist(), counts.tolist()))


def test_odd_tables(odd_documents, documents, plain):
    rows = [(r.doc_id, r.text) for r in odd_documents.select("doc_id", "text").collect()]
    assert sorted([tuple(r) for r in aligned_documents(odd_documents, *FILES).collect()], key=repr) == brute(rows, plain)[0]
    assert aligned_documents(documents(), *FILES).collect() == []
    assert [tuple(r)[1:] for r in aligned_documents(documents((1, None), (2, "")), *FILES).collect()] == [(0,) * 6 + ("", 0)] * 2
