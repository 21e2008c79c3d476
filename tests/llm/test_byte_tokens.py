import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from ratelens.llm import byte_tokens as B
from ratelens.llm.cuts import parts_of

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
ODD = ["", " ", "  ", "a", " a", "a ", "  two  blanks ", "\n", "a\n\n b", "a \n b\t c", "\u3000 x\u3000y", "\x1c a \x1cb",
       "it's 'tis we'll", "日本語 😀 é e\u0301", "\x00\t\r\n", "<|endoftext|> a<|endoftext|>", "a" * 3000, "x   " * 50]


@pytest.fixture(scope="module")
def codec():
    return B.Codec(B.described_ranks(RANKS, PATTERN))


@pytest.fixture(scope="module")
def plain():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=B.read_ranks(RANKS), special_tokens={})


def ids_of(codec, every):
    ids, first = codec.encode(pa.array(every, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(first, first[1:])]


def test_same_ids_as_ranks_give(codec, plain):
    rng = random.Random(4)
    letters = [*"aabbeethonr  \n\t19.,!-_()éñ日😀\u3000\xa0\x1c\x85\u0301", " the", "'s", "ing", "\r\n", "   ", "<|endoftext|>"]
    every = ODD + ["".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(4000)]
    assert ids_of(codec, every) == [plain.encode_ordinary(t) for t in every]


def test_same_ids_around_every_character(codec, plain):
    for start in range(0, 0x110000, 0x8000):
        every = [f"a{c} {c}{c}1{c} a" for c in map(chr, range(start, start + 0x8000, 3)) if not 0xD800 <= ord(c) < 0xE000]
        assert ids_of(codec, every) == [plain.encode_ordinary(t) for t in every]


@pytest.mark.parametrize("lead", [False, True])
def test_parts_make_up_the_texts(lead):
    parts = parts_of(pa.array([*ODD, None]), lead)
    for text, a, b in zip([*ODD, ""], parts.first, parts.first[1:]):
        joined = "".join(parts.distinct[c] for c in parts.codes[a:b])
        assert joined == (" " if lead and text else "") + text
    assert parts_of(pa.array([], pa.string()), lead).codes.size == 0


def test_encode_and_decode_tables(odd_documents, documents):
    encoded = B.encode(odd_documents, RANKS, PATTERN)
    both = B.decode(encoded, RANKS).collect()
    assert len(both) == odd_documents.count()
    for r in both:
        assert r.decoded == r.text and (r.ids is None) == (r.text is None) == (r.begins is None)
        if r.text:
            assert r.begins[0] == 0 and r.ends[-1] == len(r.text)
            assert all(a < b for a, b in zip(r.begins, r.ends))
    assert B.encode(documents(), RANKS, PATTERN).collect() == []


def test_offsets_tell_split_characters(spark, documents):
    row = B.encode(documents((1, "a\U000102a7b")), RANKS, PATTERN).head()
    spans = list(zip(row.begins, row.ends))
    assert spans.count((1, 2)) > 1 and spans[0] == (0, 1) and spans[-1] == (2, 3)
    cut = spark.createDataFrame([(1, row.ids[:-2]), (2, []), (3, None)], "doc_id long, ids array<int>")
    assert [r.decoded for r in B.decode(cut, RANKS).orderBy("doc_id").collect()] == ["a\ufffd", "", None]


def test_digests_against_the_plain_encoder(spark, odd_documents, plain):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs = docs.select("doc_id", "text").union(odd_documents.select("doc_id", "text"))
    docs = docs.union(docs.where("doc_id < 20"))                  # repeated rows
    expected = []
    for doc_id, text in docs.collect():
        ids = plain.encode_ordinary(text or "")
        expected.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                         hashlib.sha256((text or "").encode()).hexdigest()))
    got = [tuple(r)[:4] for r in B.encoding_digests(docs, RANKS, PATTERN).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert B.encoding_digests(docs.where(F.lit(False)), RANKS, PATTERN).collect() == []


def test_vocabulary_without_bytes_is_refused():
    with pytest.raises(ValueError, match="lacks"):
        B.tokenizer_of({b"a": 0}, PATTERN)
