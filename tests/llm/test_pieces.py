import itertools
import random

import pytest

from ratelens.llm import pieces
from ratelens.llm.pieces import MARK, Vocabulary, decode, decode_ids, encode, encode_texts, encoded_words, vocabulary

VOCAB = vocabulary(pieces.MODEL)
TEXTS = ["", " ", "  two  blanks ", "\n", "a\n\n b", f"own {MARK} mark{MARK}", f"\n{MARK}x", "日本語 😀 é", "\x00\t\r\n",
         "Hello world", "a" * 300, "퟿\U0010ffff"]


def test_round_trip():
    for text in TEXTS:
        ids = encode_texts([text], VOCAB)[0]
        assert decode_ids(ids, VOCAB) == text, text


def test_round_trip_of_any_text():
    rng = random.Random(2)
    letters = ["a", "b", " ", " ", "\n", MARK, "é", "😀", "\t", "the"]
    every = ["".join(rng.choices(letters, k=rng.randint(0, 40))) for _ in range(500)]
    assert [decode_ids(i, VOCAB) for i in encode_texts(every, VOCAB)] == every


def small():
    vocab = Vocabulary(of_byte=list(range(1000, 1256)))
    for i, (piece, score) in enumerate([(MARK, -3.0), (MARK + "a", -2.0), ("a", -4.0), ("b", -4.0), ("ab", -3.0),
                                        ("aba", -6.5), ("bab", -5.0), (MARK + "ab", -4.5)]):
        vocab.add(piece, i, score)
    return vocab


def test_best_score_as_by_trying_all_splits():
    vocab, scores = small(), {}
    for piece, i in ((MARK, 0), (MARK + "a", 1), ("a", 2), ("b", 3), ("ab", 4), ("aba", 5), ("bab", 6), (MARK + "ab", 7)):
        node = vocab.root
        for c in piece:
            node = node[c]
        scores[piece] = node[""]
    words = [MARK + "".join(w) for n in range(8) for w in itertools.product("ab", repeat=n)]
    got = encoded_words(words, vocab)
    of_id = {i: s for i, s in scores.values()}
    for word in words:
        best = {0: 0.0}
        for end in range(1, len(word) + 1):
            best[end] = max(best[s] + scores[word[s:end]][1] for s in range(end)
                            if word[s:end] in scores and s in best)
        assert abs(sum(of_id[i] for i in got[word]) - best[len(word)]) < 1e-9, word
        assert "".join(vocab.text[i] for i in got[word]).replace(" ", MARK) == word


def test_sharing_prefixes_changes_nothing():
    rng = random.Random(3)
    words = {MARK + "".join(rng.choices(["th", "er", "on", "x", "é", "q"], k=rng.randint(0, 6))) for _ in range(400)}
    together = encoded_words(words, VOCAB)
    assert all(encoded_words([w], VOCAB)[w] == ids for w, ids in together.items())


def test_encode_and_decode_tables(odd_documents, documents, monkeypatch):
    monkeypatch.setattr(pieces, "BATCH_CHARS", 50)
    both = decode(encode(odd_documents, pieces.MODEL), pieces.MODEL).collect()
    assert len(both) == odd_documents.count()
    assert all(r.decoded == r.text and (r.ids is None) == (r.text is None) for r in both)
    assert encode(documents(), pieces.MODEL).collect() == []


def test_vocabulary_without_bytes_is_refused(monkeypatch):
    import sentencepiece

    monkeypatch.setattr(sentencepiece.SentencePieceProcessor, "is_byte", lambda self, i: False)
    with pytest.raises(ValueError):
        vocabulary(pieces.MODEL)


def own_encoding(texts):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL).encode(texts, num_threads=1)


def test_pieces_are_those_of_the_models_own_encoder(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("text is not null").collect()
    texts = [r.text for r in rows if MARK not in r.text]
    assert len(texts) > 900 and encode_texts(texts, VOCAB) == own_encoding(texts)


def test_own_encoder_on_any_text():
    rng = random.Random(5)
    bits = ["a", "b", "the", "ing", "  ", "    ", " ", "\n", "\t", "é", "😀", "日本", "1", "....", "==", "un", "Б", "\x00"]
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 60))) for _ in range(2000)]
    texts += ["a" * 5000, " " * 3000, "ab" * 2000 + " end", "the quick brown fox", "日本語" * 500]
    assert encode_texts(texts, VOCAB) == own_encoding(texts)


def test_forgetting_pairs_changes_nothing(monkeypatch):
    texts = ["the quick brown fox jumps over the lazy dog", "another unrelated sentence of ordinary words"]
    whole = encode_texts(texts, VOCAB)
    monkeypatch.setattr(pieces, "PAIRS_KEPT", 3)
    assert encode_texts(texts, VOCAB) == whole


def test_piece_found_though_its_last_letter_is_no_piece():
    vocab = Vocabulary(of_byte=list(range(1000, 1256)))
    for i, (piece, score) in enumerate([(MARK, -3.0), ("a", -4.0), ("ab", -3.5)]):
        vocab.add(piece, i, score)
    assert encoded_words([MARK + "ab"], vocab) == {MARK + "ab": [0, 2]}


def test_remembered_words_change_nothing(monkeypatch):
    monkeypatch.setattr(pieces, "WORDS_KEPT", 6)
    seen, texts = {}, ["the quick fox", "the lazy fox " + "x" * 100, "", "a b c d e f g h", "the quick fox"]
    assert [encode_texts([t], VOCAB, {}, seen)[0] for t in texts] == own_encoding(texts)
    assert len(seen) <= 6
