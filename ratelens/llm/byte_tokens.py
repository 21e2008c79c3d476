r"""Byte-level BPE by the tokenizers library over Arrow batches, and decoding.

A rank file lists tokens as bytes. The library works on characters, so each byte gets one: printable
bytes of Latin-1 stand for themselves, the others for the characters from U+0100 on. A token's merge
may come from any two tokens that make it up, all with the token's rank, and a match that is a token
is taken as it is; so the ids are those that merging by ranks gives.

Each distinct part of a batch (see ``cuts``) is encoded once and its ids are put together by Arrow.
Decoding looks the bytes of the ids up. Offsets follow from the tokens' lengths in bytes and the
number of the character each byte belongs to, so tokens that split a character are known.
"""

from __future__ import annotations

import base64
import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ratelens.llm.cuts import lists, parts_of, spread
from ratelens.llm.tables import texts

IDS = "array<int>"


def byte_characters() -> list[str]:
    """The character that stands for each byte."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


def read_ranks(file: str) -> dict[bytes, int]:
    """Tokens and ranks of a rank file: base64, a blank, the rank."""
    with open(file, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines) if a}


def tokenizer_of(ranks: dict[bytes, int], pattern: str) -> str:
    """The library's description of a tokenizer with these ranks; the pattern splits the text before."""
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    shown = byte_characters()
    if missing := [b for b in range(256) if bytes([b]) not in ranks]:
        raise ValueError(f"the vocabulary lacks the bytes {missing[:5]}, so not every text can be encoded")
    written = {token: "".join([shown[b] for b in token]) for token in ranks}
    merges = [(written[token[:i]], written[token[i:]])
              for token in sorted(ranks, key=ranks.__getitem__) for i in range(1, len(token))
              if token[:i] in ranks and token[i:] in ranks]
    made = Tokenizer(models.BPE(vocab={written[t]: r for t, r in ranks.items()}, merges=merges,
                                ignore_merges=True))
    made.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), "isolated"),
        pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return made.to_str()


class Codec:
    """A byte-level tokenizer and the bytes of its tokens."""

    def __init__(self, described: str) -> None:
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")     # Spark's tasks are the threads
        self.tokenizer = Tokenizer.from_str(described)
        self.tokenizer.encode_special_tokens = True                  # their strings are plain text
        back = {c: b for b, c in enumerate(byte_characters())}
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        table: list[bytes] = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            table[i] = bytes([back[c] for c in token]) if all(c in back for c in token) else token.encode()
        self.table = pa.array(table, pa.large_binary())
        self.lengths = np.array([len(t) for t in table], np.int64)

    def of_parts(self, parts: list[str]) -> pa.LargeListArray:
        """The ids of each part."""
        return lists([e.ids for e in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)])

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and where each text's start."""
        parts = parts_of(column)
        return spread(parts, self.of_parts(parts.distinct))

    def decode(self, ids: np.ndarray) -> memoryview:
        """The bytes of the ids. An id that the vocabulary lacks is an error."""
        found = self.table.take(pa.array(ids))
        return memoryview(found.buffers()[2] or b"")[:int(self.lengths[ids].sum())]


@lru_cache(maxsize=2)
def _codec(described: str) -> Codec:
    return Codec(described)


def character_offsets(ids: np.ndarray, data: memoryview, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First character of each token and the one after its last, and so where a character is split.

    ``data`` are the tokens' bytes. A token inside a character spans that character.
    """
    bytes_ = np.frombuffer(data, np.uint8)
    character = np.cumsum((bytes_ & 0xC0) != 0x80) - 1        # of each byte
    ends = np.cumsum(lengths[ids])
    begins = ends - lengths[ids]
    return (character[begins], character[ends - 1] + 1) if len(ids) else (begins, ends)


def described_ranks(ranks_file: str, pattern: str) -> str:
    return tokenizer_of(read_ranks(ranks_file), pattern)


def encode(docs: DataFrame, ranks_file: str, pattern: str, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``doc_id``, ``text``, ``ids``, ``begins`` and ``ends`` (character offsets of each token).

    A null text has nulls, an empty one empty lists. Whole texts are encoded, however long; a text's
    tokens are held in memory together. Repeated rows give repeated results, an empty table none,
    and other columns of the table are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(described_ranks(ranks_file, pattern))
    rows = texts(docs, id_col, text_col)
    schema = T.StructType([*rows.schema.fields, *[T.StructField(n, T.ArrayType(T.IntegerType()))
                                                  for n in ("ids", "begins", "ends")]])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(sent.value)
        for batch in batches:
            column = batch.column("text")
            ids, first = codec.encode(column)
            spans = [character_offsets(ids[a:b], codec.decode(ids[a:b]), codec.lengths)
                     for a, b in zip(first, first[1:])]
            begins, ends = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (zip(*spans) if spans else ([], [])))
            missing = column.is_null().to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[_nullable_lists(v, first, missing) for v in (ids, begins, ends)]],
                schema.names)
    return rows.mapInArrow(work, schema)


def _nullable_lists(values: np.ndarray, first: np.ndarray, missing: np.ndarray) -> pa.ListArray:
    offsets = pa.array(first.astype(np.int32), mask=np.append(missing, False))
    return pa.ListArray.from_arrays(offsets, pa.array(values.astype(np.int32)))


def decode(encoded: DataFrame, ranks_file: str, ids_col: str = "ids", to: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its ids in the column ``to``; null ids give null.

    Bytes that are no UTF-8, as ids cut inside a character leave them, become U+FFFD.
    """
    tokens = {r: t for t, r in read_ranks(ranks_file).items()}
    table = [tokens.get(i) for i in range(max(tokens) + 1)]
    sent = encoded.sparkSession.sparkContext.broadcast(table)
    schema = T.StructType([*[f for f in encoded.schema.fields if f.name != to], T.StructField(to, T.StringType())])
    at = schema.names.index(ids_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = sent.value
        for batch in batches:
            given = batch.columns[:-1]
            out = [None if ids is None else b"".join([of[i] for i in ids]).decode("utf-8", "replace")
                   for ids in given[at].to_pylist()]
            yield pa.RecordBatch.from_arrays([*given, pa.array(out, pa.string())], schema.names)
    kept = [F.col(f"`{n}`") for n in schema.names[:-1]]
    return encoded.select(*kept, F.lit(None).cast("string").alias(to)).mapInArrow(work, schema)


def encoding_digests(docs: DataFrame, ranks_file: str, pattern: str) -> DataFrame:
    """Per row ``doc_id``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``, ``n_split``.

    The digests are those of the ids as little-endian unsigned 32-bit integers and of the bytes that
    decoding them gives; ``n_split`` counts tokens that start inside a character. Null counts as empty.
    """
    sent = docs.sparkSession.sparkContext.broadcast(described_ranks(ranks_file, pattern))
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_split long"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(sent.value)
        for batch in batches:
            ids, first = codec.encode(batch.column("text"))
            written, data = ids.astype("<u4"), codec.decode(ids)
            ends = np.concatenate([[0], np.cumsum(codec.lengths[ids])])
            inside = np.frombuffer(data, np.uint8)[ends[:-1]] & 0xC0 == 0x80
            split = np.concatenate([[0], np.cumsum(inside)])[first]
            bounds = list(zip(first.tolist(), first[1:].tolist()))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"),
                "n_tokens": pa.array(np.diff(first)),
                "ids_sha256": [hashlib.sha256(written[a:b].data).hexdigest() for a, b in bounds],
                "decoded_sha256": [hashlib.sha256(data[ends[a]:ends[b]]).hexdigest() for a, b in bounds],
                "n_split": pa.array(np.diff(split)),
            })
    return texts(docs).mapInArrow(work, schema)
