r"""Alignment of two tokenizers over a corpus by inverted bitmaps of id pairs.

A byte-level BPE (A) and a model of pieces (B) cut the same bytes, a blank and the text. Where a token
of A and one of B end together, groups end; a link is a pair of tokens whose bytes overlap. Between
two neighbouring ends of either lies exactly one link, so links are found by merging the ends.

Tokens, groups and links of a text are those of its parts (see ``cuts``), so each distinct part of a
batch is aligned once.

``inverted`` deals the documents into blocks and stores, for each pair of ids that is linked in a
block, bitmaps over the block's documents: plane p has the documents in which the pair's number of
links has bit p. A bitmap is a list of places where that is shorter. Bitmaps of different blocks have
no document in common, so their OR is laid out by block, and counts of set bits add up: ``pair_counts``
takes a pair's documents from the OR of its planes and its links from the planes' bits by weight.
The sums are shuffled, bitmaps never are by pair, so a pair that is in every document has one small
row a block. ``scored_documents`` sends the counts back along the postings: each block gets the counts
of its pairs and adds them to the documents that its bitmaps name.

A block has at most 65,536 documents and closes after four million links. Memory follows the longest
text and a block's distinct pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ratelens.llm.byte_tokens import Codec
from ratelens.llm.cuts import Parts, lists, parts_of
from ratelens.llm.tables import kept, texts

MARK = "▁"
BLOCK_LINKS = 1 << 22
BLOCK_DOCS = 1 << 16
SLICE_LINKS = 1 << 21           # of a text whose links are counted at once

_DOCS = "doc_ids array<long>, numbers binary, digests array<string>"
_BITS = "n_docs int, keys binary, planes binary, sizes binary, sparse binary, dense binary"
_BLOCK = f"block long, {_DOCS}, {_BITS}"


# ---- two tokenizers -------------------------------------------------------------------------

@dataclass
class Aligned:
    """Per part: numbers of tokens, groups and links; the groups in text form; the links' pairs."""

    good: np.ndarray            # both tokenizers give the part's bytes
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups: pa.Array
    links: pa.LargeListArray


def _slices(values: np.ndarray, first: np.ndarray) -> pa.LargeListArray:
    return pa.LargeListArray.from_arrays(pa.array(first.astype(np.int64)), values)


def _joined(strings: pa.Array, first: np.ndarray, between: str) -> pa.Array:
    """Each run of ``strings`` as one string."""
    runs = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), strings)
    return pc.binary_join(runs, pa.scalar(between, strings.type))


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values[first[i]:first[i + 1]]``."""
    return np.diff(np.concatenate([[0], np.cumsum(values)])[first])


class Aligner:
    """Both tokenizers, and the bytes of their tokens."""

    def __init__(self, described: str, model: bytes) -> None:
        import sentencepiece

        self.a = Codec(described)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.n_pieces = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(self.n_pieces)]
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("a piece has a mark behind other characters, so texts cannot be cut at blanks")
        self.b_table = pa.array([bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode()
                                 for i, p in enumerate(pieces)], pa.large_binary())
        self.b_lengths = np.array([len(x) for x in self.b_table.to_pylist()], np.int64)
        self.shown = pa.array([str(i) for i in range(max(len(self.a.table), self.n_pieces))], pa.large_string())

    def _good(self, parts: pa.Array, a: pa.LargeListArray, b: pa.LargeListArray) -> np.ndarray:
        """Which parts both tokenizers give back byte by byte."""
        good = np.ones(len(parts), bool)
        bounds = np.frombuffer(parts.buffers()[1], np.int64)[:len(parts) + 1]
        whole = memoryview(parts.buffers()[2] or b"")[:bounds[-1]]
        for ids, table, lengths in ((a, self.a.table, self.a.lengths), (b, self.b_table, self.b_lengths)):
            flat, first = ids.flatten(), ids.offsets.to_numpy()
            made = table.take(flat).buffers()[2]
            places = np.concatenate([[0], np.cumsum(lengths[flat.to_numpy()])])
            made = memoryview(made or b"")[:places[-1]]
            if made == whole and np.array_equal(places[first], bounds):
                continue
            ends = places[first]
            good &= [made[x:y] == whole[u:v] for x, y, u, v in zip(
                ends[:-1].tolist(), ends[1:].tolist(), bounds[:-1].tolist(), bounds[1:].tolist())]
        return good

    def align(self, distinct: list[str]) -> Aligned:
        """Each part by itself. Parts start with a blank, which the model of pieces puts there itself."""
        a, b = self.a.of_parts(distinct), lists(self.b.encode([p[1:] for p in distinct], num_threads=1))
        good = self._good(pa.array(distinct, pa.large_string()), a, b)
        if not good.all():
            nothing = pa.array([None if ok else [] for ok in good], a.type)
            a, b = (pc.if_else(pa.array(good), x, nothing) for x in (a, b))
            a, b = (_slices(x.flatten(), np.concatenate([[0], np.cumsum(pc.list_value_length(x).to_numpy())]))
                    for x in (a, b))
        a_first, b_first = a.offsets.to_numpy(), b.offsets.to_numpy()
        a_ids, b_ids = a.flatten().to_numpy(), b.flatten().to_numpy()
        a_ends, b_ends = np.cumsum(self.a.lengths[a_ids]), np.cumsum(self.b_lengths[b_ids])
        part_ends = np.concatenate([[0], a_ends])[a_first]
        common = np.intersect1d(a_ends, b_ends, assume_unique=True)
        either = np.union1d(a_ends, b_ends)
        keys = a_ids[np.searchsorted(a_ends, either)].astype(np.int64) * self.n_pieces \
            + b_ids[np.searchsorted(b_ends, either)]
        groups_first = np.searchsorted(common, part_ends, "right")
        links_first = np.searchsorted(either, part_ends, "right")
        sides = [_joined(self.shown.take(pa.array(ids)), np.append([0], np.searchsorted(ends, common, "right")), ",")
                 for ids, ends in ((a_ids, a_ends), (b_ids, b_ends))]
        shown = pc.binary_join_element_wise(*sides, pa.scalar("|", self.shown.type))
        return Aligned(good, np.diff(a_first), np.diff(b_first), np.diff(groups_first), np.diff(links_first),
                       _joined(shown, groups_first, ";"), _slices(pa.array(keys), links_first))


@lru_cache(maxsize=2)
def _aligner(described: str, model: bytes) -> Aligner:
    return Aligner(described, model)


@dataclass
class Numbers:
    """Per text: tokens of A and of B, groups, links; the digest of its groups; the parts that count."""

    counts: np.ndarray          # four columns
    digests: list[str]
    aligned: Aligned
    parts: Parts


def align_texts(column: pa.Array, aligner: Aligner) -> Numbers:
    """Texts of which a tokenizer does not give all bytes back have no tokens, as null and empty ones."""
    parts = parts_of(column, lead=True)
    aligned = aligner.align(parts.distinct)
    whole = _sums(~aligned.good[parts.codes], parts.first) == 0
    of_text = np.repeat(np.arange(len(column)), np.diff(parts.first))
    counts = whole[of_text] & (aligned.n_a[parts.codes] > 0)
    codes = parts.codes[counts]
    first = np.concatenate([[0], np.cumsum(np.bincount(of_text[counts], minlength=len(column)))])
    groups = _joined(aligned.groups.take(pa.array(codes)), first, ";")
    digests = [hashlib.sha256(g.as_buffer()).hexdigest() if n else "" for g, n in zip(groups, np.diff(first))]
    numbers = np.stack([_sums(x[codes], first) for x in
                        (aligned.n_a, aligned.n_b, aligned.n_groups, aligned.n_links)], axis=1)
    return Numbers(numbers.astype(np.int64), digests, aligned, Parts(parts.distinct, codes, first))


# ---- inverted bitmaps -----------------------------------------------------------------------

def _merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[starts], np.add.reduceat(counts, starts) if len(starts) else counts


def posting_counts(numbers: Numbers, before: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(pair << 16 | place of the document) and links, slice by slice; ``before`` documents come first."""
    codes, first = numbers.parts.codes, numbers.parts.first
    of_text = np.repeat(np.arange(len(first) - 1), np.diff(first)) + before
    ends = np.cumsum(numbers.aligned.n_links[codes])
    start = 0
    while start < len(codes):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + SLICE_LINKS, "right")))
        some = codes[start:stop]
        pairs = numbers.aligned.links.take(pa.array(some)).flatten().to_numpy()
        places = np.repeat(of_text[start:stop], numbers.aligned.n_links[some])
        yield np.unique(pairs << 16 | places, return_counts=True)
        start = stop


def bitmaps(postings: np.ndarray, counts: np.ndarray, n_docs: int) -> list[bytes]:
    """Bitmaps of all pairs and planes: keys, planes, sizes in bytes, the short ones, the full ones.

    A full one has ``ceil(n_docs / 8)`` bytes; one of fewer documents than that has bytes is a list of
    places of two bytes each, if that is shorter.
    """
    full = -(-n_docs // 8)
    keys, planes, sizes, sparse, dense = [], [], [], [], []
    for plane in range(int(counts.max()).bit_length() if len(counts) else 0):
        own = postings[(counts >> plane) & 1 == 1]
        pair, start, n = np.unique(own >> 16, return_index=True, return_counts=True)
        places, is_full = (own & 0xFFFF).astype("<u2"), 2 * n >= full
        keys.append(pair)
        planes.append(np.full(len(pair), plane, np.uint8))
        sizes.append(np.where(is_full, full, 2 * n).astype("<u4"))
        sparse.append(places[~np.repeat(is_full, n)])
        bits = np.zeros((int(is_full.sum()), n_docs), bool)
        bits[np.repeat(np.arange(len(bits)), n[is_full]), places[np.repeat(is_full, n)]] = True
        dense.append(np.packbits(bits, axis=1).ravel())
    return [np.concatenate([np.zeros(0, kind), *x]).astype(kind).tobytes() for kind, x in
            (("<i8", keys), ("u1", planes), ("<u4", sizes), ("<u2", sparse), ("u1", dense))]


def read_bitmaps(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pairs and weights (2 to the plane) of a block's bitmaps; and of every set bit its bitmap and place."""
    n_docs, keys = row["n_docs"], np.frombuffer(row["keys"], "<i8")
    sizes, full = np.frombuffer(row["sizes"], "<u4").astype(np.int64), -(-row["n_docs"] // 8)
    is_full = sizes == full
    n = np.where(is_full, 0, sizes // 2)
    of_sparse = np.repeat(np.arange(len(keys)), n)
    bits = np.unpackbits(np.frombuffer(row["dense"], np.uint8).reshape(-1, max(full, 1)), axis=1, count=n_docs)
    at, place = np.nonzero(bits)
    weights = np.int64(1) << np.frombuffer(row["planes"], np.uint8).astype(np.int64)
    return keys, weights, np.concatenate([of_sparse, np.flatnonzero(is_full)[at]]), \
        np.concatenate([np.frombuffer(row["sparse"], "<u2").astype(np.int64), place])


def inverted(docs: DataFrame, tokenizer_file: str, model_file: str) -> DataFrame:
    """One row per block of ``doc_id``, ``text``: its documents with their numbers, and its bitmaps."""
    sent = docs.sparkSession.sparkContext.broadcast((Path(tokenizer_file).read_text(), Path(model_file).read_bytes()))
    names = [c.split()[0] for c in _BLOCK.split(", ")]
    kinds = [pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.string()), pa.int32(), *[pa.binary()] * 5]

    def block(name: int, rows: list[tuple], postings: list[tuple]) -> pa.RecordBatch:
        ids, numbers, digests = zip(*rows)
        n_docs = sum(map(len, ids))
        found = _merged(*(np.concatenate([np.zeros(0, np.int64), *x]) for x in (zip(*postings) if postings else ([], []))))
        row = [name, [i for x in ids for i in x.to_pylist()], np.concatenate(numbers).tobytes(),
               [d for x in digests for d in x], n_docs, *bitmaps(*found, n_docs)]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(*sent.value)
        name, rows, postings, n_docs, n_links = TaskContext.get().partitionId() << 32, [], [], 0, 0
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK_DOCS):
                batch = whole.slice(at, BLOCK_DOCS)
                if n_docs and (n_docs + batch.num_rows > BLOCK_DOCS or n_links >= BLOCK_LINKS):
                    yield block(name, rows, postings)
                    name, rows, postings, n_docs, n_links = name + 1, [], [], 0, 0
                numbers = align_texts(batch.column("text"), aligner)
                postings += posting_counts(numbers, n_docs)
                rows.append((batch.column("doc_id"), numbers.counts, numbers.digests))
                n_docs, n_links = n_docs + batch.num_rows, n_links + int(numbers.counts[:, 3].sum())
        if rows:
            yield block(name, rows, postings)
    return docs.mapInArrow(work, _BLOCK)


# ---- counts and scores ----------------------------------------------------------------------

def block_counts(blocks: DataFrame) -> DataFrame:
    """``block``, ``pair``, ``n_docs``, ``n_links``: bits of the OR of a pair's planes, and of its planes by weight."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, weights, of, place = read_bitmaps(row)
                links = np.bincount(of, minlength=len(keys)) * weights
                pairs, at = np.unique(keys, return_inverse=True)
                n_links = np.zeros(len(pairs), np.int64)
                np.add.at(n_links, at, links)
                either = np.unique(at[of] << 16 | place) >> 16
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array(np.full(len(pairs), row["block"])), "pair": pa.array(pairs),
                    "n_docs": pa.array(np.bincount(either, minlength=len(pairs)).astype(np.int64)),
                    "n_links": pa.array(n_links)})
    return blocks.select("block", *[c.split()[0] for c in _BITS.split(", ")]) \
        .mapInArrow(work, "block long, pair long, n_docs long, n_links long")


def pair_counts(counted: DataFrame, n_pieces: int) -> DataFrame:
    """``pair``, ``a_id``, ``b_id``, ``n_docs``, ``n_links`` and ``best``: no pair of the B id has more links.

    The table of best counts has a row for each piece of the model at most, so it is broadcast.
    """
    counts = counted.groupBy("pair").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_links").alias("n_links"))
    counts = counts.select("pair", F.floor(F.col("pair") / n_pieces).cast("int").alias("a_id"),
                           (F.col("pair") % n_pieces).cast("int").alias("b_id"), "n_docs", "n_links")
    most = counts.groupBy("b_id").agg(F.max("n_links").alias("most"))
    return counts.join(F.broadcast(most), "b_id").select(
        "pair", "a_id", "b_id", "n_docs", "n_links", (F.col("n_links") == F.col("most")).alias("best"))


def scored_documents(blocks: DataFrame, counted: DataFrame, pairs: DataFrame) -> DataFrame:
    """Per document its numbers and, over its links, ``n_best``, ``count_sum`` and ``n_lone``.

    ``n_lone`` counts links of pairs that no other document has.
    """
    scores = counted.select("block", "pair").join(pairs.select("pair", "n_docs", "n_links", "best"), "pair")
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, " \
             "groups_sha256 string, n_lone long"

    def work(block: pa.Table, found: pa.Table) -> pa.Table:
        row = block.to_pylist()[0]
        keys, weights, of, place = read_bitmaps(row)
        order = np.argsort(found.column("pair").to_numpy())
        at = np.searchsorted(found.column("pair").to_numpy()[order], keys)
        sums = []
        for value in (found.column("best").to_numpy(), found.column("n_links").to_numpy(),
                      found.column("n_docs").to_numpy() == 1):
            one = np.zeros(row["n_docs"], np.int64)
            if len(keys):
                np.add.at(one, place, (value[order][at].astype(np.int64) * weights)[of])
            sums.append(one)
        numbers = np.frombuffer(row["numbers"], "<i8").reshape(-1, 4)
        columns = [pa.array(row["doc_ids"], pa.int64()), *[pa.array(numbers[:, i]) for i in range(4)],
                   pa.array(sums[0]), pa.array(sums[1]), pa.array(row["digests"], pa.string()), pa.array(sums[2])]
        return pa.Table.from_arrays(columns, [c.split()[0] for c in schema.split(", ")])
    return blocks.groupBy("block").cogroup(scores.groupBy("block")).applyInArrow(work, schema)


def aligned_documents(docs: DataFrame, tokenizer_file: str, model_file: str) -> DataFrame:
    """Per row ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``,

    ``groups_sha256`` and ``n_lone``. Null and empty texts, and those whose bytes a tokenizer changes
    (a U+2581 in the text is a blank to the model of pieces), have zeros and no digest. Repeated rows
    count as often as they are there; an empty table gives none; other columns are not read.
    """
    import sentencepiece

    n_pieces = sentencepiece.SentencePieceProcessor(model_file=model_file).get_piece_size()
    blocks = kept(inverted(texts(docs), tokenizer_file, model_file), "blocks")
    counted = kept(block_counts(blocks), "block-counts")
    return scored_documents(blocks, counted, kept(pair_counts(counted, n_pieces), "pairs"))
