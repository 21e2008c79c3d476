"""Benchmark decontamination by latent semantic retrieval and checks of what it finds.

Terms are words, hashed to ``TERMS`` places and weighted by their inverse document frequency over
all documents. The benchmark's items are taken in blocks; for each block a randomised SVD of its
TF-IDF rows, block by block on the executors, gives the latent space, and the rank is large enough
to tell all items of a block apart. A document's passages start at each of its words; they have the
length that the words of an item need which make a leak by themselves, or some words less. A passage is projected into
the space and compared with the items of its length; the cosine divides by the length of the whole
TF-IDF row, so words that no item has count against it. As some passage has next to no other words
around an item, or around the part of it that was copied, this also finds an item that many documents
hold, whose words weigh little beside their neighbours.

No passage has a larger cosine than with the largest weight that any item of its length has for each
of its terms; that bound is computed for all passages by running sums. Of those that meet it and start
within a quarter of their length the one with the highest bound is projected. Candidates are checked around the passage found: the longest common subsequence with the
item's words must hold most of the item, or a smaller part of it together with the item's answer,
which are its last words. Of passages that overlap by most of their words the nearest one is checked.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ratelens.llm.tables import texts
from ratelens.llm.words import Words, trimmed, words_of

TERMS = 1 << 18
BLOCK_ITEMS = 256               # items of one latent space, and its rank
PASS_BLOCKS = 16                # spaces that are sent out at once; more take another pass
GRID = 4                        # lengths of passages are whole times it, so that there are few
COSINE = 0.45
SURE, LIKELY, ANSWER = 0.65, 0.45, 0.75     # shares of the item and of its answer in common
ANSWER_PART = 5                 # the answer is the last 1/5 of an item, three words at least


def _lower_words(column: pa.Array) -> Iterator[Words]:
    """Words with all letters, not only A-Z, in lower case."""
    return words_of(pc.utf8_lower(column.cast(pa.large_string())))


def _terms(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and its place among the terms."""
    hashes = trimmed(words).hashes()
    return hashes, (hashes >> np.uint64(64 - 18)).astype(np.int64)


def term_weights(docs: DataFrame) -> np.ndarray:
    """The weight of each place, from the number of documents with a term there.

    A task gives one row for each place that occurs in its documents; the result has ``TERMS`` rows.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(TERMS, np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            for words in _lower_words(batch.column("text")):
                _, term = _terms(words)
                row = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
                each = np.unique(row * TERMS + term) % TERMS
                total += np.bincount(each, minlength=TERMS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1)), pa.array(np.append(total[at], rows))], ["term", "rows"])
    counts = docs.select("text").mapInArrow(work, "term long, rows long") \
        .groupBy("term").agg(F.sum("rows").alias("rows")).toPandas()
    total = int(counts.loc[counts["term"] < 0, "rows"].sum())
    often = np.zeros(TERMS)
    seen = counts[counts["term"] >= 0]
    often[seen["term"].to_numpy(np.int64)] = seen["rows"].to_numpy(float)
    return np.log((total + 1) / (often + 0.5)).clip(0.01).astype(np.float32)


@dataclass
class Item:
    item_id: int | None
    words: list[int]            # hashes, in order
    length: int                 # of the passages it is compared with, in words


@dataclass
class Space:
    """Items of a block in the latent space: cosine = projected passage . item / its length."""

    items: list[Item]
    terms: np.ndarray           # places with a term of some item, sorted
    axes: np.ndarray            # term x rank
    at: np.ndarray              # item x rank, of length 1 before the projection
    most: dict[int, np.ndarray]  # by passage length: the largest weight of an item for each term


def randomised_svd(rows: np.ndarray, rank: int, seed: int) -> np.ndarray:
    """The right singular vectors (column x rank) of the largest singular values."""
    rng = np.random.default_rng(seed)
    rank = min(rank, *rows.shape)
    more = min(rank + 16, *rows.shape)
    basis = np.linalg.qr(rows @ rng.standard_normal((rows.shape[1], more)).astype(rows.dtype))[0]
    for _ in range(2):
        basis = np.linalg.qr(rows.T @ basis)[0]
        basis = np.linalg.qr(rows @ basis)[0]
    return np.linalg.svd(basis.T @ rows, full_matrices=False)[2][:rank].T


def _space(item_ids: list, texts_: pa.Array, weight: np.ndarray, seed: int) -> Space | None:
    items, rows, cells = [], [], []
    for words in _lower_words(texts_):
        hashes, term = _terms(words)
        for i, row in enumerate(range(words.rows.start, words.rows.stop)):
            a, b = words.first[i], words.first[i + 1]
            if b > a:
                length = max(1, int(np.ceil(SURE * (b - a) - 1e-9)))
                length -= length % GRID if length > GRID else 0
                rows.append(np.full(b - a, len(items)))
                cells.append(term[a:b])
                items.append(Item(item_ids[row], hashes[a:b].tolist(), length))
    if not items:
        return None
    terms, column = np.unique(np.concatenate(cells), return_inverse=True)
    table = np.zeros((len(items), len(terms)), np.float32)
    np.add.at(table, (np.concatenate(rows), column), weight[np.concatenate(cells)])
    axes = randomised_svd(table, BLOCK_ITEMS, seed)
    at = table @ axes / np.linalg.norm(table, axis=1, keepdims=True)
    lengths = np.array([i.length for i in items])
    most = {int(n): (at[lengths == n] @ axes.T).max(axis=0).clip(0) for n in np.unique(lengths)}
    return Space(items, terms, axes.astype(np.float32), at.astype(np.float32), most)


def latent_spaces(benchmark: DataFrame, weight: np.ndarray, id_col: str, text_col: str) -> Iterator[list[Space]]:
    """The spaces of all items, ``PASS_BLOCKS`` at a time. Items without a word match nothing."""
    sent = benchmark.sparkSession.sparkContext.broadcast(weight)
    items = benchmark.select(F.col(f"`{id_col}`").cast("long").alias("item_id"),
                             F.col(f"`{text_col}`").cast("string").alias("text")).where("text is not null")
    n = items.count()
    # Dealt out by hash, to three quarters of a block each; the few larger parts make two spaces.
    parts = 1 if n <= BLOCK_ITEMS else -(-n // (BLOCK_ITEMS * 3 // 4))
    items = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)).cast("int"))

    def work(batch: pa.Table) -> pa.Table:
        batch = batch.sort_by([("item_id", "ascending"), ("text", "ascending")]).combine_chunks()
        name = batch.column("block")[0].as_py()
        spaces = []
        for start in range(0, batch.num_rows, BLOCK_ITEMS):
            part = batch.slice(start, BLOCK_ITEMS)
            space = _space(part.column("item_id").to_pylist(), part.column("text").combine_chunks(),
                           sent.value, name)
            if space:
                spaces.append(pickle.dumps(space))
        return pa.table({"block": pa.array([name] * len(spaces), pa.int32()),
                         "space": pa.array(spaces, pa.binary())})
    for first in range(0, parts, PASS_BLOCKS):
        some = items.where((F.col("block") >= first) & (F.col("block") < first + PASS_BLOCKS))
        made = some.groupBy("block").applyInArrow(work, "block int, space binary").collect()
        yield [pickle.loads(r["space"]) for r in sorted(made, key=lambda r: r["block"])]


# ---- checks ---------------------------------------------------------------------------------

def common_words(item: list[int], other: list[int]) -> int:
    """Length of the longest common subsequence, with the item's places as bits of one number."""
    places: dict[int, int] = {}
    for i, word in enumerate(item):
        places[word] = places.get(word, 0) | 1 << i
    full = free = (1 << len(item)) - 1
    for word in other:
        hit = free & places.get(word, 0)
        if hit:
            free = (free + hit | free - hit) & full
    return len(item) - free.bit_count()


def judged(item: Item, around: list[int]) -> tuple[float, float, bool]:
    """Share of the item and of its answer in the words around a passage, and whether it is a leak."""
    share = common_words(item.words, around) / len(item.words)
    last = item.words[-max(3, len(item.words) // ANSWER_PART):]
    answer = common_words(last, around) / len(last)
    return share, answer, share >= SURE or share >= LIKELY and answer >= ANSWER


# ---- search ---------------------------------------------------------------------------------

def _promising(reach: np.ndarray, heavy: np.ndarray, first: np.ndarray, ends: np.ndarray, length: int) \
        -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and squared bound of the cosine of passages that meet it; a shorter row is one passage."""
    n = max(len(ends) - length + 1, 0)
    most, norm = reach[length:] - reach[:n], heavy[length:] - heavy[:n]
    begin = np.flatnonzero((most * most >= (COSINE * COSINE - 1e-9) * norm) & (most > 0))
    begin = begin[begin + length <= ends[begin]]
    short = np.flatnonzero((np.diff(first) < length) & (np.diff(first) > 0))
    starts, stops = first[short], first[short + 1]
    most_short, norm_short = reach[stops] - reach[starts], heavy[stops] - heavy[starts]
    good = (most_short * most_short >= (COSINE * COSINE - 1e-9) * norm_short) & (most_short > 0)
    ratio = np.concatenate([most[begin] ** 2 / norm[begin], most_short[good] ** 2 / norm_short[good]])
    return np.append(begin, starts[good]), np.append(begin + length, stops[good]), ratio


def _highest(row: np.ndarray, start: np.ndarray, begin: np.ndarray, end: np.ndarray, ratio: np.ndarray,
             step: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the passages that start within ``step`` words, counted from their row's start, the highest one."""
    cell = (begin - start) // step
    order = np.lexsort((begin, -ratio, cell, row))
    cell, row = cell[order], row[order]
    first = np.ones(len(order), bool)
    first[1:] = (np.diff(cell) != 0) | (np.diff(row) != 0)
    return begin[order][first], end[order][first]


def _near(words: Words, term: np.ndarray, own: np.ndarray, weight: np.ndarray, space: Space) \
        -> Iterator[tuple[int, int, float, int]]:
    """(row, item, cosine, begin) of all passages with a cosine of ``COSINE`` or more."""
    number = np.full(TERMS, len(space.terms), np.int32)
    number[space.terms] = np.arange(len(space.terms))
    listed = number[term]                                            # one more than the last: no item's
    known, place = listed < len(space.terms), np.minimum(listed, len(space.terms) - 1)
    heavy = np.concatenate([[0.0], np.cumsum(own * own)])
    sizes = np.diff(words.first)
    row_of = np.repeat(np.arange(len(sizes)), sizes)
    ends = words.first[1:][row_of]                                   # where the row of each word ends
    lengths = np.array([i.length for i in space.items])
    for length, most in space.most.items():
        each = np.append(most * weight[space.terms], 0.0)            # the most that a word adds
        reach = np.concatenate([[0.0], np.cumsum(each[listed])])
        begin, end, ratio = _promising(reach, heavy, words.first, ends, length)
        row = row_of[begin]
        begin, end = _highest(row, words.first[row], begin, end, ratio, max(1, length // 4))
        items = np.flatnonzero(lengths == length)
        for low in range(0, len(begin), 512):
            b, e = begin[low:low + 512], end[low:low + 512]
            size = e - b
            of = np.repeat(np.arange(len(b)), size)
            token = np.repeat(b - (np.cumsum(size) - size), size) + np.arange(len(of))
            # A term that a passage has n times weighs n times.
            cell, times = np.unique(of * TERMS + term[token], return_counts=True)
            whole = np.bincount(cell // TERMS, weights=(times * weight[cell % TERMS]) ** 2)
            token, of = token[known[token]], of[known[token]]
            # A passage has few known terms, so their axes are summed rather than its row multiplied.
            latent = np.zeros((len(b), space.axes.shape[1]), np.float32)
            starts = np.flatnonzero(np.diff(of, prepend=-1))
            latent[of[starts]] = np.add.reduceat(
                space.axes[place[token]] * own[token, None].astype(np.float32), starts, axis=0)
            cosine = latent @ space.at[items].T / np.sqrt(whole)[:, None]
            for i, j in zip(*np.nonzero(cosine >= COSINE)):
                yield int(row_of[b[i]]), int(items[j]), float(cosine[i, j]), int(b[i])


def _found(words: Words, weight: np.ndarray, spaces: list[Space]) -> list[list[dict]]:
    """The leaks in each row of a chunk."""
    out: list[list[dict]] = [[] for _ in range(len(words.first) - 1)]
    if not len(words.begin):
        return out
    hashes, term = _terms(words)
    own = weight[term].astype(np.float64)
    for space in spaces:
        best: dict[tuple[int, int], list[tuple[float, int]]] = {}
        for row, item, cosine, begin in _near(words, term, own, weight, space):
            best.setdefault((row, item), []).append((cosine, begin))
        for (row, j), places in sorted(best.items()):
            item, tried = space.items[j], []
            n = len(item.words)
            for cosine, begin in sorted(places, key=lambda p: (-p[0], p[1])):
                if any(abs(begin - t) <= item.length // 4 for t in tried):
                    continue
                tried.append(begin)
                a, z = max(words.first[row], begin - n), min(words.first[row + 1], begin + item.length + n)
                share, answer, leak = judged(item, hashes[a:z].tolist())
                if leak:
                    out[row].append({"item_id": item.item_id, "cosine": round(cosine, 6),
                                     "common": round(share, 6), "answer": round(answer, 6)})
                    break
    return out


_LEAK = pa.struct([("item_id", pa.int64()), ("cosine", pa.float64()), ("common", pa.float64()),
                   ("answer", pa.float64())])


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """``doc_id``, ``item_id``, ``cosine``, ``common``, ``answer``: one row for each leak in a row.

    Null and empty texts leak nothing, null and empty items leak nowhere. Repeated rows and items give
    repeated results, with ids null or not. An empty table on either side gives an empty result.
    """
    docs = texts(docs, id_col, text_col)
    weight = term_weights(docs)
    out = None
    for spaces in latent_spaces(benchmark, weight, item_col, item_text):
        sent = docs.sparkSession.sparkContext.broadcast((weight, spaces))

        def work(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for words in _lower_words(batch.column("text")):
                    found = _found(words, *sent.value)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id")[words.rows], pa.array(found, pa.list_(_LEAK))],
                        ["doc_id", "leaks"])
        some = docs.mapInArrow(work, "doc_id long, leaks array<struct<item_id: long, cosine: double, "
                                     "common: double, answer: double>>") \
            .select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")
        out = some if out is None else out.unionByName(some)
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns."""
    at = docs.schema.fieldNames().index(text_col)
    weight = term_weights(docs.select(F.col(f"`{text_col}`").cast("string").alias("text")))
    for spaces in latent_spaces(benchmark, weight, item_col, item_text):
        sent = docs.sparkSession.sparkContext.broadcast((weight, spaces))

        def work(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = [not x for words in _lower_words(batch.column(at)) for x in _found(words, *sent.value)]
                yield batch.filter(pa.array(clean, pa.bool_()))
        docs = docs.mapInArrow(work, docs.schema)
    return docs
