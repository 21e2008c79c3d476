r"""Ranked search by MaxScore with bounds of term pairs.

Terms are runs of ASCII letters and digits and of all characters beyond ASCII; A-Z count as a-z.

``index`` stores one row for each block of about a million terms: the block's documents and, for every
term in it, the documents that hold it and how often. ``with_impacts`` keeps of each block the lists of
the searched terms, with what each term adds to a document's score (its impact), and intersects the
lists of chosen pairs of terms; of an intersection it stores the number of documents, their largest joint
impact and the k-th largest so far.

``search`` walks the blocks. What a block's best document can score is bounded by a sum over disjoint
units: pairs, by the larger of the joint maximum and the two own maxima, and single terms, by their
maxima. A pair's bound is never above the sum of its two maxima, and far below it where no document
holds both; pairs are matched greedily by what they save. Units whose bounds together stay below the
score to beat only add to documents that other units bring in, largest bound first, and documents that
cannot get there any more are left out before each of them. The score to beat is the k-th best so far
of the task, at first the k-th largest joint impact of a pair of the item that any task has met: so
many documents are known to reach it. Documents are left out only if they stay below it, so ties are
kept and the result is that of scoring everything.

Items are searched ``ITEMS`` at a time, as what is sent to the tasks are their terms. The best k of a
task and item meet in windows that Spark limits to k rows before it shuffles; at first each item's rows
are dealt into ``SHARES`` groups, so that no task gets a row from every task.

A document without an id counts in the statistics but is not returned. Null texts have no terms, null
or empty items no results; repeated rows of documents or items each stand for themselves. An empty
table has no results. Columns other than those named are not read.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations, pairwise

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from ratelens.llm.tables import kept, texts
from ratelens.llm.words import Words, words_of

BLOCK_TOKENS = 1_000_000
ITEMS = 1000                    # searched in one walk over the index
ITEM_TERMS = 1_000_000          # or as many as have so many terms, or one item
SHARES = 64
RAREST, LONGEST = 5, 3          # terms of an item that all pair with each other
_BETWEEN = np.ones(256, bool)
_BETWEEN[[b for b in range(256) if b >= 0x80 or chr(b).isalnum()]] = False
_NO_ID = -(1 << 63)
_INDEX = "block long, ids binary, lengths binary, terms binary, starts binary, docs binary, tfs binary"
_LISTS = "block long, ids binary, terms binary, starts binary, docs binary, parts binary, pairs binary, " \
         "joint_docs binary, joint_tops binary, joint_kths binary"


def term_words(column: pa.Array) -> Iterator[Words]:
    """The terms of texts."""
    return words_of(column, _BETWEEN)


def _row(schema: str, *values: object) -> pa.RecordBatch:
    names = [c.split()[0] for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([v], pa.int64()) if isinstance(v, int) else pa.array([v.tobytes()], pa.binary()) for v in values],
        names)


def _array(row: dict, name: str, kind: str = "<i8") -> np.ndarray:
    return np.frombuffer(row[name], kind)


# ---- index ----------------------------------------------------------------------------------

def index(docs: DataFrame) -> DataFrame:
    """One row per block of ``doc_id``, ``text``; lists are ascending places among the block's documents.

    ``terms`` are sorted 64-bit hashes; the list of term i is ``starts[i]:starts[i + 1]`` of ``docs`` and
    ``tfs``. ``ids`` and ``lengths`` have an entry for each document.
    """
    def block(name: int, parts: list[tuple]) -> pa.RecordBatch:
        ids, lengths, hashes = (np.concatenate(x) for x in zip(*parts))
        terms, code = np.unique(hashes, return_inverse=True)
        code = code.astype(np.int64) * len(ids) + np.repeat(np.arange(len(ids)), lengths)
        held, tfs = np.unique(code, return_counts=True)
        starts = np.searchsorted(held, np.arange(len(terms) + 1) * len(ids))
        return _row(_INDEX, name, ids, lengths.astype("<i8"), terms.view("<i8"), starts.astype("<i8"),
                    (held % len(ids)).astype("<u4"), tfs.astype("<u4"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, parts, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            ids = batch.column("doc_id").fill_null(_NO_ID).to_numpy()
            for words in term_words(batch.column("text")):
                parts.append((ids[words.rows], np.diff(words.first), words.hashes()))
                size += len(words.begin)
                if size >= BLOCK_TOKENS:
                    yield block(name, parts)
                    name, parts, size = name + 1, [], 0
        if parts:
            yield block(name, parts)
    return docs.mapInArrow(work, _INDEX)


def statistics(indexed: DataFrame, terms: np.ndarray) -> tuple[int, int, dict[int, int]]:
    """Documents with a term, all terms with repeats, and how many documents hold each of ``terms``."""
    sent = indexed.sparkSession.sparkContext.broadcast(np.sort(terms))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_docs, n_terms, dfs = 0, 0, np.zeros(len(sent.value), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                lengths = _array(row, "lengths")
                n_docs, n_terms = n_docs + int((lengths > 0).sum()), n_terms + int(lengths.sum())
                at, place = _found(_array(row, "terms", "<u8"), sent.value)
                dfs[at] += np.diff(_array(row, "starts"))[place]
        some = np.flatnonzero(dfs)
        yield pa.RecordBatch.from_pydict({
            "term": pa.concat_arrays([pa.nulls(1, pa.int64()), pa.array(sent.value[some].view(np.int64))]),
            "n": pa.array(np.append([n_docs], dfs[some])), "l": pa.array(np.append([n_terms], 0 * some))})
    found = indexed.select("lengths", "terms", "starts").mapInArrow(work, "term long, n long, l long") \
        .groupBy("term").agg(F.sum("n").alias("n"), F.sum("l").alias("l")).collect()
    every = next(((r["n"], r["l"]) for r in found if r["term"] is None), (0, 0))
    sent.destroy()
    return *every, {r["term"] & (1 << 64) - 1: r["n"] for r in found if r["term"] is not None}


def _found(terms: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the sorted ``wanted`` are among the sorted ``terms``, and where."""
    if not len(terms):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    place = np.minimum(np.searchsorted(terms, wanted), len(terms) - 1)
    at = np.flatnonzero(terms[place] == wanted)
    return at, place[at]


# ---- items and impacts ------------------------------------------------------------------------

@dataclass
class Item:
    """An item's distinct terms with repeats, the pairs of them with lists, and a score that k documents reach."""

    id: int | None
    times: dict[int, int]
    pairs: list[tuple[int, int]] = field(default_factory=list)
    floor: int = 0


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> Iterator[list[Item]]:
    """The items, at most ``ITEMS`` or ``ITEM_TERMS`` terms of them at a time, fetched partition by partition."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in term_words(batch.column("text")):
                hashes = words.hashes().view(np.int64)
                yield pa.RecordBatch.from_pydict({
                    "id": batch.column("doc_id")[words.rows],
                    "terms": pa.ListArray.from_arrays(pa.array(words.first.astype(np.int32)), pa.array(hashes))})
    found, size = [], 0
    for row in texts(items, id_col, text_col).mapInArrow(work, "id long, terms array<long>").toLocalIterator():
        found.append(Item(row["id"], Counter(t & (1 << 64) - 1 for t in row["terms"])))
        size += len(found[-1].times)
        if len(found) >= ITEMS or size >= ITEM_TERMS:
            yield found
            found, size = [], 0
    if found:
        yield found


def item_pairs(terms: list[int], dfs: dict[int, int]) -> list[tuple[int, int]]:
    """Pairs to intersect: of the rarest and the most frequent terms all, of the others neighbours by rarity.

    Any choice gives the same results; a pair without a list is bounded by its two maxima.
    """
    order = sorted((t for t in terms if t in dfs), key=lambda t: (dfs[t], t))
    ends = order if len(order) <= RAREST + LONGEST else order[:RAREST] + order[-LONGEST:]
    return sorted({(min(p), max(p)) for p in [*combinations(ends, 2), *pairwise(order)]})


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def saturation(tfs: np.ndarray, lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """The part of an impact that depends on the document, to be multiplied by the term's weight."""
    m = 75 + (25 * lengths * n_docs) // n_terms
    return (1_000_000_000 * tfs) // (1000 * tfs + 12 * m)


@dataclass
class Block:
    """A block's documents, the lists of the searched terms, and what is stored of pairs."""

    ids: np.ndarray
    docs: dict[int, np.ndarray]
    gains: dict[int, np.ndarray]
    tops: dict[int, int]

    @staticmethod
    def of(weights: dict[int, int], ids: np.ndarray, terms: np.ndarray, starts: np.ndarray,
           docs: np.ndarray, parts: np.ndarray) -> Block:
        docs, parts = docs.astype(np.int64), parts.astype(np.int64)
        bounds = [x for x in zip(terms.tolist(), starts.tolist(), starts[1:].tolist()) if x[1] < x[2]]
        gains = {t: parts[a:b] * weights[t] for t, a, b in bounds}
        return Block(ids, {t: docs[a:b] for t, a, b in bounds}, gains, {t: int(g.max()) for t, g in gains.items()})


def joint_impacts(block: Block, a: int, b: int) -> np.ndarray:
    """Sums of both impacts, of the documents that hold both terms."""
    if len(block.docs[a]) > len(block.docs[b]):
        a, b = b, a
    at, place = _found(block.docs[b], block.docs[a])
    return block.gains[a][at] + block.gains[b][place]


def with_impacts(indexed: DataFrame, sent: Broadcast, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """Of each block the lists of the searched terms and what is stored of their pairs.

    ``sent`` holds the terms' weights and the pairs, both for a bounded number of items. ``parts`` are the saturations of the lists' documents. ``pairs`` are numbers of pairs that some
    document of the block holds, with its documents (``joint_docs``), their largest joint impact
    (``joint_tops``) and the k-th largest that the task has met so far (``joint_kths``, or 0).
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, chosen = sent.value
        wanted = np.sort(np.array(list(weight), np.uint64))
        best: dict[int, np.ndarray] = {}
        for batch in batches:
            for row in batch.to_pylist():
                ids, starts = _array(row, "ids"), _array(row, "starts")
                at, place = _found(_array(row, "terms", "<u8"), wanted)
                sizes = starts[place + 1] - starts[place]
                take = np.arange(sizes.sum()) + np.repeat(starts[place] - np.cumsum(sizes) + sizes, sizes)
                docs = _array(row, "docs", "<u4")[take]
                good = ids[docs] != _NO_ID
                docs, of = docs[good], np.repeat(np.arange(len(at)), sizes)[good]
                part = saturation(_array(row, "tfs", "<u4")[take][good].astype(np.int64),
                                  _array(row, "lengths")[docs], n_docs, n_terms)
                bounds = np.searchsorted(of, np.arange(len(at) + 1)).astype("<i8")
                lists = [ids, wanted[at], bounds, docs, part.astype("<u4")]
                block, met = Block.of(weight, *lists), []
                for number, (a, b) in enumerate(chosen):
                    if a in block.docs and b in block.docs and len(both := joint_impacts(block, a, b)):
                        top, n = int(both.max()), len(both)
                        if number in best:
                            both = np.concatenate([best[number], both])
                        best[number] = both if len(both) <= k else np.partition(both, len(both) - k)[-k:]
                        met.append((number, n, top, int(best[number].min()) if len(best[number]) == k else 0))
                yield _row(_LISTS, row["block"], *lists, *np.array(met, "<i8").reshape(-1, 4).T.copy())
    return indexed.mapInArrow(work, _LISTS)


def pair_floors(lists: DataFrame) -> dict[int, int]:
    """For each pair's number a joint impact that k documents reach, where there are so many."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[int, int] = {}
        for batch in batches:
            for row in batch.to_pylist():
                for pair, kth in zip(_array(row, "pairs").tolist(), _array(row, "joint_kths").tolist()):
                    least[pair] = max(kth, least.get(pair, 0))
        yield pa.RecordBatch.from_pydict({"pair": pa.array(list(least), pa.int64()),
                                          "floor": pa.array(list(least.values()), pa.int64())})
    found = lists.select("pairs", "joint_kths").mapInArrow(work, "pair long, floor long") \
        .groupBy("pair").agg(F.max("floor").alias("floor")).collect()
    return {r["pair"]: r["floor"] for r in found}


# ---- search ---------------------------------------------------------------------------------

Unit = tuple[int, tuple[int, ...]]      # bound and terms


def units_of(item: Item, tops: dict[int, int], joint: dict[tuple[int, int], int]) -> list[Unit]:
    """Disjoint units of the item's terms, smallest bound first.

    A joint impact counts each term once, so only terms that the item has once form pairs; a pair
    with a list that is not in ``joint`` has no document here.
    """
    gain = {t: tops[t] * n for t, n in item.times.items() if t in tops}
    saved = []
    for a, b in item.pairs:
        if a in gain and b in gain and item.times[a] == item.times[b] == 1:
            bound = max(joint.get((a, b), 0), gain[a], gain[b])
            if bound < gain[a] + gain[b]:
                saved.append((gain[a] + gain[b] - bound, bound, (a, b)))
    units, paired = [], set()
    for _, bound, pair in sorted(saved, reverse=True):
        if paired.isdisjoint(pair):
            units.append((bound, pair))
            paired.update(pair)
    return sorted(units + [(g, (t,)) for t, g in gain.items() if t not in paired])


def best_of_block(block: Block, item: Item, units: list[Unit], k: int, least: int) -> list[tuple[int, int]]:
    """(score, -doc_id) of the block's documents that may be among the k best: ``least`` or more, above 0."""
    least = max(least, 1)
    bounds = np.cumsum([0] + [b for b, _ in units])            # bounds[i]: of the first i units
    if bounds[-1] < least:
        return []
    essential = int(np.searchsorted(bounds[1:], least, "left"))
    scores = np.zeros(len(block.ids), np.int64)
    for _, terms in units[essential:]:
        for t in terms:
            scores[block.docs[t]] += block.gains[t] * item.times[t]
    alive = np.flatnonzero(scores)
    for i in range(essential - 1, -1, -1):
        alive = alive[scores[alive] + bounds[i + 1] >= least]
        for t in units[i][1]:
            at, place = _found(block.docs[t], alive)
            scores[alive[at]] += block.gains[t][place] * item.times[t]
    alive = alive[scores[alive] >= least]
    if len(alive) > k:
        alive = alive[np.lexsort((block.ids[alive], -scores[alive]))[:k]]
    return list(zip(scores[alive].tolist(), (-block.ids[alive]).tolist()))


def _searched(lists: DataFrame, asked: Broadcast, sent: Broadcast, k: int) -> DataFrame:
    """``number`` (of the item), ``item_id``, ``score``, ``doc_id``: the k best of each item in each task."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every, (weight, chosen) = asked.value, sent.value
        best: list[list[tuple[int, int]]] = [[] for _ in every]        # heaps, the worst first
        for batch in batches:
            for row in batch.to_pylist():
                block = Block.of(weight, _array(row, "ids"), _array(row, "terms", "<u8"), _array(row, "starts"),
                                 _array(row, "docs", "<u4"), _array(row, "parts", "<u4"))
                joint = {chosen[n]: top for n, top in zip(_array(row, "pairs").tolist(),
                                                          _array(row, "joint_tops").tolist())}
                for item, heap in zip(every, best):
                    least = max(item.floor, heap[0][0] if len(heap) == k else 0)
                    units = units_of(item, block.tops, joint)
                    for one in best_of_block(block, item, units, k, least) if units else ():
                        if len(heap) < k:
                            heapq.heappush(heap, one)
                        elif one > heap[0]:
                            heapq.heapreplace(heap, one)
        rows = [(n, item.id, score, -back) for n, (item, heap) in enumerate(zip(every, best)) for score, back in heap]
        names = ["number", "item_id", "score", "doc_id"]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * 4)], names)
    return lists.mapInArrow(work, "number long, item_id long, score long, doc_id long")


def search(indexed: DataFrame, items: DataFrame, k: int = 20, id_col: str = "item_id",
           text_col: str = "text") -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score`` of each item's k best documents with a score above 0.

    ``indexed`` is a stored ``index``. The results of ``ITEMS`` items are stored before the next.
    """
    found = None
    for some in item_terms(items, id_col, text_col):
        terms = np.array(sorted({t for item in some for t in item.times}), np.uint64)
        n_docs, n_terms, dfs = statistics(indexed, terms)
        weights = {t: w for t, df in dfs.items() if (w := term_weight(n_docs, df)) > 0}
        for item in some:
            item.pairs = item_pairs([t for t in item.times if t in weights], dfs)
        pairs = sorted({p for item in some for p in item.pairs})
        context = indexed.sparkSession.sparkContext
        sent = context.broadcast((weights, pairs))
        lists = kept(with_impacts(indexed, sent, n_docs, max(n_terms, 1), k), "lists")
        floors = pair_floors(lists)
        floor_of = {pairs[number]: floor for number, floor in floors.items()}
        for item in some:
            item.floor = max((floor_of.get(p, 0) for p in item.pairs), default=0)
        asked = context.broadcast(some)
        best = _searched(lists, asked, sent, k)
        order = [F.desc("score"), F.asc("doc_id")]
        share = F.pmod(F.xxhash64("doc_id"), F.lit(SHARES))
        for own in (Window.partitionBy("number", share), Window.partitionBy("number")):
            best = best.withColumn("rank", F.row_number().over(own.orderBy(*order))).where(F.col("rank") <= k)
        best = kept(best.select("item_id", "rank", "doc_id", "score"), "ranked")
        asked.destroy()
        sent.destroy()
        found = best if found is None else found.unionAll(best)
    if found is None:
        empty = "item_id long, rank int, doc_id long, score long"
        return indexed.sparkSession.createDataFrame([], empty)
    return found


def ranked_documents(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """``docs`` indexed and searched for each row of ``items`` (``item_id``, ``text``)."""
    return search(kept(index(texts(docs)), "index"), items, k)
