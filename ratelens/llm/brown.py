r"""Scoring with a class-based bigram model (Brown classes found by exchange).

Texts are read once into blocks: the distinct words of about a million tokens, as hashes with
their last bytes, and each token as a number among them. All else works on blocks.

Exchange clustering moves words between classes while the likelihood of the class bigrams grows, in
two steps. First units move on the driver: a word that makes up at least ``UNIT_SHARE`` of the tokens
by itself; rarer words together with those of the same ending, the longest ending of up to three
bytes that is frequent enough. So there is a bounded number of units, whatever the corpus, and their
bigrams are counted over all training tokens. Which are units is counted exactly: what has the share
in all tokens has it in a block at least, so these candidates alone are counted in all. Then every
other word with a training token, however rare, moves by itself, from the class of its ending to the
one where its own neighbours raise the likelihood most: a shuffle sums the classes before and after
it over the corpus, and words move against the class bigrams of the first step, as in the distributed
exchange of Uszkoreit and Brants (2008). Only words without a training token stay where their ending is.
The class bigrams of the model are counted after that, again over all training tokens.

A token's probability is that of its class after the class before, times that of the word in its
class, each with a constant added to its count; a class has one place for words not seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from ratelens.llm.tables import kept, texts
from ratelens.llm.words import LOWER, words_of

BLOCK_TOKENS = 1_000_000
UNIT_SHARE = 0.001              # of the tokens, at least; so at most 1000 units of each kind
CLASSES = 32
SWEEPS = 12
ADDED = 0.5                     # to each count
KINDS = 4                       # of units: words, then endings of 3, 2 and 1 bytes
BINS = 2 * (CLASSES + 1) + 1    # what is around a word: class before, class after, the word itself
AROUND = np.dtype([("bin", "u1"), ("times", "u1")])     # more than 255 times: several of one bin
PART_ROWS = 1_000_000           # counted words that a task holds before it sends them to their blocks
WORDS_AT_ONCE = 8192            # that move in one step of numpy


# ---- blocks ---------------------------------------------------------------------------------

def _endings(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The last three bytes of each word, in lower case, the last one lowest."""
    out = np.zeros(len(begin), np.uint32)
    for back in (1, 2, 3):
        at = np.maximum(end - back, 0)
        byte = np.where(end - back >= begin, LOWER[data[at]], 0).astype(np.uint32)
        out |= byte << np.uint32(8 * (back - 1))
    return out


def _packed(values: np.ndarray) -> bytes:
    return pa.compress(values.tobytes(), "zstd", asbytes=True)


def _unpacked(data: bytes, size: int, kind: type) -> np.ndarray:
    whole = pa.decompress(data, size * np.dtype(kind).itemsize, "zstd", asbytes=True)
    return np.frombuffer(whole, kind)


_BLOCK = ("block long, doc_ids array<long>, lengths array<int>, held array<boolean>, n_words int, "
          "n_tokens int, hashes binary, endings binary, times binary, codes binary")


def _blocks(docs: DataFrame) -> DataFrame:
    """One row per block of ``doc_id``, ``text``, ``held``; ``times`` counts tokens not held out."""
    def block(name: int, parts: list[tuple]) -> pa.RecordBatch:
        ids, lengths, held, hashes, endings = (list(x) for x in zip(*parts))
        ids = pa.concat_arrays(ids)
        lengths, held = np.concatenate(lengths), np.concatenate(held)
        hashes, endings = np.concatenate(hashes), np.concatenate(endings)
        distinct, first, code = np.unique(hashes, return_index=True, return_inverse=True)
        learn = np.repeat(~held, lengths)
        times = np.bincount(code[learn], minlength=len(distinct))
        order = np.argsort(-np.bincount(code, minlength=len(distinct)), kind="stable")
        place = np.empty(len(order), np.uint32)
        place[order] = np.arange(len(order), dtype=np.uint32)
        row = [name, ids.to_pylist(), lengths.tolist(), held.tolist(), len(distinct), len(hashes),
               distinct[order].tobytes(), _packed(endings[first][order]),
               _packed(times[order].astype(np.uint32)), _packed(place[code])]
        names = [c.split()[0] for c in _BLOCK.split(", ")]
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.bool_()),
                 pa.int32(), pa.int32(), *[pa.binary()] * 4]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, parts, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for words in words_of(batch.column("text")):
                parts.append((
                    batch.column("doc_id")[words.rows], np.diff(words.first),
                    batch.column("held")[words.rows].to_numpy(zero_copy_only=False).astype(bool),
                    words.hashes(), _endings(words.data, words.begin, words.end)))
                size += len(words.begin)
                if size >= BLOCK_TOKENS:
                    yield block(name, parts)
                    name, parts, size = name + 1, [], 0
        if parts:
            yield block(name, parts)
    return docs.mapInArrow(work, _BLOCK)


# ---- units and classes ----------------------------------------------------------------------

def _kinds(hashes: np.ndarray, endings: np.ndarray) -> list[np.ndarray]:
    """What a word is, under each kind of unit, as whole numbers."""
    return [hashes.view(np.int64), *((endings & np.uint32(m)).astype(np.int64)
                                     for m in (0xFFFFFF, 0xFFFF, 0xFF))]


def _block_words(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = row["n_words"]
    return (np.frombuffer(row["hashes"], np.uint64), _unpacked(row["endings"], n, np.uint32),
            _unpacked(row["times"], n, np.uint32).astype(np.int64))


def _kind_counts(blocks: DataFrame, share: float) -> DataFrame:
    """``kind``, ``value``, ``times`` in a block, of all that has ``share`` of the block's tokens."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                hashes, endings, times = _block_words(row)
                least = max(1, share * times.sum() * (1 - 1e-9))
                for kind, values in enumerate(_kinds(hashes, endings)):
                    value, at = np.unique(values, return_inverse=True)
                    sums = np.bincount(at, weights=times, minlength=len(value)).astype(np.int64)
                    good = sums >= least
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(int(good.sum()), kind, np.int32)),
                         pa.array(value[good]), pa.array(sums[good])], ["kind", "value", "times"])
    return blocks.select("n_words", "hashes", "endings", "times") \
        .mapInArrow(work, "kind int, value long, times long")


def _frequent(blocks: DataFrame, total: int) -> list[np.ndarray]:
    """Sorted units of each kind: all with ``UNIT_SHARE`` of the tokens and no others.

    This decides only which words move on the driver; ``_word_parts`` moves all others.
    Spark sends the candidates to the tasks while they are few and joins them by a shuffle else.
    """
    candidates = kept(_kind_counts(blocks, UNIT_SHARE).select("kind", "value").distinct(), "candidates")
    found = _kind_counts(blocks, 0).join(candidates, ["kind", "value"], "left_semi") \
        .groupBy("kind", "value").agg(F.sum("times").alias("times")) \
        .where(F.col("times") >= max(1, UNIT_SHARE * total)).collect()
    return [np.sort(np.array([r["value"] for r in found if r["kind"] == k], np.int64))
            for k in range(KINDS)]


@dataclass
class Units:
    """Units of each kind, numbered on; after them that of all other words and that of the end."""

    of_kind: list[np.ndarray]

    @property
    def other(self) -> int:
        return sum(map(len, self.of_kind))

    @property
    def end(self) -> int:
        return self.other + 1

    def number(self, hashes: np.ndarray, endings: np.ndarray) -> np.ndarray:
        out = np.full(len(hashes), self.other)
        free, start = np.ones(len(hashes), bool), 0
        for values, known in zip(_kinds(hashes, endings), self.of_kind):
            if len(known):
                at = np.minimum(np.searchsorted(known, values), len(known) - 1)
                hit = free & (known[at] == values)
                out[hit] = start + at[hit]
                free &= ~hit
            start += len(known)
        return out


def _ends(lengths: np.ndarray) -> np.ndarray:
    """Places of the ends when each text is followed by one."""
    return np.cumsum(lengths + 1) - 1


def _with_ends(values: np.ndarray, lengths: np.ndarray, end: int) -> np.ndarray:
    out = np.full(len(values) + len(lengths), end, values.dtype)
    inner = np.ones(len(out), bool)
    inner[_ends(lengths)] = False
    out[inner] = values
    return out


def _learned_tokens(row: dict) -> np.ndarray:
    """Places of a block's tokens that are not held out, ends included, which have the place after all words."""
    lengths, held = np.array(row["lengths"], np.int64), np.array(row["held"], bool)
    code = _unpacked(row["codes"], row["n_tokens"], np.uint32).astype(np.int64)
    return _with_ends(code[np.repeat(~held, lengths)], lengths[~held], row["n_words"])


def _unit_bigrams(blocks: DataFrame, units: Units) -> np.ndarray:
    """How often a unit follows a unit, over all texts that are not held out."""
    size = units.end + 1

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                hashes, endings, _ = _block_words(row)
                unit = np.append(units.number(hashes, endings), units.end)[_learned_tokens(row)]
                before = np.concatenate([[units.end], unit[:-1]])[:len(unit)]
                pair, times = np.unique(before * size + unit, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(times)], ["pair", "times"])
    found = blocks.select("lengths", "held", "n_words", "n_tokens", "hashes", "endings", "times", "codes") \
        .mapInArrow(work, "pair long, times long") \
        .groupBy("pair").agg(F.sum("times").alias("times")).toPandas()
    out = np.zeros(size * size)
    out[found["pair"].to_numpy(np.int64)] = found["times"].to_numpy(float)
    return out.reshape(size, size)


def _h(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(pairs: np.ndarray, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """The class of each unit; the last unit, the end, has the last class for itself.

    Units start dealt out by frequency. One after the other moves to the class where the class
    bigrams' likelihood is largest, ties to the lower class, until a sweep moves none.
    """
    n = len(pairs) - 1
    often = np.argsort(-(pairs.sum(axis=0) + pairs.sum(axis=1))[:n], kind="stable")
    of = np.full(n + 1, classes)
    of[often] = np.arange(n) % classes
    count = np.zeros((classes + 1, classes + 1))
    np.add.at(count, (of[:, None].repeat(n + 1, 1), of[None, :].repeat(n + 1, 0)), pairs)
    for _ in range(sweeps):
        moved = False
        for u in often:
            right = np.bincount(of, weights=pairs[u], minlength=classes + 1)
            left = np.bincount(of, weights=pairs[:, u], minlength=classes + 1)
            own, was = pairs[u, u], of[u]
            right[was] -= own
            left[was] -= own
            count[was] -= right
            count[:, was] -= left
            count[was, was] -= own
            firsts, seconds = count.sum(axis=1) + left, count.sum(axis=0) + right
            both = np.arange(classes)
            gain = (_h(count + right) - _h(count)).sum(axis=1)[:classes] \
                + (_h(count.T + left) - _h(count.T)).sum(axis=1)[:classes]
            same = count[both, both]
            gain += _h(same + right[both] + left[both] + own) + _h(same) \
                - _h(same + right[both]) - _h(same + left[both])
            gain -= _h(firsts + right.sum() + own)[:classes] - _h(firsts)[:classes]
            gain -= _h(seconds + left.sum() + own)[:classes] - _h(seconds)[:classes]
            best = int(gain.argmax())
            if gain[best] <= gain[was] + 1e-9 * abs(gain[was]):
                best = int(was)
            moved |= best != was
            of[u] = best
            count[best] += right
            count[:, best] += left
            count[best, best] += own
        if not moved:
            break
    return of


# ---- words that are no units by themselves --------------------------------------------------

def _rise(x: np.ndarray, by: np.ndarray) -> np.ndarray:
    """``_h(x + by) - _h(x)``, also where ``by`` is small beside ``x``."""
    return by * np.log(np.maximum(x + by, 1e-300)) + x * np.log1p(by / np.maximum(x, 1e-300))


def moved(count: np.ndarray, was: np.ndarray, around: np.ndarray) -> np.ndarray:
    """The class of each word once it has moved by itself, as in ``exchange``, all else staying.

    ``count`` has the class bigrams with all words in the classes ``was``. ``around`` has a row for
    each word: how often each class comes before it, how often each comes after it, other words of
    its own class included, and how often it follows itself. Ties stay, or go to the lower class. No
    word moves to a class without tokens, as all that gain there would meet in it.
    """
    k = len(count) - 1
    every = np.arange(len(was))
    left, right, own = around[:, :k + 1], around[:, k + 1:2 * k + 2], around[:, -1]
    gain = np.zeros((len(was), k))
    for sums, others, cells in ((right, left, count.T[:, :k]), (left, right, count[:, :k])):
        word, at = np.nonzero(sums)
        if not len(word):
            continue
        by, home = sums[word, at], was[word]
        kinds, kind = np.unique(by * (k + 1) + at, return_inverse=True)     # few: rare words count one
        rise = _rise(cells[(kinds % (k + 1)).astype(int)], (kinds // (k + 1))[:, None])[kind]
        # Class bigrams without the word: fewer with its class.
        same = np.flatnonzero(at == home)
        rise[same] = _rise(cells[at[same]] - others[word[same], :k], by[same, None])
        less = by + np.where(at == home, others[word, home] + own[word], 0)
        rise[np.arange(len(word)), home] = _rise(cells[at, home] - less, by)
        first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        gain[word[first]] += np.add.reduceat(rise, first)
    word, at = np.nonzero(((left[:, :k] > 0) & (right[:, :k] > 0)) | (own > 0)[:, None])
    before, after, self = left[word, at], right[word, at], own[word]
    cell = count[at, at] - np.where(at == was[word], before + after + self, 0)
    gain[word, at] += _rise(cell, before + after + self) - _rise(cell, before) - _rise(cell, after)
    for sums, total in ((right, count.sum(axis=1)[:k]), (left, count.sum(axis=0)[:k])):
        by = sums.sum(axis=1) + own
        size, place = np.unique(by, return_inverse=True)
        rise = _rise(total, size[:, None])[place]
        rise[every, was] = _rise(total[was] - by, by)
        gain -= rise
    stay = gain[every, was]
    gain[:, count.sum(axis=0)[:k] == 0] = -np.inf
    gain[every, was] = stay
    best = gain.argmax(axis=1)
    return np.where(gain[every, best] > stay + 1e-9 * np.abs(stay), best, was)


def _word_rows(blocks: DataFrame, units: Units, class_of: np.ndarray) -> DataFrame:
    """``word``, ``block``, ``place``, ``was``, ``around`` of words that are no units by themselves.

    ``around`` holds what is around the word in the block, as ``AROUND``; nothing where all is held out.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                hashes, endings, _ = _block_words(row)
                n = len(hashes)
                unit = units.number(hashes, endings)
                free = np.append(unit >= len(units.of_kind[0]), False)
                of = np.append(class_of[unit], CLASSES)
                token = _learned_tokens(row)
                before = np.concatenate([[n], token[:-1]])[:len(token)]
                own = before == token
                lefts = token * BINS + np.where(own, BINS - 1, of[before])
                rights = before * BINS + CLASSES + 1 + of[token]
                key, times = np.unique(np.concatenate([lefts[free[token]], rights[free[before] & ~own]]),
                                       return_counts=True)
                entries = (times + 254) // 255
                key, last = np.repeat(key, entries), np.cumsum(entries) - 1
                word, place = key // BINS, np.flatnonzero(free[:n])
                around = np.full(len(key), 255, AROUND)
                around["bin"] = key - word * BINS
                around["times"][last] = times - 255 * (entries - 1)
                sizes = np.bincount(word, minlength=n)[place] * AROUND.itemsize
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes[place].view(np.int64)),
                     pa.array(np.full(len(place), row["block"], np.int64)),
                     pa.array(place.astype(np.int32)), pa.array(of[place].astype(np.int8)),
                     pa.Array.from_buffers(pa.binary(), len(place), [
                         None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(around.tobytes())])],
                    ["word", "block", "place", "was", "around"])
    return blocks.select("block", "lengths", "held", "n_words", "n_tokens", "hashes", "endings", "times", "codes") \
        .mapInArrow(work, "word long, block long, place int, was byte, around binary")


def _parts(block: np.ndarray, place: np.ndarray, times: np.ndarray, of: np.ndarray,
           first: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Words' counts and classes for each block, packed."""
    order = np.lexsort((place, block))
    block, place, times, of, first = (x[order] for x in (block, place, times, of, first))
    begin = np.flatnonzero(np.append(True, block[1:] != block[:-1])) if len(block) else np.zeros(0, int)
    rows = [(block[a], b - a, _packed(np.diff(place[a:b], prepend=0).astype(np.uint32)),
             _packed(times[a:b].astype(np.int64)), _packed((of[a:b] + 128 * first[a:b]).astype(np.uint8)))
            for a, b in zip(begin, np.append(begin[1:], len(block)))]
    names = [c.split()[0] for c in _PART.split(", ")]
    kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 3]
    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)


_PART = "block long, n int, places binary, totals binary, classes binary"


def _word_parts(rows: DataFrame, count: np.ndarray) -> DataFrame:
    """For each block its words' ``totals`` over all blocks and ``classes`` once they have moved.

    128 is added to the class in one block for each word that has a training token. A word has a row
    in each block at most; rows come sorted by word, and a task holds one word's.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def whole(part: pa.RecordBatch) -> tuple[np.ndarray, ...]:
            word = part.column("word").to_numpy()
            first = np.ones(len(word), bool)
            first[1:] = word[1:] != word[:-1]
            begin, index = np.flatnonzero(first), np.cumsum(first) - 1
            was = part.column("was").to_numpy()[begin].astype(np.int64)
            packed = part.column("around").cast(pa.large_binary())
            ends = np.frombuffer(packed.buffers()[1], np.int64)[packed.offset:packed.offset + len(word) + 1]
            data = packed.buffers()[2]
            around = np.frombuffer(data if data is not None else b"", np.uint8)[ends[0]:ends[-1]].view(AROUND)
            owner = np.repeat(index, np.diff(ends) // AROUND.itemsize)
            of, total = was.copy(), np.zeros(len(was), np.int64)
            for a in range(0, len(was), WORDS_AT_ONCE):
                b = min(a + WORDS_AT_ONCE, len(was))
                here = slice(*np.searchsorted(owner, [a, b]))
                sums = np.bincount((owner[here] - a) * BINS + around["bin"][here],
                                   around["times"][here], (b - a) * BINS).reshape(b - a, BINS)
                total[a:b] = (sums[:, :CLASSES + 1].sum(axis=1) + sums[:, -1]).astype(np.int64)
                of[a:b] = moved(count, was[a:b], sums)
            return (part.column("block").to_numpy(), part.column("place").to_numpy(), total[index],
                    of[index], first & (total[index] > 0))
        held, done, size = None, [], 0
        for batch in batches:
            part = pa.Table.from_batches([batch]) if held is None else \
                pa.concat_tables([held, pa.Table.from_batches([batch])])
            word = part.column("word").to_numpy()
            cut = int(np.searchsorted(word, word[-1])) if len(word) else 0
            if cut:
                done.append(whole(part.slice(0, cut).combine_chunks().to_batches()[0]))
                size += cut
            held = part.slice(cut)
            if size >= PART_ROWS:
                yield from _parts(*map(np.concatenate, zip(*done)))
                done, size = [], 0
        if held is not None and held.num_rows:
            done.append(whole(held.combine_chunks().to_batches()[0]))
        if done:
            yield from _parts(*map(np.concatenate, zip(*done)))
    return rows.repartition("word").sortWithinPartitions("word").mapInArrow(work, _PART)


def _unit_parts(blocks: DataFrame, units: Units, class_of: np.ndarray, totals: np.ndarray) -> DataFrame:
    """The same for the words that are units by themselves; ``totals`` are those of the units."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                hashes, endings, _ = _block_words(row)
                unit = units.number(hashes, endings)
                own = np.flatnonzero(unit < len(units.of_kind[0]))
                yield from _parts(np.full(len(own), row["block"], np.int64), own, totals[unit[own]],
                                  class_of[unit[own]], np.zeros(len(own), bool))
    return blocks.select("block", "n_words", "hashes", "endings", "times").mapInArrow(work, _PART)


_CODED = ("doc_ids array<long>, lengths array<int>, held array<boolean>, n_words int, n_tokens int, "
          "codes binary, totals binary, classes binary, bigrams array<long>, new_words array<long>")


def _coded(blocks: DataFrame, parts: DataFrame) -> DataFrame:
    """Blocks with the corpus count and class of each word, and what they add to the class counts.

    ``bigrams`` has how often a class follows a class in texts not held out, ``new_words`` how many
    words of a class are counted in this block.
    """
    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        times, of = np.zeros(row["n_words"], np.int64), np.zeros(row["n_words"], np.uint8)
        for part in right.to_pylist():
            place = np.cumsum(_unpacked(part["places"], part["n"], np.uint32), dtype=np.int64)
            times[place] = _unpacked(part["totals"], part["n"], np.int64)
            of[place] = _unpacked(part["classes"], part["n"], np.uint8)
        new, of = of >= 128, of & 127
        at = np.append(of, CLASSES).astype(np.int64)[_learned_tokens(row)]
        before = np.concatenate([[CLASSES], at[:-1]])[:len(at)]
        size = CLASSES + 1
        more = [_packed(times), _packed(of), np.bincount(before * size + at, minlength=size * size).tolist(),
                np.bincount(of[new], minlength=size).tolist()]
        out = left.drop_columns(["block"])
        for name, value, kind in zip(("totals", "classes", "bigrams", "new_words"), more,
                                     (*[pa.binary()] * 2, *[pa.list_(pa.int64())] * 2)):
            out = out.append_column(name, pa.array([value], kind))
        return out
    return blocks.select("block", "doc_ids", "lengths", "held", "n_words", "n_tokens", "codes") \
        .groupBy("block").cogroup(parts.groupBy("block")).applyInArrow(work, _CODED)


def _sums(coded: DataFrame, name: str, size: int) -> np.ndarray:
    """A column of arrays of one length, summed over all blocks place by place."""
    out = np.zeros(size)
    for place, total in coded.select(F.posexplode(name)).where("col > 0") \
            .groupBy("pos").agg(F.sum("col")).collect():
        out[place] = total
    return out


# ---- scores ---------------------------------------------------------------------------------

@dataclass
class Model:
    """Log10 probabilities of classes after classes, and what words need for theirs."""

    after: np.ndarray           # class x class
    room: np.ndarray            # tokens of a class, and the constant for each of its words and one more
    tokens: int
    words: int
    ends: int


def _scored(model: Model, row: dict) -> pa.RecordBatch:
    """One row per text of a block."""
    lengths, held = np.array(row["lengths"], np.int64), np.array(row["held"], bool)
    times = np.append(_unpacked(row["totals"], row["n_words"], np.int64), model.ends)
    of = np.append(_unpacked(row["classes"], row["n_words"], np.uint8), CLASSES).astype(np.int64)
    base = np.log10((times + ADDED) / (model.tokens + ADDED * (model.words + 1)))
    own = np.log10((times + ADDED) / model.room[of])
    code = _unpacked(row["codes"], row["n_tokens"], np.uint32).astype(np.int64)
    token = _with_ends(code, lengths, row["n_words"])
    at = of[token]
    before = np.concatenate([[CLASSES], at[:-1]])
    begin = _ends(lengths) - lengths
    return pa.RecordBatch.from_pydict({
        "doc_id": pa.array(row["doc_ids"], pa.int64()), "held_out": pa.array(held),
        "n_tokens": pa.array(lengths + 1),
        "n_known": pa.array(np.add.reduceat((times[token] > 0).astype(np.int64), begin)),
        "train_tokens": pa.array(np.full(len(lengths), model.tokens, np.int64)),
        "base_score": pa.array(np.add.reduceat(base[token], begin)),
        "score": pa.array(np.add.reduceat(model.after[before, at] + own[token], begin))})


def held_out() -> Column:
    """Whether a row is kept from learning, by ``doc_id`` alone. A null id is never held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 1, F.lit(False))


def scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    Tokens are the words and one end for each text, so a null or empty text has one token.
    ``base_score`` is the smoothed unigram log10 probability, ``score`` the model's. Every row of
    ``docs`` counts, repeated ones as often as they occur. An empty table gives an empty result.
    """
    rows = texts(docs, id_col, text_col).withColumn("held", held_out())
    blocks = kept(_blocks(rows), "blocks")
    learned = F.expr("aggregate(zip_with(lengths, held, (n, h) -> if(h, 0L, n + 1L)), 0L, (a, n) -> a + n)")
    ends = F.expr("cast(size(filter(held, h -> not h)) as long)")
    tokens, ends = (x or 0 for x in blocks.agg(F.sum(learned), F.sum(ends)).first())

    units = Units(_frequent(blocks, tokens))
    pairs = _unit_bigrams(blocks, units)
    class_of = exchange(pairs)
    n_classes = CLASSES + 1
    count = np.zeros((n_classes, n_classes))
    np.add.at(count, (class_of[:, None].repeat(len(pairs), 1), class_of[None, :].repeat(len(pairs), 0)), pairs)

    often = len(units.of_kind[0])
    parts = _word_parts(_word_rows(blocks, units, class_of), count).unionByName(
        _unit_parts(blocks, units, class_of, pairs.sum(axis=0)))
    coded = kept(_coded(blocks, parts), "coded")

    count = _sums(coded, "bigrams", n_classes * n_classes).reshape(n_classes, n_classes)
    words_in = _sums(coded, "new_words", n_classes) + np.bincount(class_of[:often], minlength=n_classes)
    words_in[CLASSES] += ends > 0
    after = np.log10((count + ADDED) / (count.sum(axis=1, keepdims=True) + ADDED * n_classes))
    model = Model(after, count.sum(axis=0) + ADDED * (words_in + 1), tokens, int(words_in.sum()), ends)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield _scored(sent.value, row)
    return coded.select("doc_ids", "lengths", "held", "n_words", "n_tokens", "codes", "totals", "classes") \
        .mapInArrow(work, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                          "base_score double, score double")
