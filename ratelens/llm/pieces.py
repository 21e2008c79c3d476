r"""SentencePiece encoding by a Viterbi that shares prefixes, and decoding.

Blanks become the mark U+2581, and a mark is put in front of the text. A text is cut before every run
of marks; line feeds, which no piece can hold, stand apart. So every text is a row of marked words, and
a word's best pieces do not depend on its neighbours.

The distinct words of a batch are sorted, which is the depth-first order of their trie. For each
character on the path to the current word the search keeps the best score so far and the longest piece
that could still go on; the next word starts from the longest prefix it shares with the one before.

The score of a path is the sum of its pieces' scores. In a model by merges a step from one piece to the
next is impossible when merging would join letters across their border. To every place then leads just
one path, and it has the pieces that the model's own merging gives.

Characters without a piece become byte pieces. So does a U+2581 of the text itself, which the model's
own encoder would take for a blank; decoding gives back every text exactly.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain, islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
OWN = "\ud800"                  # stands for a mark of the text itself; no valid text holds it
WORD = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")
BATCH_CHARS = 1 << 21           # texts whose words are sorted together
WORST = 10.0                    # a byte piece is so much worse than the worst piece
PAIRS_KEPT = 500_000            # pairs of neighbours that a task remembers
WORDS_KEPT = 150_000            # encoded words that a task remembers, of
LONGEST_KEPT = 40               # characters at most
NEVER = float("inf")


@dataclass
class Vocabulary:
    """Pieces with scores as a trie of dictionaries; the piece that ends at a node is under ``""``.

    For a model by merges ``rank`` has the place of each merge by its result, ``ends`` and ``starts`` the
    parts of a piece that stand at its right and left border while it is merged, smallest first.
    """

    root: dict = field(default_factory=dict)
    of_byte: list[int] = field(default_factory=list)
    text: dict[int, str] = field(default_factory=dict)    # as decoded; bytes above 0x7F escaped
    worst: float = 0.0
    rank: dict[str, float] = field(default_factory=dict)
    ends: dict[int, list[str]] = field(default_factory=dict)
    starts: dict[int, list[str]] = field(default_factory=dict)
    # The trie by numbered nodes: next node by character, node of the longest shorter ending, and
    # length, id and score of the pieces that end there, longest first.
    steps: list[dict[str, int]] = field(default_factory=list)
    shorter: list[int] = field(default_factory=list)
    over: list[list[tuple[int, int, float]]] = field(default_factory=list)

    def number(self) -> None:
        """Number the nodes of the trie level by level, so a node's shorter endings come before it."""
        self.steps, self.shorter, self.over = [{}], [0], [[]]
        level = [(0, 0, self.root)]
        while level:
            below = []
            for at, depth, node in level:
                for c, child in node.items():
                    if not c:
                        continue
                    back = self.shorter[at]
                    while back and c not in self.steps[back]:
                        back = self.shorter[back]
                    back = self.steps[back].get(c, 0) if at else 0
                    new = len(self.steps)
                    self.steps[at][c] = new
                    self.steps.append({})
                    self.shorter.append(back)
                    own = [(depth + 1, *child[""])] if "" in child else []
                    self.over.append(own + self.over[back] if own else self.over[back])
                    below.append((new, depth + 1, child))
            level = below

    def add(self, piece: str, id_: int, score: float) -> None:
        node = self.root
        for c in piece:
            node = node.setdefault(c, {})
        node[""] = (id_, score)
        self.text[id_] = piece.replace(MARK, " ")
        self.worst = min(self.worst, score)

    def stay_apart(self, left: int, right: int) -> bool:
        """Whether merging leaves the two pieces as neighbours.

        Of the next merges left of, right of and across the border the first in rank is done, among
        equals the leftmost.
        """
        ends, starts, rank = self.ends[left], self.starts[right], self.rank
        i = j = 0
        while True:
            across = rank.get(ends[i] + starts[j], NEVER)
            before = rank[ends[i + 1]] if i + 1 < len(ends) else NEVER
            after = rank[starts[j + 1]] if j + 1 < len(starts) else NEVER
            if across < before and across <= after:
                return False
            if before == after == NEVER:
                return True
            if before <= after:
                i += 1
            else:
                j += 1


def last_merge(piece: str, rank: dict[str, float]) -> tuple[str, str] | None:
    """The two parts that the last merge joins to ``piece``; None when merging does not lead to it."""
    parts = list(piece)
    while len(parts) > 2:
        first = min(range(len(parts) - 1), key=lambda i: rank.get(parts[i] + parts[i + 1], NEVER))
        if parts[first] + parts[first + 1] not in rank:
            return None
        parts[first:first + 2] = [parts[first] + parts[first + 1]]
    return parts[0], parts[1]


def vocabulary(model_file: str) -> Vocabulary:
    """Read on the driver; it has a fixed size. Pieces with a mark behind a letter are left out.

    Scores of a unigram model are log probabilities. A model by merges has ranks instead, as whole
    numbers; of its pieces those stay that merging can lead to.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    out, pieces = Vocabulary(of_byte=[0] * 256), []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            out.of_byte[int(piece[3:5], 16)] = i
            out.text[i] = bytes([int(piece[3:5], 16)]).decode("utf-8", "surrogateescape")
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)) \
                and MARK not in piece.lstrip(MARK):
            pieces.append((piece, i, model.get_score(i)))
    if all(score == int(score) for *_, score in pieces):
        out.rank = {piece: -score for piece, _, score in pieces if len(piece) > 1}
        parts = {piece: last_merge(piece, out.rank) for piece in out.rank}
        ends, starts = {}, {}
        for piece, i, _ in sorted(pieces, key=lambda p: len(p[0])):
            if len(piece) == 1:
                ends[piece], starts[piece] = [piece], [piece]
            elif parts[piece] and parts[piece][0] in starts and parts[piece][1] in ends:
                starts[piece] = [*starts[parts[piece][0]], piece]
                ends[piece] = [*ends[parts[piece][1]], piece]
        pieces = [p for p in pieces if p[0] in ends]
        out.ends = {i: ends[piece] for piece, i, _ in pieces}
        out.starts = {i: starts[piece] for piece, i, _ in pieces}
    for piece, i, score in pieces:
        out.add(piece, i, score)
    if 0 in out.of_byte[1:] or "" not in out.root.get(MARK, {}):
        raise ValueError("the vocabulary lacks bytes or the mark, so not every text can be encoded")
    out.number()
    return out


def shared(before: str, word: str) -> int:
    """Length of the common prefix of two words that follow each other in order."""
    if word.startswith(before):
        return len(before)
    low, high = 0, min(len(before), len(word))   # the first ``low`` are alike, more than ``high`` are not
    while low < high:
        middle = (low + high + 1) // 2
        if word.startswith(before[low:middle], low):
            low = middle
        else:
            high = middle - 1
    return low


def encoded_words(words: Iterable[str], vocab: Vocabulary,
                  known: dict[object, dict[int, bool]] | None = None) -> dict[str, list[int]]:
    """The best pieces of each distinct word; ``known`` remembers which pieces stay apart, by the left one.

    Of two ways with the same score the one whose last piece is longer wins.
    """
    if not vocab.steps:
        vocab.number()
    out, merges, lone = {}, bool(vocab.rank), vocab.worst - WORST
    steps, shorter, over = vocab.steps, vocab.shorter, vocab.over
    known = {} if known is None else known
    room = PAIRS_KEPT - sum(map(len, known.values()))
    best = [0.0]                                 # best[i]: score of the first i characters
    begin, last = [0], [""]                      # where the last piece starts, and its id or character
    beside = [known.setdefault("", {})]          # what is known of the last piece's neighbours
    nodes = [0]                                  # the longest piece not yet over
    before = ""
    for word in sorted(words):
        share = shared(before, word)
        del best[share + 1:], begin[share + 1:], last[share + 1:], beside[share + 1:], nodes[share + 1:]
        if room < 0:
            for pairs in known.values():
                pairs.clear()
            room = PAIRS_KEPT
        node = nodes[share]
        for i in range(share, len(word)):
            c = word[i]
            while node and c not in steps[node]:
                node = shorter[node]
            node = steps[node].get(c, 0)
            top, at, one, side = best[i] + lone, i, c, ""
            for length, id_, score in over[node]:
                start = i + 1 - length
                if merges:
                    apart = beside[start].get(id_)
                    if apart is None:
                        left = last[start]
                        apart = isinstance(left, str) or vocab.stay_apart(left, id_)
                        beside[start][id_] = apart
                        room -= 1
                    if apart:                    # the only way
                        top, at, one, side = best[start] + score, start, id_, id_
                        break
                elif best[start] + score > top:
                    top, at, one = best[start] + score, start, id_
            best.append(top)
            begin.append(at)
            last.append(one)
            pairs = known.get(side)
            if pairs is None:
                pairs = known[side] = {}
            beside.append(pairs)
            nodes.append(node)
        before, ids, end = word, [], len(word)
        while end:
            one, end = last[end], begin[end]
            if isinstance(one, str):
                ids += [vocab.of_byte[b] for b in reversed((MARK if one == OWN else one).encode())]
            else:
                ids.append(one)
        ids.reverse()
        out[word] = ids
    return out


def marked_words(text: str) -> list[str]:
    """The words of a text, in order. Line feeds are words."""
    return WORD.findall(MARK + text.replace(MARK, OWN).replace(" ", MARK)) if text else []


def encode_texts(every: list[str | None], vocab: Vocabulary,
                 known: dict[object, dict[int, bool]] | None = None,
                 seen: dict[str, list[int]] | None = None) -> list[list[int] | None]:
    """Piece ids of each text; null stays null. ``seen`` remembers words for the next texts."""
    seen = {} if seen is None else seen
    words = [marked_words(t) if t else [] for t in every]
    distinct = set(chain.from_iterable(words))
    fresh = encoded_words(distinct - seen.keys(), vocab, known)
    ids = {w: seen[w] for w in distinct & seen.keys()} | fresh
    if len(seen) + len(fresh) > WORDS_KEPT:
        seen.clear()
    seen.update(islice(((w, i) for w, i in fresh.items() if len(w) <= LONGEST_KEPT), WORDS_KEPT))
    return [None if t is None else list(chain.from_iterable([ids[w] for w in ws]))
            for t, ws in zip(every, words)]


def decode_ids(ids: Iterable[int], vocab: Vocabulary) -> str:
    """The text of piece ids. The mark in front of the first word is dropped."""
    text = "".join([vocab.text[i] for i in ids])[1:]
    return text.encode("utf-8", "surrogateescape").decode("utf-8", "replace")


def encode(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text",
           keep: tuple[str, ...] = (), batch_chars: int | None = None) -> DataFrame:
    """``doc_id``, ``text``, the columns ``keep`` and ``ids`` (piece ids) of each row.

    ``batch_chars`` (``BATCH_CHARS``) bounds the texts whose words are sorted together: fewer take less
    memory and share fewer prefixes.
    A null text has null ids, an empty one none. Whole texts are encoded, however long. Repeated rows
    give repeated results.
    """
    vocab = docs.sparkSession.sparkContext.broadcast(vocabulary(model_file))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.col(f"`{text_col}`").cast("string").alias("text"), *[F.col(f"`{c}`") for c in keep])
    schema = T.StructType([*rows.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[object, dict[int, bool]] = {}
        seen: dict[str, list[int]] = {}
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0)
            sizes = np.cumsum(sizes.to_numpy(zero_copy_only=False))
            row = 0
            while row < batch.num_rows:
                done = sizes[row - 1] if row else 0
                after = max(row + 1, int(np.searchsorted(sizes, done + (batch_chars or BATCH_CHARS), "right")))
                part = batch.slice(row, after - row)
                ids = encode_texts(part.column("text").to_pylist(), vocab.value, known, seen)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(ids, pa.list_(pa.int32()))], [*part.schema.names, "ids"])
                row = after
    return rows.mapInArrow(work, schema)


def decode(encoded: DataFrame, model_file: str, ids_col: str = "ids", to: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its ids in the column ``to``; null ids give null."""
    vocab = encoded.sparkSession.sparkContext.broadcast(vocabulary(model_file))

    def of(columns: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for ids in columns:
            yield pd.Series([None if i is None else decode_ids(i, vocab.value) for i in ids], dtype=object)
    of.__annotations__ = {"columns": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return encoded.withColumn(to, F.pandas_udf(of, "string")(F.col(f"`{ids_col}`")))


def encoding_report(docs: DataFrame, model_file: str = MODEL) -> DataFrame:
    """``doc_id``, ``n_ids``, ``ids`` and whether decoding them gives the text back."""
    both = decode(encode(docs, model_file), model_file)
    return both.select("doc_id", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_ids"), "ids",
                       F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"))
