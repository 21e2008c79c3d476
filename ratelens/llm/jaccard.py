"""Exact n-gram Jaccard join by multiple global orders, and the components of its links.

Prefix filtering: put all tokens (shingles) of a set in some order that is the same for all sets.
Two sets of sizes a and b with similarity t or more share a token among the first
``a - ceil(t * a) + 1`` of one and ``b - ceil(t * b) + 1`` of the other. This holds for every
order, so a pair must pass the test under several orders; only pairs that pass all are verified.
All orders here put rare tokens first, by number of sets that hold the token, and differ in how
they class those numbers and break ties. Tokens of one set alone can be shared with nothing: they
fill up the front of a prefix, and most sets have no others there and leave the join at once.

Sets that are equal are one class. Classes that share a prefix token of the first order, directly
or through others, form a family; only pairs within a family can link. Families are compared in
blocks of bounded size. A first round compares the members of each block, a second neighbouring
blocks; from then on only members that are not yet in the family's largest component have to be
held against the rest, block by block. Pairs are counted inside a block; what leaves it are at most
as many links as it has members, which connect what the verified pairs connect.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ratelens.llm.components import smallest_reachable
from ratelens.llm.tables import kept, texts
from ratelens.llm.words import mixed, shingles_of, words_of

_ID = (1 << 63) - 1            # class ids are non-negative longs
_TOKEN_BITS = 46
_TOKEN = (1 << _TOKEN_BITS) - 1
_MOST_COUNT = (1 << 17) - 1    # counts above it are one class of the order
_FILTER_BITS = 26
HOT_SHARE = 0.02               # of the sets; tokens in so many are not counted by shuffling them
LEAST_HOT = 5
BLOCK_ROWS = 512
BLOCK_TOKENS = 400_000


def _class_id(tokens: np.ndarray) -> int:
    """The id of a set: a sum over its mixed tokens, with its size mixed in."""
    total = np.add.reduce(mixed(tokens ^ np.uint64(0x5851F42D4C957F2D)))
    return int(mixed(np.array([total + np.uint64(len(tokens))], np.uint64))[0]) & _ID


def _shingle_sets(docs: DataFrame, k: int) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``set_id`` (null for an empty set) for each row.

    Rows with a ``hot`` token instead say that it is in ``times`` sets of one chunk of texts, for
    tokens in at least half of ``HOT_SHARE`` of them.
    """
    schema = "doc_id long, n_shingles long, set_id long, hot long, times long"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in words_of(batch.column("text")):
                sizes, ids, sets = [], [], {}
                for _, tokens in shingles_of(words, k):
                    sizes.append(len(tokens))
                    ids.append(_class_id(tokens) if len(tokens) else None)
                    sets[ids[-1]] = tokens
                sets.pop(None, None)
                every = np.concatenate([np.zeros(0, np.uint64), *sets.values()]) & np.uint64(_TOKEN)
                hot, times = np.unique(every, return_counts=True)
                often = times >= max(LEAST_HOT, HOT_SHARE / 2 * len(sets))
                own, found = len(ids), int(often.sum())
                yield pa.RecordBatch.from_arrays([
                    pa.concat_arrays([batch.column("doc_id")[words.rows], pa.nulls(found, pa.int64())]),
                    pa.array(sizes + [None] * found, pa.int64()),
                    pa.array(ids + [None] * found, pa.int64()),
                    pa.array([None] * own + hot[often].tolist(), pa.int64()),
                    pa.array([None] * own + times[often].tolist(), pa.int64()),
                ], ["doc_id", "n_shingles", "set_id", "hot", "times"])
    return docs.mapInArrow(work, schema)


def _hot_tokens(sets: DataFrame) -> np.ndarray:
    """Every token in ``HOT_SHARE`` or more of the sets, and few others.

    Chunks in which it is rarer than half of that share hold less than half of its sets, so its
    counts in the other chunks add up to half of the share or more. All sets together have at most
    ``2 / HOT_SHARE`` times the mean size of a set of such tokens, whatever the number of rows.
    """
    total = sets.where("set_id is not null").count()
    hot = sets.where("hot is not null").groupBy("hot").agg(F.sum("times").alias("times"))
    rows = hot.where(F.col("times") >= max(LEAST_HOT, HOT_SHARE / 2 * total)).select("hot").collect()
    return np.sort(np.array([r[0] for r in rows], np.int64))


def _token_rows(docs: DataFrame, k: int, hot: np.ndarray) -> DataFrame:
    """``token``, ``set_id``: the tokens of each set, once per partition and set. Hot ones as -1 - token."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            for words in words_of(batch.column("text")):
                tokens, ids, sizes = [], [], []
                for _, own in shingles_of(words, k):
                    if len(own) and (key := _class_id(own)) not in seen:
                        seen.add(key)
                        tokens.append(own & np.uint64(_TOKEN))
                        ids.append(key)
                        sizes.append(len(own))
                if ids:
                    every = np.concatenate(tokens).astype(np.int64)
                    if len(hot):
                        place = np.minimum(np.searchsorted(hot, every), len(hot) - 1)
                        every = np.where(hot[place] == every, -1 - every, every)
                    of_set = np.repeat(np.array(ids, np.int64), sizes)
                    yield pa.RecordBatch.from_arrays([pa.array(every), pa.array(of_set)],
                                                     ["token", "set_id"])
    return docs.select("text").mapInArrow(work, "token long, set_id long")


def _shared_keys(rows: DataFrame) -> DataFrame:
    """``set_id``, ``key`` of the tokens that more than one set has, and of all hot tokens.

    A key holds the token's number of sets, up to ``_MOST_COUNT``, and the token. Rows are dealt
    out by token, hot ones by set, and come in order; a task holds the rows of one token until it
    knows their number, or until that number is the largest that a key can hold.
    """
    place = F.when(F.col("token") < 0, F.col("set_id")).otherwise(F.col("token"))
    dealt = rows.repartition(place).sortWithinPartitions("token", "set_id")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full = None                       # a token whose number of sets is known to be the largest

        def counted(token: np.ndarray, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
            first = np.ones(len(token), bool)
            first[1:] = token[1:] != token[:-1]
            begin = np.flatnonzero(first)
            count = np.repeat(np.diff(np.append(begin, len(token))), np.diff(np.append(begin, len(token))))
            count = np.where((token < 0) | (token == full) if full is not None else token < 0,
                             _MOST_COUNT, np.minimum(count, _MOST_COUNT))
            own = np.where(token < 0, -1 - token, token)
            good = count > 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[good]), pa.array(count[good] << _TOKEN_BITS | own[good])],
                ["set_id", "key"])

        held, size = [], 0

        def joined(held: list) -> tuple[np.ndarray, np.ndarray]:
            t, s = (np.concatenate([h[i] for h in held]) for i in (0, 1))
            new = np.ones(len(t), bool)
            new[1:] = (t[1:] != t[:-1]) | (s[1:] != s[:-1])     # copies from other partitions
            return t[new], s[new]
        for batch in batches:
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            size += batch.num_rows
            if size < 2 * _MOST_COUNT:
                continue
            token, ids = joined(held)
            cut = int(np.searchsorted(token, token[-1]))
            if len(token) - cut >= _MOST_COUNT or token[-1] == full:
                if cut:
                    yield from counted(token[:cut], ids[:cut])
                full = token[-1]
                yield from counted(token[cut:-1], ids[cut:-1])   # the last row finds its copies
                cut = len(token) - 1
            elif cut:
                yield from counted(token[:cut], ids[:cut])
            held, size = [(token[cut:], ids[cut:])], len(token) - cut
        if held:
            yield from counted(*joined(held))
    return dealt.mapInArrow(work, "set_id long, key long")


def _prefix_length(n: np.ndarray | int, t: Fraction) -> np.ndarray | int:
    """n - ceil(t * n) + 1, in whole numbers."""
    return n - (n * t.numerator + t.denominator - 1) // t.denominator + 1


def _orders(keys: np.ndarray) -> list[np.ndarray]:
    """Places of the tokens under three orders. A key holds count and token."""
    count, token = keys >> _TOKEN_BITS, keys & _TOKEN
    low = np.uint64(_TOKEN)
    coarse = np.frexp(count.astype(float))[1]
    return [np.argsort(keys, kind="stable"),
            np.lexsort((mixed(token.astype(np.uint64)) & low, coarse)),
            np.lexsort((mixed(token.astype(np.uint64) + np.uint64(1)) & low, (coarse + 1) // 2))]


def _with_prefixes(sets: DataFrame, t: Fraction) -> DataFrame:
    """Sets with shared tokens in a prefix; ``first``, ``second``, ``third`` are those tokens."""
    schema = ("set_id long, n int, alone int, tokens array<long>, first array<long>, "
              "second array<long>, third array<long>")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, n, found in zip(*(batch.column(c) for c in ("set_id", "n", "keys"))):
                keys, n = found.values.to_numpy(zero_copy_only=False), n.as_py()
                alone = n - len(keys)
                length = _prefix_length(n, t) - alone
                if length > 0:
                    tokens = keys & _TOKEN
                    rows.append((key.as_py(), n, alone, np.sort(tokens),
                                 *(tokens[o[:length]] for o in _orders(keys))))
            columns = list(zip(*rows)) or [[]] * 7
            kinds = [pa.int64(), pa.int32(), pa.int32(), *[pa.list_(pa.int64())] * 4]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(columns, kinds)],
                ["set_id", "n", "alone", "tokens", "first", "second", "third"])
    return sets.mapInArrow(work, schema)


def _shared(lists: list[np.ndarray]) -> np.ndarray:
    """How many tokens each two of the lists share."""
    sizes = np.array([len(x) for x in lists])
    rows = np.repeat(np.arange(len(lists)), sizes)
    _, column, times = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    useful = times[column] > 1
    rows = rows[useful]
    _, column = np.unique(column[useful], return_inverse=True)
    out, step = np.zeros((len(lists), len(lists)), np.float32), 4096
    order = np.argsort(column, kind="stable")
    rows, column = rows[order], column[order]
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, step):
        a, b = np.searchsorted(column, [low, low + step])
        holds = np.zeros((len(lists), min(step, int(column[-1]) + 1 - low)), np.float32)
        holds[rows[a:b], column[a:b] - low] = 1
        out += holds @ holds.T
    return out


def _links_among(members: pd.DataFrame, t: Fraction) -> list[tuple[int, int]]:
    """Links that connect what the verified pairs of these sets connect, at most one a member.

    Only pairs of different ``root`` count; where ``side`` differs from 0 a pair needs both sides.
    """
    n = members["n"].to_numpy(np.int64)
    alone = members["alone"].to_numpy(np.int64)
    root = members["root"].to_numpy(np.int64)
    side = members["side"].to_numpy(np.int64)
    top, bottom = t.numerator, t.denominator
    both = n[:, None] + n[None, :]
    # J >= t means: shared >= t / (1 + t) * (a + b), so few tokens can be outside the other set.
    least = (both * top + (top + bottom) - 1) // (top + bottom)
    may = (root[:, None] != root[None, :]) & ((side[:, None] != side[None, :]) | (side[:, None] == 0))
    may &= np.minimum.outer(n, n) * bottom >= np.maximum.outer(n, n) * top
    may &= both - (alone[:, None] + alone[None, :]) >= 2 * least
    for order in ("first", "second", "third"):
        if not may.any():
            return []
        may &= _shared([np.asarray(x) for x in members[order]]) > 0
    asked = np.flatnonzero(may.any(axis=1))
    if not len(asked):
        return []
    tokens = [np.asarray(members["tokens"].iloc[i]) for i in asked]
    shared = _shared(tokens).astype(np.int64)
    linked = may[np.ix_(asked, asked)] & (shared >= least[np.ix_(asked, asked)])
    ids = members["set_id"].to_numpy(np.int64)[asked]
    roots = root[asked]
    # Walk from set to set; sets of one root count as connected already.
    by_root: dict[int, list[int]] = {}
    for i, r in enumerate(roots):
        by_root.setdefault(int(r), []).append(i)
    seen, out = np.zeros(len(asked), bool), []
    for start in range(len(asked)):
        if seen[start]:
            continue
        queue = by_root[int(roots[start])][:]
        seen[queue] = True
        while queue:
            at = queue.pop()
            for to in np.flatnonzero(linked[at] & ~seen):
                if not seen[to]:
                    out.append((int(ids[at]), int(ids[to])))
                    more = by_root[int(roots[to])]
                    seen[more] = True
                    queue.extend(more)
    return out


def _compare(blocks: DataFrame, t: Fraction) -> DataFrame:
    """Links found in each block; ``block`` names it, small families share one."""
    def work(members: pd.DataFrame) -> pd.DataFrame:
        links = []
        for _, family in members.groupby("family", sort=False):
            if len(family) > 1:
                links += _links_among(family, t)
        return pd.DataFrame(links, columns=["a", "b"]).astype("int64")
    return blocks.groupBy("block").applyInPandas(work, "a long, b long")


def _roots(sets: DataFrame, links: list[DataFrame]) -> DataFrame:
    """``sets`` with the ``root`` of each under the links so far."""
    every = links[0]
    for more in links[1:]:
        every = every.unionByName(more)
    found = smallest_reachable(every, "a", "b")
    return sets.drop("root").join(found.withColumnRenamed("node", "set_id"), "set_id", "left") \
        .withColumn("root", F.coalesce("root", "set_id"))


def linked_sets(candidates: DataFrame, t: Fraction) -> DataFrame:
    """``set_id``, ``root`` of the components of sets linked at similarity t."""
    held = kept(candidates, "sets")
    shared = held.select("set_id", F.explode("first").alias("token"))
    centre = shared.groupBy("token").agg(F.min("set_id").alias("centre"), F.count("*").alias("sets"))
    star = shared.join(centre.where("sets > 1"), "token").where("set_id <> centre")
    family = kept(smallest_reachable(star.select("set_id", "centre").distinct(), "set_id", "centre")
                  .select(F.col("node").alias("set_id"), F.col("root").alias("family")), "families")
    sizes = held.select("set_id", F.size("tokens").alias("many")).join(family, "set_id") \
        .groupBy("family").agg(F.count("*").alias("rows"), F.sum("many").alias("many"))
    parts = F.greatest(F.ceil(F.col("rows") / BLOCK_ROWS), F.ceil(F.col("many") / BLOCK_TOKENS))
    family = kept(family.join(sizes.select("family", parts.alias("parts")), "family"), "families")
    place = F.pmod(F.xxhash64("set_id"), F.col("parts"))
    base = held.join(family, "set_id").withColumn("part", place).withColumn("side", F.lit(0)) \
        .withColumn("root", F.col("set_id"))

    # Members of a block. Families of one block are put together to about the size of a block.
    alone = F.col("parts") == 1
    rows, many = sizes.where(parts == 1).agg(F.sum("rows"), F.sum("many")).first()
    bins = 1 + max((rows or 0) // BLOCK_ROWS, (many or 0) // BLOCK_TOKENS)
    name = F.when(alone, F.struct(F.lit(-1).cast("long").alias("family"),
                                  F.pmod(F.xxhash64("family"), F.lit(bins)).alias("part"))) \
        .otherwise(F.struct("family", "part"))
    links = [kept(_compare(base.withColumn("block", name), t), "links")]
    large = family.where(~alone)
    if large.isEmpty():
        return smallest_reachable(links[0], "a", "b").select(F.col("node").alias("set_id"), "root")

    # Each block with the next of its family.
    roots = kept(_roots(large.select("set_id"), links), "roots")
    many = held.join(large, "set_id").join(roots, "set_id").withColumn("part", place)
    near = many.withColumn("to", F.explode(F.array(
        F.struct(F.col("part").alias("first_part"), F.lit(1).alias("side")),
        F.struct(F.pmod(F.col("part") - 1, F.col("parts")).alias("first_part"),
                 F.lit(2).alias("side")))))
    links.append(kept(_compare(near.select("*", "to.side").withColumn(
        "block", F.struct("family", "to.first_part")), t), "links"))

    # What is outside a family's largest component, against everything else in the family.
    roots = kept(_roots(large.select("set_id"), links), "roots")
    many = held.join(large, "set_id").join(roots, "set_id").withColumn("part", place)
    main = large.join(roots, "set_id").groupBy("family", "root").agg(F.count("*").alias("rows")) \
        .groupBy("family").agg(F.max_by("root", F.struct("rows", "root")).alias("main"))
    many = many.join(main, "family").withColumn("odd", F.col("root") != F.col("main"))
    odd = many.where("odd").groupBy("family").agg(
        F.count("*").alias("rows"), F.sum(F.size("tokens")).alias("many"))
    odd = odd.select("family", F.greatest(F.ceil(F.col("rows") / BLOCK_ROWS), F.ceil(
        F.col("many") / BLOCK_TOKENS)).alias("odd_parts"))
    many = many.join(odd, "family").withColumn(
        "odd_part", F.pmod(F.xxhash64("set_id"), F.col("odd_parts")))
    kind, o, p = F.lit, F.col("odd_part"), F.col("part")
    others = F.sequence(F.lit(0).cast("long"), F.col("odd_parts") - 1)
    # An odd set meets each block of the main component, and each odd block, its own included.
    as_main = F.transform(others, lambda x: F.struct(
        kind("main").alias("kind"), x.alias("x"), p.alias("y"), kind(2).alias("side")))
    to_main = F.transform(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1), lambda y: F.struct(
        kind("main").alias("kind"), o.alias("x"), y.alias("y"), kind(1).alias("side")))
    to_odd = F.transform(others, lambda x: F.struct(
        kind("odd").alias("kind"), F.least(o, x).alias("x"), F.greatest(o, x).alias("y"),
        F.when(o == x, 0).when(o < x, 1).otherwise(2).alias("side")))
    met = F.when(F.col("odd"), F.concat(to_main, to_odd)).otherwise(as_main)
    met = many.withColumn("to", F.explode(met))
    links.append(kept(_compare(met.select("*", "to.side").withColumn(
        "block", F.struct("family", "to.kind", "to.x", "to.y")), t), "links"))
    every = links[0].unionByName(links[1]).unionByName(links[2])
    return smallest_reachable(every, "a", "b").select(F.col("node").alias("set_id"), "root")


def _sets_and_links(rows: DataFrame, threshold: str, k: int) -> tuple[DataFrame, DataFrame]:
    """``doc_id``, ``n_shingles``, ``set_id`` of each row; ``set_id``, ``root`` of linked sets."""
    t = Fraction(threshold)
    read = kept(_shingle_sets(rows, k), "sets")
    sets = read.where("hot is null")
    keys = _shared_keys(_token_rows(rows, k, _hot_tokens(read)))
    per_set = keys.groupBy("set_id").agg(F.collect_list("key").alias("keys"))
    sizes = sets.where("set_id is not null").groupBy("set_id").agg(F.first("n_shingles").cast("int").alias("n"))
    return sets, linked_sets(_with_prefixes(per_set.join(sizes, "set_id"), t), t)


def jaccard_components(docs: DataFrame, threshold: str = "0.85", k: int = 4,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` for each row of ``docs``.

    Rows link when the Jaccard similarity of their sets of k-word shingles is ``threshold`` or
    more; ``component_id`` is the smallest doc_id that links reach, itself included. A null or
    empty text has no shingles, links with nothing and is its own component. Repeated rows give
    repeated results; a null doc_id stays null, takes part in links and gets the smallest id of
    its component, or null. An empty table gives an empty result.
    """
    sets, linked = _sets_and_links(texts(docs, id_col, text_col), threshold, k)
    smallest = sets.where("set_id is not null").groupBy("set_id").agg(F.min("doc_id").alias("least"))
    rooted = smallest.join(linked, "set_id", "left") \
        .withColumn("root", F.coalesce("root", "set_id"))
    of_root = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    components = rooted.join(of_root, "root").select("set_id", "component_id")
    out = sets.join(components, "set_id", "left")
    return out.select("doc_id", "n_shingles",
                      F.when(F.col("set_id").isNull(), F.col("doc_id"))
                      .otherwise(F.col("component_id")).alias("component_id"))


def one_per_component(docs: DataFrame, threshold: str = "0.85", k: int = 4,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id, null ids last.

    Rows without shingles all stay. Of rows with that id in one component the one with the smallest
    set id stays, and of rows that agree in id and set any one.
    """
    sets, linked = _sets_and_links(texts(docs, id_col, text_col), threshold, k)
    best = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "set_id")
    per_set = sets.where("set_id is not null").groupBy("set_id").agg(
        F.min(best).alias("best"), F.count("*").alias("rows"))
    per_set = per_set.join(linked, "set_id", "left").withColumn("root", F.coalesce("root", "set_id"))
    groups = per_set.groupBy("root").agg(F.min("best").alias("best"), F.sum("rows").alias("rows")) \
        .where("rows > 1")
    # Sets with more than one row in their component, and what decides about each of their rows.
    grouped = kept(per_set.select("set_id", "root").join(groups, "root").select(
        F.col("set_id").alias("member__"), (F.col("set_id") == F.col("best.set_id")).alias("wins__"),
        F.col("best.doc_id").alias("winner__")), "grouped")

    # Most rows are alone in their component and stay where they are; the rest is joined.
    sent = docs.sparkSession.sparkContext.broadcast(_bits_of(grouped, "member__"))
    at = docs.schema.fieldNames().index(text_col)
    schema = T.StructType([*docs.schema.fields, T.StructField("set__", T.LongType())])

    def rows_that(may_be_grouped: bool) -> DataFrame:
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = pa.array([_class_id(tokens) if len(tokens) else None for words in words_of(batch.column(at))
                                for _, tokens in shingles_of(words, k)], pa.int64())
                filled = ids.fill_null(0).to_numpy(zero_copy_only=False)
                chosen = _may_hold(sent.value, filled) & ids.is_valid().to_numpy(zero_copy_only=False)
                whole = pa.RecordBatch.from_arrays([*batch.columns, ids], [*batch.schema.names, "set__"])
                yield whole.filter(pa.array(chosen == may_be_grouped))
        return docs.mapInArrow(work, schema)

    some = kept(rows_that(True), "members")
    same_id = (F.col(f"`{id_col}`") <= F.col("winner__")) & (F.col(f"`{id_col}`") >= F.col("winner__")) \
        | F.col(f"`{id_col}`").isNull() & F.col("winner__").isNull()
    won = some.join(grouped.where("wins__"), F.col("set__") == F.col("member__")).where(same_id) \
        .dropDuplicates(["set__"]).drop("member__", "wins__", "winner__")
    alone = some.join(grouped, F.col("set__") == F.col("member__"), "left_anti")
    return rows_that(False).unionByName(won).unionByName(alone).drop("set__")


def _places(ids: np.ndarray) -> list[np.ndarray]:
    spread = mixed(ids.astype(np.uint64))
    return [(spread >> np.uint64(64 - _FILTER_BITS)).astype(np.int64),
            (spread & np.uint64((1 << _FILTER_BITS) - 1)).astype(np.int64)]


def _bits_of(df: DataFrame, column: str) -> np.ndarray:
    """A Bloom filter of the ids in a column, of 8 MB whatever their number."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = np.concatenate(_places(batch.column(0).to_numpy()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(places >> 5), pa.array(np.int64(1) << (places & 31))], ["part", "bits"])
    parts = df.select(column).mapInArrow(work, "part long, bits long").groupBy("part") \
        .agg(F.bit_or("bits").alias("bits")).toPandas()
    out = np.zeros(1 << (_FILTER_BITS - 5), np.uint32)
    out[parts["part"].to_numpy(np.int64)] = parts["bits"].to_numpy(np.int64).astype(np.uint32)
    return out


def _may_hold(bits: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Which ids may be in the filter; of those that are in it none is missed."""
    out = np.ones(len(ids), bool)
    for places in _places(ids):
        out &= bits[places >> 5] >> (places & 31).astype(np.uint32) & np.uint32(1) == 1
    return out
