"""Licence scan: a trained paragraph classifier, confirmed against templates.

Paragraphs are the lines of a text. Their features are hashed 1- and 2-grams of words; only those
that occur in a licence template are features, so a paragraph is a sparse row. Softmax regression
with one class per licence family and one for anything else is fitted on the templates, whole and
damaged at random, and on a bounded sample of the corpus' own paragraphs. On held-out damaged
templates and corpus paragraphs the probabilities are calibrated: a temperature is fitted, and the
least probability that counts as an answer is set so that corpus paragraphs pass it at most once in
``1 / FALSE_RATE``. A paragraph that looks like a licence but passes for no family is ``unknown``.

Notices are sought in all stretches of words that hold enough of a template's 2-grams within the
template's length, wherever they stand in a block of lines up to an empty one: in longer text, over
line ends, several of them. Each stretch is classified by itself, and a family counts when a stretch
is confirmed by one of its templates. Sampled paragraphs with something near such a stretch teach
nothing, and no search depends on what the sample holds otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ratelens.llm.tables import texts
from ratelens.llm.words import Words, mixed, trimmed, words_of

# Notices of the families, as their stewards ask to write them.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License.",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation.",
        "Licensed under the GNU General Public License, version 2.",
    ),
    "LGPL": (
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software; you can redistribute it and/or modify it under the terms of "
        "the GNU Lesser General Public License as published by the Free Software Foundation.",
    ),
    "AGPL": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU Affero General Public License as published by the Free Software Foundation.",
    ),
    "BSD": (
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met.",
    ),
    "MPL-2.0": (
        "Licensed under the Mozilla Public License, Version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
        "License.",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International "
        "License.",
    ),
    "CC0": (
        "Released under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related or "
        "neighboring rights to this work.",
    ),
}
FAMILIES = sorted(TEMPLATES)
NONE, UNKNOWN = "none", "unknown"

SAMPLE_PARAGRAPHS = 4000        # of the corpus, to learn what is no licence
VARIANTS = 60                   # damaged copies of each template
FALSE_RATE = 1e-3
CONFIRMED = 0.6                 # share of 2-grams in common, of template and of paragraph part
RESEMBLES = 0.45                # the same share, from which a sampled paragraph may hold a notice
LIKE_LICENCE = 0.5              # share of known words from which a paragraph looks like one
_PAIR = np.uint64(0x9E3779B97F4A7C15)


def _grams(hashes: np.ndarray, line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """2-grams within a line, each with the place of its first word."""
    at = np.flatnonzero(line[1:] == line[:-1])
    return mixed(hashes[at] * _PAIR + hashes[at + 1]), at


def _hashed(lines: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Word hashes and 2-gram hashes of each line."""
    for words in words_of(pa.array(lines, pa.string())):
        hashes = trimmed(words).hashes()
        for i in range(len(words.first) - 1):
            own = hashes[words.first[i]:words.first[i + 1]]
            yield own, _grams(own, np.zeros(len(own), int))[0]


@dataclass
class Model:
    known: np.ndarray           # sorted hashes of the features
    weights: np.ndarray         # feature x class, log scale
    bias: np.ndarray
    classes: list[str]          # families, then none
    heat: float
    least: float                # probability that counts as an answer
    shapes: np.ndarray          # template x feature, and one that no template has: is it a 2-gram of it
    family: list[str]           # of each template

    def chances(self, scores: np.ndarray) -> np.ndarray:
        raised = scores / self.heat
        raised = np.exp(raised - raised.max(axis=1, keepdims=True))
        return raised / raised.sum(axis=1, keepdims=True)


def _find(known: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The feature of each hash, or -1."""
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return np.where(known[at] == hashes, at, -1)


def _shapes(known: np.ndarray) -> tuple[np.ndarray, list[str]]:
    """``shapes`` and ``family`` of the model."""
    shapes, family = [], []
    for name in FAMILIES:
        for _, grams in _hashed(list(TEMPLATES[name])):
            shapes.append(np.zeros(len(known) + 1, bool))
            shapes[-1][_find(known, grams)] = True
            family.append(name)
    return np.array(shapes), family


def _stretches(two: np.ndarray, shape: np.ndarray, least: float) -> Iterator[tuple[int, int, float]]:
    """Begin, end and share of the template's 2-grams of the stretches that hold ``least`` of them.

    ``two`` are consecutive 2-grams as features. Stretches are of about the template's length, do not
    overlap, begin and end with a 2-gram of the template, and the densest comes first.
    """
    size = max(1, int(shape.sum()))
    hit = shape[two]
    span = min(size + 2, len(two))
    while span:
        sums = np.concatenate([[0], np.cumsum(hit)])
        dense = sums[span:] - sums[:len(sums) - span]
        begin = int(dense.argmax())
        if dense[begin] < max(1, least * size):
            return
        inside = begin + np.flatnonzero(hit[begin:begin + span])
        yield int(inside[0]), int(inside[-1]) + 1, float(dense[begin] / size)
        hit = hit.copy()
        hit[begin:begin + span] = False


def _damaged(text: str, rng: np.random.Generator, other: list[str]) -> str:
    """A template with words lost, and words of the corpus around or inside."""
    words = [w for w in text.split() if rng.random() > 0.12] or text.split()
    if other and rng.random() < 0.5:
        strange = [other[i] for i in rng.integers(len(other), size=rng.integers(1, 12))]
        at = rng.integers(0, len(words) + 1) if rng.random() < 0.3 else (0, len(words))[rng.integers(2)]
        words[at:at] = strange
    return " ".join(words)


def _lines(docs: DataFrame, most: int) -> list[str]:
    """About ``most`` paragraphs, one each of documents chosen by hash; at most 2000 characters each."""
    share = min(1.0, most / max(docs.count(), 1))
    lines = F.filter(F.split("text", "\n"), lambda x: F.length(x) > 0)
    drawn = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < int(share * (1 << 30))) \
        .select(lines.alias("lines"), F.xxhash64("text", "doc_id").alias("draw")).where(F.size("lines") > 0)
    line = F.element_at("lines", F.pmod(F.col("draw"), F.size("lines")).cast("int") + 1)
    chosen = drawn.select("draw", F.substring(line, 1, 2000).alias("line")).orderBy("draw", "line")
    return [r["line"] for r in chosen.limit(2 * most).collect()]


def fit(docs: DataFrame, seed: int = 7) -> Model:
    """The classifier for the corpus ``doc_id``, ``text``. Sizes depend on the parameters only."""
    rng = np.random.default_rng(seed)
    corpus = _lines(docs.where("text is not null"), SAMPLE_PARAGRAPHS)
    other = [w for line in corpus[:500] for w in line.split()][:5000]
    rows, labels = [], []
    for c, family in enumerate(FAMILIES):
        for text in TEMPLATES[family]:
            variants = [text] + [_damaged(text, rng, other) for _ in range(VARIANTS)]
            rows += variants
            labels += [c] * len(variants)
    licence_words = {w.lower() for ts in TEMPLATES.values() for t in ts for w in t.split()}
    clean = [x for x in corpus if sum(w.lower() in licence_words for w in x.split()) < 0.5 * len(x.split())]
    known = np.unique(np.concatenate([h for ts in TEMPLATES.values() for pair in _hashed(list(ts))
                                      for h in pair]))
    shapes, family = _shapes(known)
    near = [any(next(_stretches(two, shape, RESEMBLES), None) for shape in shapes)
            for two in (_find(known, grams) for _, grams in _hashed(clean))]
    clean = [x for x, held in zip(clean, near) if not held]
    rows += clean
    labels += [len(FAMILIES)] * len(clean)
    labels = np.array(labels)
    holds = np.zeros((len(rows), len(known)), np.float32)
    for i, pair in enumerate(_hashed(rows)):
        found = _find(known, np.concatenate(pair))
        holds[i, found[found >= 0]] = 1
    held_out = rng.random(len(rows)) < 0.25
    x, y = holds[~held_out], labels[~held_out]
    n_classes = len(FAMILIES) + 1
    weight = (1 / np.maximum(np.bincount(y, minlength=n_classes), 1))[y][:, None].astype(np.float32)
    weight /= weight.sum()
    target = np.eye(n_classes, dtype=np.float32)[y]
    w, b = np.zeros((len(known), n_classes), np.float32), np.zeros(n_classes, np.float32)
    speed, push, push_b = np.float32(4.0), 0 * w, 0 * b
    for _ in range(300):
        scores = x @ w + b
        scores = np.exp(scores - scores.max(axis=1, keepdims=True))
        off = weight * (scores / scores.sum(axis=1, keepdims=True) - target)
        push = 0.9 * push - speed * (x.T @ off + 1e-5 * w)
        push_b = 0.9 * push_b - speed * off.sum(axis=0)
        w, b = w + push, b + push_b
    model = Model(known, w, b, [*FAMILIES, NONE], 1.0, 0.5, shapes, family)
    # Temperature and least probability, on what the fit has not seen.
    scores, truth = holds[held_out] @ w + b, labels[held_out]

    def loss(heat: float) -> float:
        model.heat = heat
        return -float(np.log(np.maximum(model.chances(scores)[np.arange(len(truth)), truth], 1e-9)).sum())
    if len(truth):
        model.heat = min((0.5 * 1.2 ** i for i in range(16)), key=loss)
        of_corpus = model.chances(scores)[truth == len(FAMILIES), :-1].max(axis=1, initial=0)
        if len(of_corpus):
            model.least = max(0.5, float(np.quantile(of_corpus, 1 - FALSE_RATE)))
    return model


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_paragraphs``, ``licences``, ``found`` for each row.

    ``found`` lists family, paragraph (from 0; where it begins), probability and similarity of each finding;
    ``licences`` the confirmed families, sorted, and ``unknown`` where something looks like a licence
    of no family. A null or empty text has no paragraphs. Repeated rows give repeated results.
    """
    docs = texts(docs, id_col, text_col)
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs))
    schema = ("doc_id long, n_paragraphs long, licences array<string>, "
              "found array<struct<family: string, paragraph: int, probability: double, "
              "similarity: double>>")
    kinds = [pa.int64(), pa.list_(pa.string()), pa.list_(pa.struct([
        ("family", pa.string()), ("paragraph", pa.int32()), ("probability", pa.float64()),
        ("similarity", pa.float64())]))]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in words_of(batch.column("text")):
                many, found = _scanned(words, sent.value)
                names = [sorted({f["family"] for f in x}) for x in found]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[words.rows], *(pa.array(v, k) for v, k in zip(
                        (many, names, found), kinds))],
                    ["doc_id", "n_paragraphs", "licences", "found"])
    return docs.mapInArrow(work, schema)


def _scanned(words: Words, model: Model) -> tuple[list[int], list[list[dict]]]:
    """Paragraphs of each row, and its findings."""
    rows = len(words.first) - 1
    found: list[list[dict]] = [[] for _ in range(rows)]
    if not len(words.begin):
        return [0] * rows, found
    # A line's number counts over the whole chunk; a row starts a new line.
    feeds = np.flatnonzero(words.data == 10)
    row = np.repeat(np.arange(rows), np.diff(words.first))
    line = np.searchsorted(feeds, words.begin) + row
    new = np.ones(len(line), bool)
    new[1:] = line[1:] != line[:-1]
    begin = np.flatnonzero(new)
    paragraph = np.cumsum(new) - 1
    many = np.bincount(row[begin], minlength=rows)
    first_of_row = np.cumsum(many) - many
    # A block ends at an empty line, or with its row.
    apart = np.zeros(len(line), bool)
    apart[1:] = (line[1:] - line[:-1] > 1) | (row[1:] != row[:-1])
    block = np.cumsum(apart)
    hashes = trimmed(words).hashes()
    pairs, at = _grams(hashes, block)
    one, two = _find(model.known, hashes), _find(model.known, pairs)
    seen = np.flatnonzero(two >= 0)
    if not len(seen):
        return many.tolist(), found

    def chances(of: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        holds = np.zeros((len(of), len(model.known)), np.float32)
        for i, own in enumerate(of):
            own = np.concatenate(own)
            holds[i, own[own >= 0]] = 1
        return model.chances(holds @ model.weights + model.bias)

    # No stretch of a block holds more of a template than the block.
    places = []
    of_block = block[at]
    limit = np.searchsorted(of_block, np.arange(block[-1] + 2))
    for t, shape in enumerate(model.shapes):
        held = np.bincount(of_block[seen], weights=shape[two[seen]], minlength=block[-1] + 1)
        for i in np.flatnonzero(held >= max(1, CONFIRMED * shape.sum())):
            low = limit[i]
            for a, b, alike in _stretches(two[low:limit[i + 1]], shape, CONFIRMED):
                places.append((low + a, low + b, t, alike))
    named: dict[tuple[int, str], tuple[float, float]] = {}
    taken = set()
    if places:
        chance = chances([(one[at[a]:at[b - 1] + 2], two[a:b]) for a, b, _, _ in places])
        for i, (a, b, t, alike) in enumerate(places):
            best = int(chance[i, :-1].argmax())
            if model.classes[best] == model.family[t] and chance[i, best] >= model.least:
                key = int(paragraph[at[a]]), model.family[t]
                named[key] = max(named.get(key, (0.0, 0.0)), (float(chance[i, best]), alike))
                taken.update(range(key[0], int(paragraph[at[b - 1] + 1]) + 1))
    for (p, family), (chance, alike) in named.items():
        found[int(row[begin[p]])].append({"family": family, "paragraph": int(p - first_of_row[row[begin[p]]]),
                                          "probability": round(chance, 6), "similarity": round(alike, 6)})
    # Paragraphs that look like a licence as a whole.
    bounds = np.append(begin, len(line))
    share = np.add.reduceat((one >= 0).astype(float), begin) / np.diff(bounds)
    inside = seen[paragraph[at[seen]] == paragraph[at[seen] + 1]]
    hint = np.zeros(len(begin), bool)
    hint[paragraph[at[inside]]] = True
    chosen = [p for p in np.flatnonzero(hint & (share >= LIKE_LICENCE)) if p not in taken]
    if chosen:
        spans = [np.searchsorted(at, [bounds[p], bounds[p + 1] - 1]) for p in chosen]
        chance = chances([(one[bounds[p]:bounds[p + 1]], two[a:b]) for p, (a, b) in zip(chosen, spans)])
        for i, p in enumerate(chosen):
            if 1 - chance[i, -1] >= model.least:
                best = int(chance[i, :-1].argmax())
                a, b = spans[i]
                alike = max((x for t, shape in enumerate(model.shapes) if model.family[t] == model.classes[best]
                             for _, _, x in _stretches(two[a:b], shape, 0)), default=0.0)
                found[int(row[begin[p]])].append({
                    "family": UNKNOWN, "paragraph": int(p - first_of_row[row[begin[p]]]),
                    "probability": round(float(chance[i, best]), 6), "similarity": round(alike, 6)})
    for each in found:
        each.sort(key=lambda f: (f["paragraph"], f["family"]))
    return many.tolist(), found
