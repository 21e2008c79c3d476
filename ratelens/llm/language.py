"""Language identification by a string kernel with landmarks and kernel ridge regression.

A text's features are the 1- to 3-grams of its letters, in lower case, with anything else as one
blank; each n-gram is hashed to one of ``BUCKETS`` places and only its presence counts. The kernel
of two texts is the number of places both have, over the root of the product of their numbers
(blended-spectrum presence kernel). Nystroem's method replaces the kernel matrix by the columns of
a few landmark texts; on these features one ridge regression per language separates it from the
rest. A batch of texts is scored by two matrix products: with the landmarks, then with the weights.

Whether a text is in a learned language at all is decided apart from the hashed places, which texts
of any language share: by its distinct 3-grams as they are, and how many of them the sampled texts of
the predicted language have. The least share for a language is set on its sampled texts, each held
against the others, so that ``FALSE_REJECTION`` of them fall below it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ratelens.llm.tables import texts

BUCKETS = 1 << 14
UNKNOWN = "und"
PER_LANGUAGE = 400              # labelled texts of a language that the model is fitted on
LANDMARKS = 32                  # of them, those that span the kernel's features
RIDGE = 1e-3
FALSE_REJECTION = 0.005         # share of a learned language's texts that may count as in none
_tables: dict[str, np.ndarray] = {}


def _plain() -> np.ndarray:
    """For each code point its lower-case letter, or a blank."""
    if "plain" not in _tables:
        points = [chr(i) if not 0xD800 <= i < 0xE000 else " " for i in range(0x110000)]
        lower = [c.lower() if c.isalpha() else " " for c in points]
        _tables["plain"] = np.array([ord(x[0]) for x in lower], np.uint32)
    return _tables["plain"]


def _codes(text: str) -> np.ndarray | None:
    """The text's letters with one blank for anything else, and at both ends; None without a letter."""
    codes = _plain()[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]
    letter = codes != 32
    if not letter.any():
        return None
    same = letter.copy()
    same[1:] |= letter[:-1]                      # one blank stands for many
    return np.concatenate([[np.uint32(32)], codes[same], [np.uint32(32)]]).astype(np.uint32)


def features(codes: np.ndarray) -> np.ndarray:
    """The places of the n-grams, as booleans."""
    held = np.zeros(BUCKETS, bool)
    gram = np.zeros(len(codes), np.uint32)
    for order in range(3):
        gram = gram[:len(codes) - order] * np.uint32(0x01000193) + codes[order:]
        spread = (gram ^ np.uint32(order << 29)) * np.uint32(0x9E3779B1)
        held[spread >> np.uint32(32 - 14)] = True
    return held


def trigrams(codes: np.ndarray) -> np.ndarray:
    """The distinct 3-grams, sorted, each as one number that no other 3-gram has."""
    wide = codes.astype(np.uint64)
    blank = wide == 32
    wide = wide[~blank | ~np.append(False, blank[:-1])]
    return np.unique(wide[:-2] << np.uint64(42) | wide[1:-1] << np.uint64(21) | wide[2:])


def share_of(grams: np.ndarray, vocabulary: np.ndarray) -> float:
    """The share of ``grams`` that are in the sorted ``vocabulary``."""
    at = np.minimum(np.searchsorted(vocabulary, grams), len(vocabulary) - 1)
    return float((vocabulary[at] == grams).mean())


@dataclass
class Model:
    languages: list[str]
    landmarks: np.ndarray       # landmark x bucket, 0 or 1 over the root of its number
    weights: np.ndarray         # landmark x language
    scale: float                # of the scores, for the probability
    grams: list[np.ndarray]     # per language: the 3-grams of its sampled texts, sorted
    least: list[float]          # per language: the share of a text's 3-grams from which it is in it

    def scores(self, held: np.ndarray) -> np.ndarray:
        """One score for each text and language. ``held``: text x bucket."""
        size = np.sqrt(np.maximum(held.sum(axis=1, keepdims=True), 1))
        return (held.astype(np.float32) @ self.landmarks.T / size) @ self.weights

    def chances(self, scores: np.ndarray) -> np.ndarray:
        raised = np.exp(self.scale * (scores - scores.max(axis=1, keepdims=True)))
        return raised / raised.sum(axis=1, keepdims=True)


def _sample(labelled: DataFrame, per_language: int) -> pd.DataFrame:
    """At most ``per_language`` texts of each language, as packed features, chosen by hash.

    Of the rows only counts by language and the features of that many texts reach the driver.
    """
    counts = dict(labelled.groupBy("lang").count().collect())
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    share = [(lang, min(1.0, 1.5 * per_language / n)) for lang, n in sorted(counts.items())]
    chosen = labelled.sparkSession.createDataFrame(share, "lang string, share double")
    drawn = labelled.withColumn("draw", draw).join(F.broadcast(chosen), "lang").where("draw < share")

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            codes = [_codes(t) for t in batch["text"]]
            yield pd.DataFrame({
                "lang": batch["lang"].astype(object), "draw": batch["draw"],
                "bits": pd.Series([None if c is None else np.packbits(features(c)).tobytes()
                                   for c in codes], dtype=object),
                "grams": pd.Series([None if c is None else trigrams(c).tobytes() for c in codes],
                                   dtype=object)})
    bits = drawn.mapInPandas(work, "lang string, draw double, bits binary, grams binary") \
        .where("bits is not null")
    rows = bits.toPandas().sort_values(["lang", "draw", "bits"])
    return rows.groupby("lang").head(per_language)


def _lowest(shares: np.ndarray) -> float | None:
    """The least of the shares that counts, or None: too few to tell ``FALSE_REJECTION`` of them."""
    below = int(FALSE_REJECTION * (len(shares) + 1))
    return float(np.sort(shares)[below - 1]) if below else None


def _vocabularies(rows: pd.DataFrame, names: list[str]) -> tuple[list[np.ndarray], list[float]]:
    """``grams`` and ``least`` of the model.

    Copies count once, as they would vouch for each other. A language with too few texts for the rate
    takes the cut of all languages' texts together, and if those are too few, their lowest share.
    """
    grams, shares = [], []
    for name in names:
        each = [np.frombuffer(b, np.uint64) for b in rows.loc[rows["lang"] == name, "grams"].unique()]
        vocabulary, times = np.unique(np.concatenate(each), return_counts=True)
        grams.append(vocabulary)
        shares.append(np.array([share_of(g, np.append(vocabulary[times > 1], np.uint64((1 << 64) - 1)))
                                for g in each]))
    every = np.concatenate(shares)
    together = _lowest(every)
    together = float(every.min()) if together is None else together
    own = [_lowest(s) for s in shares]
    return grams, [together if least is None else least for least in own]


def fit(labelled: DataFrame, per_language: int = PER_LANGUAGE, landmarks: int = LANDMARKS) -> Model | None:
    """A model from ``doc_id``, ``text``, ``lang``; None when no text has both letter and language."""
    rows = _sample(labelled.where("lang is not null and text is not null"), per_language)
    if rows.empty:
        return None
    held = np.array([np.unpackbits(np.frombuffer(b, np.uint8)) for b in rows["bits"]], np.uint8)
    names = sorted(rows["lang"].unique())
    chosen = rows.reset_index(drop=True).groupby("lang").head(landmarks).index.to_numpy()
    marks = held[chosen].astype(np.float32)
    marks /= np.sqrt(marks.sum(axis=1, keepdims=True))
    size = np.sqrt(held.sum(axis=1, dtype=np.float64, keepdims=True))
    near = (held.astype(np.float32) @ marks.T).astype(np.float64) / size
    # Nystroem: with K = near, M = kernel of the landmarks, features are K M^(-1/2).
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    plain = near @ root
    target = np.where(rows["lang"].to_numpy()[:, None] == np.array(names)[None, :], 1.0, -1.0)
    weight = 1 / rows.groupby("lang")["lang"].transform("count").to_numpy(float)[:, None]
    left = plain.T @ (weight * plain) + RIDGE * len(names) * np.eye(plain.shape[1])
    weights = root @ np.linalg.solve(left, plain.T @ (weight * target))
    model = Model(names, marks, weights.astype(np.float32), 1.0, *_vocabularies(rows, names))
    scores, right = near @ weights, target > 0

    def loss(scale: float) -> float:
        model.scale = scale
        return float(-(np.log(np.maximum(model.chances(scores)[right], 1e-12)) * weight[:, 0]).sum())
    model.scale = min((0.5 * 1.25 ** i for i in range(16)), key=loss)
    return model


def identify(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``known`` instead of columns of those names.

    ``known`` is the share of the text's distinct 3-grams that sampled texts of ``lang_pred`` have. A null text, one without a
    letter, or any text when there is no model, is ``und`` with score 0 and known 0.
    """
    docs = docs.drop("lang_pred", "score", "known")
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(model)   # languages x landmarks x buckets, of fixed size

    def judged(texts: pd.Series) -> pd.DataFrame:
        model = sent.value
        names, chance, known = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
        rows, held, grams = [], [], []

        def score() -> None:
            if rows:
                every = np.array(held)
                odds = model.chances(model.scores(every))
                best = odds.argmax(axis=1)
                chance[rows] = odds[np.arange(len(rows)), best]
                known[rows] = [share_of(g, model.grams[i]) for g, i in zip(grams, best)]
                for row, i in zip(rows, best):
                    names[row] = model.languages[i]
                rows.clear()
                held.clear()
                grams.clear()
        for row, text in enumerate(texts):
            codes = _codes(text) if model and text else None
            if codes is not None:
                rows.append(row)
                held.append(features(codes))
                grams.append(trigrams(codes))
                if len(rows) == 64:
                    score()
        score()
        return pd.DataFrame({"lang_pred": pd.Series(names, dtype=object), "score": chance, "known": known})

    # Else a filter on the result would have every text judged twice.
    judge = F.pandas_udf(judged, "lang_pred string, score double, known double").asNondeterministic()
    out = docs.withColumn("judged__", judge(F.col(f"`{text_col}`").cast("string")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], "judged__.*")


def in_language(model: Model | None) -> Column:
    """Whether a row that ``identify`` judged by the model is in the language predicted for it."""
    fits = F.lit(False)
    for name, least in zip(model.languages, model.least) if model else ():
        fits |= (F.col("lang_pred") == name) & (F.col("known") >= least)
    return fits & (F.col("lang_pred") != UNKNOWN)


def held_out() -> Column:
    """Whether a row is kept from learning, by its ``doc_id`` alone. A null id is never held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def learned(docs: DataFrame) -> Model | None:
    """The model of the rows of ``doc_id``, ``text``, ``lang`` that are not held out."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    return fit(rows.where(~held_out()))


def language_report(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score``, ``known`` of each row.

    Null and repeated ids are judged like any others; an empty table gives an empty result.
    """
    return identify(texts(docs), learned(docs)).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score", "known")
