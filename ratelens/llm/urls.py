"""URL filter: rules by host and path, and for the rest words of segmented names in naive Bayes.

Names in URLs are words written together. A unigram model of the words that URLs write apart
(between anything that is not a letter) gives each its probability; Viterbi splits a name into the
most probable words, where an unknown stretch costs more with each letter. The urls that a rule
decides teach a multinomial naive Bayes classifier which host and path words go with which verdict,
and it judges the urls that no rule fits.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

ALLOW, BLOCK = "allow", "block"
# Verdict, host, start of the path. The longest rule that fits decides.
RULES = (
    (BLOCK, "net", "/"),
    (ALLOW, "example.net", "/en/"),
    (BLOCK, "example.com", "/de/"),
    (ALLOW, "org", "/fr/"),
)
LEAST_SHARE = 1e-5              # of all words; rarer ones are not in the dictionary
LETTERS = re.compile("[a-z]+")
LONGEST_WORD = 24
NAMES_KEPT = 50_000             # segmented names that a task remembers


def parsed(url: Column) -> tuple[Column, Column]:
    """Host, A-Z in lower case, and path; empty for a null url or one without ``://``."""
    def part(group: int) -> Column:
        found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", group)
        return F.coalesce(found, F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(part(1), upper, upper.lower()), part(2)


def rule_of(host: Column, path: Column) -> tuple[Column, Column]:
    """The longest rule that fits, as host and path, and its verdict; null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, name, start in sorted(RULES, key=lambda r: len(r[1] + r[2])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        rule = F.when(fits, F.lit(name + start)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def _apart(host: str, path: str) -> list[str]:
    """The stretches of letters in host and path, host words marked."""
    return ["h:" + w for w in LETTERS.findall(host)] + ["p:" + w for w in LETTERS.findall(path.lower())]


def _pairs(batch: pa.RecordBatch) -> Iterator[tuple[str, str]]:
    return zip(batch.column("host").to_pylist(), batch.column("path").to_pylist())


def dictionary(urls: DataFrame) -> dict[str, float]:
    """Log probability of each word of the names that has ``LEAST_SHARE`` of all, so 100,000 at most."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            for host, path in _pairs(batch):
                counts.update(w[2:] for w in _apart(host, path))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                ["word", "times"])
    counts = urls.select("host", "path").mapInArrow(work, "word string, times long") \
        .groupBy("word").agg(F.sum("times").alias("times"))
    total = counts.agg(F.sum("times")).first()[0] or 0
    often = counts.where(F.col("times") >= LEAST_SHARE * total).collect()
    return {word: math.log(times / total) for word, times in often}


def segmented(name: str, words: dict[str, float]) -> list[str]:
    """The most probable split of a stretch of letters; ties go to the longer last word.

    A word's own probability would keep every name whole that occurs written together, so a name
    pays for each letter beyond four as if it were a further draw of a letter.
    """
    unknown = -12.0
    best, back = [0.0], [0]
    for end in range(1, len(name) + 1):
        top, at = -math.inf, 0
        for start in range(max(0, end - LONGEST_WORD), end):
            word = name[start:end]
            score = words.get(word, unknown - 4.0 * len(word)) - 2.0 * max(0, len(word) - 4)
            if best[start] + score > top:
                top, at = best[start] + score, start
        best.append(top)
        back.append(at)
    out, end = [], len(name)
    while end:
        out.append(name[back[end]:end])
        end = back[end]
    return out[::-1]


def _words(host: str, path: str, words: dict[str, float], memory: dict[str, list[str]]) -> list[str]:
    out = []
    for marked in _apart(host, path):
        split = memory.get(marked)
        if split is None:
            if len(memory) >= NAMES_KEPT:
                memory.clear()
            split = memory[marked] = [marked[:2] + w for w in segmented(marked[2:], words)]
        out += split
    return out


@dataclass
class Bayes:
    """Log odds of ``block`` against ``allow``: of a url without words, of each word, of others."""

    prior: float
    odds: dict[str, float]
    other: float

    def judge(self, words: list[str]) -> float:
        return self.prior + sum(self.odds.get(w, self.other) for w in words)


def learned(urls: DataFrame, words: dict[str, float]) -> Bayes:
    """From ``host``, ``path`` and the rules' ``verdict``. Words outside the dictionary are one word."""
    sent = urls.sparkSession.sparkContext.broadcast(words)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict[str, list[str]] = {}
        for batch in batches:
            counts: Counter = Counter()
            for (host, path), verdict in zip(_pairs(batch), batch.column("verdict").to_pylist()):
                counts[verdict, ""] += 1
                for w in _words(host, path, sent.value, memory):
                    counts[verdict, w if w[2:] in sent.value else "?"] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.string()),
                 pa.array(list(counts.values()), pa.int64())], ["verdict", "word", "times"])
    counts = urls.where("verdict is not null").select("host", "path", "verdict") \
        .mapInArrow(work, "verdict string, word string, times long") \
        .groupBy("verdict", "word").agg(F.sum("times").alias("times"))
    by: dict[str, dict[str, int]] = {ALLOW: {}, BLOCK: {}}
    for verdict, word, times in counts.collect():   # two rows a word of the dictionary
        by[verdict][word] = times
    urls_of = {k: v.pop("", 0) for k, v in by.items()}
    every = {*by[ALLOW], *by[BLOCK], "?"}
    total = {k: sum(v.values()) + len(every) for k, v in by.items()}

    def odds(word: str) -> float:
        return math.log((by[BLOCK].get(word, 0) + 1) / total[BLOCK]) - \
            math.log((by[ALLOW].get(word, 0) + 1) / total[ALLOW])
    prior = math.log((urls_of[BLOCK] + 1) / (urls_of[ALLOW] + 1))
    return Bayes(prior, {w: odds(w) for w in every if w != "?"}, odds("?"))


def judged_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``words``, ``odds`` of each row.

    ``rule`` is null where none fits; then the verdict is ``block`` when the log odds of the words
    are above 0. A null url and one without ``://`` have an empty host and path and no words, and
    get the verdict that is more frequent (a tie is ``allow``). Repeated rows give repeated results.
    """
    host, path = parsed(F.col(f"`{url_col}`").cast("string"))
    urls = pages.select(F.col(f"`{id_col}`").alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"))
    urls = urls.withColumns({"rule": rule, "verdict": verdict})
    words = dictionary(urls)
    sent = urls.sparkSession.sparkContext.broadcast((words, learned(urls, words)))

    def judge(batches):
        memory: dict[str, list[str]] = {}
        words, model = sent.value
        for hosts, paths in batches:
            split = [_words(h, p, words, memory) for h, p in zip(hosts, paths)]
            yield pd.DataFrame({
                "words": pd.Series([" ".join(w[2:] for w in s) for s in split], dtype=object),
                "odds": pd.Series([model.judge(s) for s in split], dtype=float)})
    judge.__annotations__ = {"batches": Iterator[tuple[pd.Series, pd.Series]],
                             "return": Iterator[pd.DataFrame]}
    score = F.pandas_udf(judge, "words string, odds double")
    out = urls.withColumn("judged", score("host", "path"))
    return out.select("page_id", "host", "path", "rule", F.coalesce(
        "verdict", F.when(F.col("judged.odds") > 0, BLOCK).otherwise(ALLOW)).alias("verdict"),
        "judged.words", "judged.odds")
