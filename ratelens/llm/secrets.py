"""Secret scan: patterns, and strings that a battery of randomness tests takes for random.

Each run of 16 or more token characters with a letter and a digit is held against the smallest
alphabet, its encoding, that can spell it. Three tests ask whether it could be drawn evenly from
that alphabet: chi-squared over classes of the alphabet, runs above and below its middle, and
serial correlation of neighbours. Fisher's method joins the three p-values to one.

A string is a finding when its p-value reaches a cut. The cut belongs to its encoding and its
length, as short strings leave the tests little power. P-values of random strings are even between
0 and 1, so twice the number above one half estimates how many random strings there are; the cut is
the lowest at which at most ``rate`` of the strings that reach it are estimated not to be random.
The counts cover all texts and are a table of fixed size. They count distinct strings, so that copies
of one string do not decide for the others. Where an encoding and length has few strings, those of
the encoding, and of all encodings, fill up its counts.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ratelens.llm.tables import kept, texts

# The patterns findings are compared by, with the shortest length that counts.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                    r"""([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
LEAST_ASSIGNED = 12
KINDS = ("assign", "access", "hex", "random")

RUN = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")  # holds every run of 16 hex digits
DIGIT, LETTER = re.compile("[0-9]"), re.compile("[A-Za-z]")
DIGITS, LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
ENCODINGS = {
    "hex": DIGITS + "abcdef", "HEX": DIGITS + "ABCDEF", "base32": LOWER.upper() + "234567",
    "base36": DIGITS + LOWER, "BASE36": DIGITS + LOWER.upper(),
    "base62": DIGITS + LOWER.upper() + LOWER, "base64": LOWER.upper() + LOWER + DIGITS + "+/",
    "base64url": LOWER.upper() + LOWER + DIGITS + "-_",
}
_CODE = {name: np.full(128, -1) for name in ENCODINGS}
for _name, _letters in ENCODINGS.items():
    _CODE[_name][[ord(c) for c in _letters]] = np.arange(len(_letters))
CUTS = 100                      # steps of the p-value
PRIOR = 200                     # strings by which a wider group counts in a narrower one: so many that one
                                # more string moves no cut


def chi2_tail(x: float, freedom: int) -> float:
    """Probability that chi-squared with so many degrees of freedom is x or more."""
    half, total = x / 2, 0.0
    if freedom % 2 == 0:
        term = math.exp(-half)
        for i in range(freedom // 2):
            total += term
            term *= half / (i + 1)
        return min(1.0, total)
    total = math.erfc(math.sqrt(half))
    term = math.sqrt(half) * math.exp(-half) / math.gamma(1.5)
    for i in range((freedom - 1) // 2):
        total += term
        term *= half / (i + 1.5)
    return min(1.0, total)


def randomness(text: str) -> tuple[str, float] | None:
    """Encoding of a string and the p-value of the three tests; None if no encoding spells it."""
    body = text.rstrip("=")
    raw = np.frombuffer(body.encode(), np.uint8)
    for name, code in _CODE.items():
        values = code[raw]
        if values.min() >= 0:
            break
    else:
        return None
    k, n = len(ENCODINGS[name]), len(values)
    classes = max(2, min(k, n // 5))
    of_class = values * classes // k
    share = np.bincount(np.arange(k) * classes // k, minlength=classes) / k
    seen = np.bincount(of_class, minlength=classes)
    uniform = chi2_tail(float(((seen - n * share) ** 2 / (n * share)).sum()), classes - 1)

    high = values >= k / 2
    a, b = int(high.sum()), int(n - high.sum())
    if a and b:
        mean = 2 * a * b / n + 1
        spread = math.sqrt(max((mean - 1) * (mean - 2) / (n - 1), 1e-9))
        z = (1 + int((high[1:] != high[:-1]).sum()) - mean) / spread
        runs = math.erfc(abs(z) / math.sqrt(2))
    else:
        runs = 2.0 ** (1 - n)
    around = values - values.mean()
    power = float((around * around).sum())
    serial = float((around[1:] * around[:-1]).sum()) / power * math.sqrt(n) if power else math.inf
    serial = math.erfc(abs(serial) / math.sqrt(2))
    joint = -2 * sum(math.log(max(p, 1e-300)) for p in (uniform, runs, serial))
    return name, chi2_tail(joint, 6)


def _scan(text: str) -> tuple[list, list]:
    """Spans by pattern as (start, kind, end); candidates as (start, end, group, step, covered, name)."""
    runs = list(RUN.finditer(text))
    spans = [(h.start(), 2, h.end()) for m in runs for h in HEX.finditer(text, m.start(), m.end())]
    if ":" in text or "=" in text:
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text)
                  if len(m[2]) >= LEAST_ASSIGNED]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found = []
    for m in runs:
        if DIGIT.search(m[0]) and LETTER.search(m[0]) and (tested := randomness(m[0])):
            start, end = m.span()
            covered = any(s < end and start < e for s, _, e in spans)
            group = f"{tested[0]}/{min(len(m[0]) // 8, 16)}"
            name = int.from_bytes(hashlib.blake2b(m[0].encode(), digest_size=8).digest(), "little", signed=True)
            found.append((start, end, group, min(int(tested[1] * CUTS), CUTS - 1), covered, name))
    return sorted(spans), found


_SPAN = "start int, kind int, end int"
_FOUND = "start int, end int, group string, step int, covered boolean, name long"


def scanned(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``spans`` by pattern and ``found`` candidates of each row, without the text."""
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            results = [_scan(t) if t else ([], []) for t in batch["text"]]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].astype("Int64"),
                "spans": [[dict(zip(("start", "kind", "end"), s)) for s in r[0]] for r in results],
                "found": [[dict(zip(("start", "end", "group", "step", "covered", "name"), s)) for s in r[1]]
                          for r in results]})
    return docs.mapInPandas(
        work, f"doc_id long, spans array<struct<{_sql(_SPAN)}>>, found array<struct<{_sql(_FOUND)}>>")


def _sql(fields: str) -> str:
    return ", ".join(f"{n}: {t}" for n, t in (f.split(" ") for f in fields.split(", ")))


def cuts(found: DataFrame, rate: float) -> dict[str, int]:
    """For each encoding and length the lowest step at which findings are random enough.

    Each distinct string counts once, by its 64-bit name; copies meet before the shuffle. The counts
    have at most 8 encodings x 17 lengths x 100 steps. An encoding and length starts with ``PRIOR``
    strings spread as those of its encoding are, the encoding with as many spread as all strings
    are, and these with as many of which half fail the tests outright and half are random.
    """
    each = found.select(F.explode("found").alias("f")).select("f.group", "f.step", "f.name").distinct() \
        .groupBy("group", "step").count()
    steps: dict[str, np.ndarray] = {}
    for group, step, count in each.collect():
        steps.setdefault(group, np.zeros(CUTS))[step] = count
    every = np.full(CUTS, PRIOR / 2 / CUTS)
    every[0] += PRIOR / 2
    every = sum(steps.values(), start=every)
    of_encoding: dict[str, np.ndarray] = {}
    for group in sorted(steps):
        name = group.split("/")[0]
        of_encoding[name] = of_encoding.get(name, every * PRIOR / every.sum()) + steps[group]
    out = {}
    for group, counts in steps.items():
        wider = of_encoding[group.split("/")[0]]
        counts = counts + wider * PRIOR / wider.sum()
        random = 2 * counts[CUTS // 2:].sum()
        reach = counts[::-1].cumsum()[::-1]
        share = 1 - np.arange(CUTS) / CUTS
        wrong = 1 - np.minimum(random * share, reach) / reach
        fit = np.flatnonzero(wrong <= rate)
        if len(fit):
            out[group] = int(fit[0])
    return out


def _accepted(cut: dict[str, int]) -> Column:
    """Candidates that reach their cut and are no part or whole of a span by pattern."""
    table = F.create_map(*[F.lit(x) for pair in cut.items() for x in pair]) if cut else None

    def good(x: Column) -> Column:
        if table is None:
            return F.lit(False)
        return ~x["covered"] & (x["step"] >= F.coalesce(table[x["group"]], F.lit(CUTS)))
    return F.transform(F.filter("found", good), lambda x: F.struct(
        x["start"].alias("start"), F.lit(3).alias("kind"), x["end"].alias("end")))


def secret_spans(docs: DataFrame, rate: float = 0.05, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``spans`` (start, kind, end; code points, end exclusive) of each row.

    Kinds count as in ``KINDS``. ``rate`` is the share of wrong findings allowed among random
    strings of one encoding and length; strings that overlap a pattern's span add nothing. A null
    or empty text has no spans. Repeated rows give repeated results; an empty table an empty one.
    """
    found = kept(scanned(texts(docs, id_col, text_col)), "secrets")
    every = F.array_sort(F.concat("spans", _accepted(cuts(found, rate))))
    return found.select("doc_id", every.alias("spans"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", kinds[s["kind"]], s["start"], s["end"])), ",")


def secret_report(docs: DataFrame, rate: float = 0.05) -> DataFrame:
    """Counts by pattern, the digest of the patterns' spans and all spans of each row."""
    def count(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"] < 3)
    return secret_spans(docs, rate).select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        count(3).alias("n_random"), F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"))


def _masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with ``<kind>`` in place of each span; of overlapping spans the first is named."""
    out, at = [], 0
    for start, kind, end in sorted(spans):
        if end > at:
            out.append(text[at:start])
            if start >= at:
                out.append(f"<{KINDS[kind]}>")
            at = end
    return "".join([*out, text[at:]])


def mask_secrets(docs: DataFrame, rate: float = 0.05, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``docs`` with each secret in the text replaced by ``<kind>``; all other columns as they are.

    Texts without secrets, nulls and empty texts included, do not change.
    """
    cut = cuts(kept(scanned(texts(docs, id_col, text_col)).select("found"), "secrets"), rate)
    fields = docs.schema.fieldNames()
    at = fields.index(text_col)

    def clean(text: str | None) -> str | None:
        if not text:
            return text
        spans, found = _scan(text)
        more = [(s, 3, e) for s, e, group, step, covered, _ in found
                if not covered and step >= cut.get(group, CUTS)]
        return _masked(text, spans + more) if spans or more else text

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = pa.array([clean(t) for t in batch.column(at).to_pylist()], pa.string())
            yield batch.set_column(at, batch.schema.field(at).with_type(pa.string()), new)
    return docs.mapInArrow(work, docs.schema)
