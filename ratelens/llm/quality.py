r"""Quality rules as a ledger: measure once, keep the failure of every rule as a bit, decide later.

``ledger`` reads the texts once and stores, for each row, all measurements and one bit per rule that
fails. Policies are versions of a mask over these bits; applying one, or asking what each of its
rules alone removes, reads only the ledger. Words are runs of characters other than 0x20 and
0x09-0x0D. Built-in functions only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ratelens.llm import tables

BLANK = "\x20\t\n\x0b\x0c\r"
WINDOW = 8

# Rule: bit and condition on the measurements. Bits are never given to another rule.
RULES: dict[str, tuple[int, str]] = {
    "few_words": (0, "n_words < 20"),
    "repeated_windows": (1, "100 * n_repeat_words > 30 * n_words"),
    "symbols": (2, "5 * n_symbols > n_words"),
    "capitals": (3, "2 * n_capitals > word_chars"),
    "exclamations": (4, "10 * n_exclamations > 3 * n_words"),
    "few_distinct_words": (5, "100 * n_distinct_words < 35 * n_words"),
    "repeated_lines": (6, "2 * n_dup_lines > n_lines"),
    "word_length": (7, "word_chars > 15 * n_words or word_chars < 2 * n_words"),
}
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_windows"),
    "1": ("few_words", "repeated_windows", "symbols", "repeated_lines"),
    "2": tuple(RULES),
}
CURRENT = "2"


def mask(rules: tuple[str, ...] | list[str]) -> int:
    return reduce(int.__or__, (1 << RULES[r][0] for r in rules), 0)


def _repeat_words() -> Column:
    """Words in windows that occur twice or more, from sorted window starts in ``again``."""
    steps = F.transform("again", lambda at, i: F.least(
        F.lit(WINDOW), F.coalesce(F.get("again", i + 1) - at, F.lit(WINDOW))))
    return F.aggregate(steps, F.lit(0).cast("long"), lambda total, x: total + x)


def measured(rows: DataFrame) -> DataFrame:
    """The measurements of ``text``, in place of it."""
    text = F.coalesce(F.col("text"), F.lit(""))
    trimmed = F.btrim(text, F.lit(BLANK))
    words = F.when(trimmed == "", F.array().cast("array<string>")) \
        .otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANK)) != "")

    first = rows.select(
        "doc_id", words.alias("words"), lines.alias("lines"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count(text, F.lit("[A-Z]")).cast("long").alias("n_capitals"),
        F.regexp_count(text, F.lit("!")).cast("long").alias("n_exclamations"))
    counted = first.select(
        "doc_id", "n_symbols", "n_capitals", "n_exclamations",
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    # A window is known by the hash of its words' hashes; those that reach past the end go.
    windows = F.transform("hashes", lambda h, i: F.xxhash64(
        h, *[F.get("hashes", i + k) for k in range(1, WINDOW)]))
    whole = F.slice(windows, F.lit(1), F.greatest(F.size("hashes") - (WINDOW - 1), F.lit(0)))
    windowed = counted.select(
        "*", F.size(F.array_distinct("hashes")).cast("long").alias("n_distinct_words"),
        whole.alias("windows")).drop("hashes")
    # Only texts that repeat a window are sorted to find where.
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    sorted_ = windowed.withColumn("windows", F.when(repeats, F.sort_array(
        F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("at"))))))
    twice = F.filter("windows", lambda w, i: (F.get("windows", i + 1)["h"] == w["h"])
                     | (F.get("windows", i - 1)["h"] == w["h"]))
    starts = sorted_.withColumn("again", F.sort_array(F.transform(twice, lambda w: w["at"]))) \
        .drop("windows")
    return starts.withColumn("n_repeat_words", F.coalesce(_repeat_words(), F.lit(0).cast("long"))) \
        .drop("again")


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, every measurement, and ``failed``: one bit for each rule that fails.

    The ledger is a table in the shared folder, so that no filter on it measures a text again. A null
    text counts as empty: no words, all measurements 0. Repeated rows give repeated results.
    """
    return tables.kept(_failures(measured(tables.texts(docs, id_col, text_col))), "ledger")


def _failures(rows: DataFrame) -> DataFrame:
    bits = [F.when(F.expr(f"({condition})"), F.lit(1 << bit)).otherwise(0).cast("long")
            for bit, condition in RULES.values()]
    return rows.withColumn("failed", reduce(lambda a, b: a.bitwiseOR(b), bits))


def kept(policy: str = CURRENT) -> Column:
    """Whether a row of the ledger passes all rules of a policy."""
    return F.col("failed").bitwiseAND(F.lit(mask(POLICIES[policy])).cast("long")) == 0


def ablations(rows: DataFrame, policy: str = CURRENT) -> DataFrame:
    """For each rule of a policy: rows that fail it, and rows that would stay if it were left out.

    The ledger is brought down to one count per pattern of failed bits before anything else.
    """
    all_bits = F.lit(mask(POLICIES[policy])).cast("long")
    patterns = rows.groupBy(F.col("failed").bitwiseAND(all_bits).alias("bits")) \
        .agg(F.count("*").alias("times"))
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << RULES[r][0]).cast("long").alias("bit"))
                      for r in POLICIES[policy]])
    each = patterns.withColumn("of", F.explode(rules))
    failing = F.col("bits").bitwiseAND(F.col("of.bit")) != 0
    return each.groupBy(F.col("of.rule").alias("rule")).agg(
        F.coalesce(F.sum(F.when(failing, F.col("times"))), F.lit(0)).alias("n_failed"),
        F.coalesce(F.sum(F.when(F.col("bits") == F.col("of.bit"), F.col("times"))), F.lit(0))
        .alias("n_only_this"))


def quality_report(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The ledger with ``base_failed`` and ``kept`` under a policy."""
    return ledger(docs).select("*", (~kept("base")).alias("base_failed"),
                               (kept("base") & kept(policy)).alias("kept"))
