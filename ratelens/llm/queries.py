"""The operators of this folder as registered queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ratelens.llm.alignment import aligned_documents
from ratelens.llm.brown import scores
from ratelens.llm.byte_tokens import encoding_digests
from ratelens.llm.decontamination import leaks
from ratelens.llm.jaccard import jaccard_components
from ratelens.llm.language import language_report
from ratelens.llm.licenses import scan
from ratelens.llm.pieces import encoding_report
from ratelens.llm.pii import with_surrogates
from ratelens.llm.quality import quality_report
from ratelens.llm.ranked import ranked_documents
from ratelens.llm.secrets import secret_report
from ratelens.llm.tables import table
from ratelens.llm.urls import judged_urls

Query = Callable[[SparkSession, str], DataFrame]


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_report(table(spark, sf_dir, "documents"))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), "0.85", 4)


def op6_brown_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(table(spark, sf_dir, "documents"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding_report(table(spark, sf_dir, "documents"))


def op8_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_surrogates(table(spark, sf_dir, "documents"), key="replace this key in production")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged_urls(table(spark, sf_dir, "pages"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding_digests(table(spark, sf_dir, "documents"),
                            public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 20)


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aligned_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                             public_tokenizers.path("piece_bpe_32k.model"))


QUERIES: dict[str, Query] = {
    "op1_license_scan": op1_license_scan,
    "op2_secret_scan": op2_secret_scan,
    "op3_quality_rules": op3_quality_rules,
    "op4_language_id": op4_language_id,
    "op5_ngram_jaccard": op5_ngram_jaccard,
    "op6_brown_scores": op6_brown_scores,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_pii_surrogates": op8_pii_surrogates,
    "op9_decontamination": op9_decontamination,
    "op10_url_filter": op10_url_filter,
    "op11_byte_bpe": op11_byte_bpe,
    "op12_ranked_search": op12_ranked_search,
    "op13_tokenizer_alignment": op13_tokenizer_alignment,
}
# For each query that SQL can express on whole tables. Components: every document starts at its
# own id and reaches what linked pairs lead to.
SQL: dict[str, str] = {
    "op3_quality_rules": r"""
        with words as (
            select doc_id, coalesce(text, '') as t,
                   list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                               lambda x: x <> '') as w,
                   list_filter(string_split(coalesce(text, ''), chr(10)),
                               lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l
            from documents),
        windows as (
            select doc_id, unnest(range(1, len(w) - 6)) as place,
                   unnest(list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i + 7], ' '))) as s
            from words where len(w) >= 8),
        again as (select doc_id, place from windows
                  qualify count(*) over (partition by doc_id, s) > 1),
        covered as (
            select doc_id, count(distinct place + k) as n_repeat_words
            from again, range(8) as r(k) group by doc_id),
        measured as (
            select doc_id, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
                   length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols,
                   length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) as n_capitals,
                   length(t) - length(replace(t, '!', '')) as n_exclamations,
                   len(l) as n_lines, len(l) - len(list_distinct(l)) as n_dup_lines,
                   len(list_distinct(w)) as n_distinct_words,
                   coalesce(n_repeat_words, 0) as n_repeat_words
            from words left join covered using (doc_id)),
        failing as (
            select *, cast(
                (n_words < 20)::int + 2 * (100 * n_repeat_words > 30 * n_words)::int
                + 4 * (5 * n_symbols > n_words)::int + 8 * (2 * n_capitals > word_chars)::int
                + 16 * (10 * n_exclamations > 3 * n_words)::int
                + 32 * (100 * n_distinct_words < 35 * n_words)::int
                + 64 * (2 * n_dup_lines > n_lines)::int
                + 128 * (word_chars > 15 * n_words or word_chars < 2 * n_words)::int
                as bigint) as failed
            from measured)
        select *, failed & 3 <> 0 as base_failed, failed = 0 as kept from failing
    """,
    "op5_ngram_jaccard": """
        with recursive words as (
            select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w
            from documents),
        shingles as (
            select distinct doc_id, unnest(case when len(w) = 0 then []
                when len(w) < 4 then [array_to_string(w, ' ')]
                else list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
                end) as s
            from words),
        sizes as (select doc_id, count(*) as n from shingles group by doc_id),
        shared as (
            select a.doc_id as x, b.doc_id as y, count(*) as k
            from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by all),
        linked as (
            select x, y from shared join sizes p on p.doc_id = x join sizes q on q.doc_id = y
            where 100 * k >= 85 * (p.n + q.n - k)),
        edges as (select x, y from linked union all select y, x from linked),
        reach as (
            select doc_id as x, doc_id as y from documents
            union select r.x, e.y from reach r join edges e on r.y = e.x)
        select d.doc_id, coalesce(n, 0) as n_shingles, least as component_id
        from documents d left join sizes using (doc_id)
        join (select x as doc_id, min(y) as least from reach group by x) using (doc_id)
    """,
    "op12_ranked_search": r"""
        with terms as (
            select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
            from documents where text is not null),
        held as (select doc_id, term, count(*) as tf from terms group by all),
        lengths as (select doc_id, sum(tf)::bigint as n from held group by doc_id),
        corpus as (select count(*) as d, sum(n)::bigint as l from lengths),
        weights as (
            select term, floor(1000 * ln((2 * d + 2)::double / (2 * count(*) + 1)))::bigint as w
            from held, corpus group by term, d),
        asked as (
            select item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
            from benchmark where text is not null),
        scored as (
            select item_id, doc_id, sum(w * ((1000000000 * tf)
                // (1000 * tf + 12 * (75 + (25 * n * d) // l))))::bigint as score
            from asked join held using (term) join weights using (term) join lengths using (doc_id), corpus
            group by item_id, doc_id)
        select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank,
               doc_id, score
        from scored where score > 0
        qualify row_number() over (partition by item_id order by score desc, doc_id) <= 20
    """,
}
