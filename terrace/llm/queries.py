"""Registered queries of the operators in this subpackage, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm import (
    alignment, decontaminate, language, mixture, neighbours, pii, quality_rules, simhash, substrings, suffixes, token_files, url_rules, whitening,
)
from terrace.llm.arrays import crc_mod
from terrace.session import scratch_path
from terrace.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: Rules for all hosts: host and path as written, verdict.
URL_RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
TOKENIZER, END_ID = "word_bpe_49k.json", 2


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return add


@query()
def op1_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    return url_rules.judge_urls(table(spark, folder, "pages"), table(spark, folder, "labels"), URL_RULES)


def quality_sql() -> str:
    """The same measures by words and windows as rows; thresholds and word list are those of the rules."""
    stops = ", ".join(f"'{w}'" for w in quality_rules.STOP_WORDS)
    tests = []
    ratio = {
        "symbol_ratio": "n_symbols / n_words", "exclamation_ratio": "bangs / n_words", "capital_ratio": "capitals / word_chars",
        "mean_word_chars": "word_chars / n_words", "stop_ratio": "stops / n_words", "dup_line_ratio": "n_dup_lines / n_lines",
        "repeat_ratio": "n_repeat_words / n_words",
    }
    for rule in quality_rules.RULES:
        outside = [f"{ratio[rule.measure]} {sign} {bound}" for sign, bound in (("<", rule.low), (">", rule.high)) if bound is not None]
        tests.append(f"WHEN n_words > 0 AND n_words >= {rule.min_words} AND ({' OR '.join(outside)}) THEN '{rule.name}'")
    return f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    w AS (SELECT doc_id, unnest(l) AS word, generate_subscripts(l, 1) AS i
          FROM (SELECT doc_id, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS l FROM d)),
    three AS (SELECT doc_id, i, word AS a, lead(word) OVER o AS b, lead(word, 2) OVER o AS c FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
    twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM three WHERE c IS NOT NULL) WHERE n > 1),
    covered AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM twice, range(3) AS r(k) GROUP BY doc_id),
    per_word AS (SELECT doc_id, count(*) AS n_words, sum(length(word)) AS word_chars, count(*) FILTER (lower(word) IN ({stops})) AS stops FROM w GROUP BY doc_id),
    lines AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
              FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
    m AS (SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
                 length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols, length(t) - length(replace(t, '!', '')) AS bangs,
                 length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS capitals, coalesce(stops, 0) AS stops,
                 coalesce(n_dup_lines, 0) AS n_dup_lines, n_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
          FROM d LEFT JOIN per_word USING (doc_id) LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
    v AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, CASE {' '.join(tests)} END AS broken_rule FROM m)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND broken_rule IS NULL AS kept, broken_rule FROM v
    """


@query(quality_sql())
def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    out = quality_rules.judge(table(spark, folder, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "broken_rule")


@query()
def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


@query()
def op4_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_files.write_corpus(table(spark, folder, "documents"), path, tokenizer_path(), END_ID)
    return token_files.digests(spark, path)


@query()
def op5_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find_personal_data(table(spark, folder, "documents"))
    counts = [pii.number_of("base", kind).cast("long").alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.written("base"), 256).alias("base_sha256"), pii.written("spans").alias("spans"))


@query()
def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    labels = table(spark, folder, "labels").filter(crc_mod("doc_id", 5) != 0)
    found = neighbours.scored(docs, neighbours.learn(docs, labels))
    return found.select(
        "doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted")
    )


@query()
def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contained_items(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query()
def op8_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    samples = language.sample_labelled(docs.filter(crc_mod("doc_id", 3) != 1))
    found = language.detect_language(docs.select("doc_id", "text"), samples)
    return found.select("doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


@query()
def op9_mixture(spark: SparkSession, folder: str) -> DataFrame:
    found = mixture.quotas_taken(table(spark, folder, "documents"))
    return found.select(F.col("key").alias("doc_id"), "size", "source_size", "target", "taken", "copies")


@query()
def op10_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, folder, "documents")).drop("kept")


@query()
def op11_substrings(spark: SparkSession, folder: str) -> DataFrame:
    """Words in 13 that also stand in an earlier document, removed from every document."""
    found = substrings.remove_repeats(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256", F.coalesce(F.size("repeats"), F.lit(0)).alias("n_repeats"))


@query()
def op12_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of the byte-level and the piece vocabulary aligned in every document."""
    return alignment.align_texts(table(spark, folder, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


@query()
def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """The first 16 whitened components of every vector."""
    return whitening.whiten(table(spark, folder, "embeddings"))


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Where the installed vocabulary file is."""
    import public_tokenizers

    return public_tokenizers.path(name)
