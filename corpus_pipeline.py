"""From raw documents to token files: language, near-duplicates, benchmark items, mixture, tokens.

Each stage is written as Parquet and read again as the documents of the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terrace.llm import decontaminate, language, mixture, near_copies, token_files
from terrace.llm.queries import END_ID, tokenizer_path
from terrace.session import bound_batches, scratch_path, write_through
from terrace.sources.tables import table

#: Words that a worker keeps the ids of; the workers of the token stage hold what earlier stages left as well.
KEPT_WORDS = 100_000


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: only texts without a letter, null and empty ones go. Close races between languages stay.

    All labelled documents are learned from; none is held out, as the query of the operator has to.
    """
    bound_batches(spark)
    return language.keep_known(docs, language.sample_labelled(docs))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies; null keys stay, null and empty texts are copies of each other."""
    bound_batches(spark)
    return near_copies.keep_first(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; null and empty texts hold none, repeated rows go together."""
    bound_batches(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture of sources draws them; a null source is one, texts without words are drawn with their block."""
    return mixture.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mixture, and per document what is read back from them; a null text has the end id alone."""
    bound_batches(spark)
    path = scratch_path(spark, "corpus")
    token_files.write_corpus(docs, path, tokenizer_path(), END_ID, kept_words=KEPT_WORDS)
    return token_files.digests(spark, path)


STAGES = [
    ("language", known_language),
    ("near_duplicates", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("mixture", mixed),
    ("token_files", tokens),
]

#: Hashes of languages, fingerprints and orders are beyond SQL; the stages are tested one by one against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next one reads it; an empty table gives no rows."""
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = write_through(docs, f"pipeline-{name}")
    return docs
