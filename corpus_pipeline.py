"""A corpus from raw documents to packed sequences, in five stages.

Each stage takes the documents that the one before it kept. Its result is written as Parquet
and read again as the next one's input. Documents keep their columns up to the last stage,
which returns pieces of token sequences.

Defined results: a text that is null, empty or without letters has no language and goes in the
first stage; repeated rows and rows of one doc_id are near copies like any others, of which one
stays; ties between copies go to the least doc_id; a null source is a source of its own; other
columns are carried along unread up to the last stage; an empty table gives an empty result.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from levyscan.llm import language_id, mixing, ngram_join, packing, secret_markov
from levyscan.llm.common import in_small_batches, stage, table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; those with too narrow a margin go."""
    in_small_batches(spark)
    return language_id.identified_rows(docs, language_id.train(docs, F.lit(True)))


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    in_small_batches(spark)
    return ngram_join.one_per_group(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark."""
    in_small_batches(spark)
    clean = secret_markov.redact(docs, secret_markov.train(docs))
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources ask for."""
    in_small_batches(spark)
    return mixing.mixed_rows(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in full sequences."""
    in_small_batches(spark)
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", known_language),
    ("near_duplicates", distinct_texts),
    ("secrets", without_secrets),
    ("mixing", mixed_sources),
    ("packing", packed_sequences),
]

#: SQL has neither compression nor byte-pair ids; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
