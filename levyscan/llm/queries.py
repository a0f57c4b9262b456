"""The registered queries: each operator on its whole table, with production parameters."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from levyscan.llm import (
    ann_partitions,
    html_consensus,
    language_id,
    mixing,
    ngram_join,
    oracles,
    packing,
    pii_surrogates,
    quality_mcd,
    secret_markov,
    spelling_variants,
    suffix_automaton,
    toxicity,
    turn_repair,
)
from levyscan.llm.common import crc_remainder, in_small_batches, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


@query("op1_pii_surrogates")
def pseudonymous_documents(spark: SparkSession, base: str) -> DataFrame:
    return pii_surrogates.pseudonymise(table(spark, base, "documents"), b"levyscan-surrogates")


@query("op2_html_consensus")
def page_texts(spark: SparkSession, base: str) -> DataFrame:
    return html_consensus.extract_pages(table(spark, base, "pages"))


@query("op3_learned_partitions")
def nearest_vectors(spark: SparkSession, base: str) -> DataFrame:
    return ann_partitions.nearest(table(spark, base, "embeddings"), F.col("id") % 100 == 0)


@query("op4_toxicity_lexicon")
def toxic_documents(spark: SparkSession, base: str) -> DataFrame:
    in_small_batches(spark)
    docs = table(spark, base, "documents")
    lexicon = toxicity.train(docs, table(spark, base, "labels"), crc_remainder("doc_id", 5) != 0)
    scored = toxicity.rate(docs, lexicon)
    return scored.select(
        "doc_id",
        F.coalesce(crc_remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query("op5_ngram_jaccard_join")
def jaccard_documents(spark: SparkSession, base: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, base, "documents"))


@query("op6_source_mixing")
def mixed_documents(spark: SparkSession, base: str) -> DataFrame:
    mixed = mixing.mix(table(spark, base, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query("op7_language_compression")
def document_languages(spark: SparkSession, base: str) -> DataFrame:
    docs = table(spark, base, "documents")
    model = language_id.train(docs, crc_remainder("doc_id", 4) != 2)
    return language_id.identify(docs, model).select(
        "doc_id",
        F.coalesce(crc_remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
        "lang_pred",
        "score",
        "margin",
        "accepted",
    )


@query("op8_secret_markov")
def document_secrets(spark: SparkSession, base: str) -> DataFrame:
    docs = table(spark, base, "documents")
    return secret_markov.summary(secret_markov.scan(docs, secret_markov.train(docs)))


@query("op9_quality_mcd")
def document_quality(spark: SparkSession, base: str) -> DataFrame:
    return quality_mcd.judge(table(spark, base, "documents"))


@query("op10_tiered_packing")
def packed_documents(spark: SparkSession, base: str) -> DataFrame:
    return packing.pack_documents(table(spark, base, "documents"))


@query("op11_turn_repair", oracles.TURN_REPAIR)
def repaired_conversations(spark: SparkSession, base: str) -> DataFrame:
    return turn_repair.damaged_and_repaired(table(spark, base, "conversations"))


@query("op12_suffix_automaton", oracles.BENCHMARK_LEAKS)
def leaked_benchmark(spark: SparkSession, base: str) -> DataFrame:
    found = suffix_automaton.find_leaks(table(spark, base, "documents"), table(spark, base, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])
    names = F.array_sort(F.transform("items", lambda i: F.coalesce(i.cast("string"), F.lit(""))))
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


@query("op13_trie_pairs", oracles.SPELLING_VARIANTS)
def spelling_forms(spark: SparkSession, base: str) -> DataFrame:
    return spelling_variants.group_variants(spelling_variants.word_counts(table(spark, base, "documents"), slip_one_in=31))
