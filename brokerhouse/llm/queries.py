"""The corpus operators as queries over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable
from importlib.util import find_spec

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brokerhouse.llm import (
    bpe,
    conversations,
    exact_dedup,
    hard_negatives,
    language_id,
    minhash_dedup,
    mixing,
    ngram_join,
    pii,
    revisits,
    token_counts,
    topk,
    toxicity,
)
from brokerhouse.llm.common import fold

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Path of a public tokenizer's file, on whichever machine asks."""
    folder = find_spec("public_tokenizers").submodule_search_locations[0]
    return f"{folder}/{name}"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def quality_of(labels: DataFrame) -> DataFrame:
    """Weights by document: 2 for good ones, 1/2 for bad ones; documents without a label weigh 1."""
    known = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("_good"))
    return known.select(F.col("doc_id").alias("_labelled"), F.when(F.col("_good") > 0, 2.0).otherwise(0.5).alias("_weight"))


def op1_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return pii.find(docs, pii.fit(docs))


def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.section_tokens(_table(spark, folder, "documents"), vocabulary())


def op3_revisits(spark: SparkSession, folder: str) -> DataFrame:
    found = revisits.resolve(revisits.crawl_of(_table(spark, folder, "pages")))
    header = lambda name: F.col("headers")[name].alias(name.replace("-", "_"))
    return found.select(
        "record_id", "url", "original_id", "outcome", "payload_digest",
        *map(header, ("etag", "last-modified", "date", "cache-control", "content-type", "content-length", "server")),
    )


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    labels = _table(spark, folder, "labels").where(fold("doc_id", 4) != 2)
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    return scored.select(
        "doc_id",
        (fold("doc_id", 4) == 2).alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= 0.3).cast("int").alias("predicted"),
    )


def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "source", mixing.word_count(F.col("text")).alias("_size"))
    weights = quality_of(_table(spark, folder, "labels"))
    both = docs.join(weights, F.col("doc_id") == F.col("_labelled"), "left")
    return mixing.mix(both, F.col("_weight"), size=F.col("_size")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "times"
    )


def op6_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode_digests(_table(spark, folder, "documents"), vocabulary())


def op7_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.classes(_table(spark, folder, "documents"), words=3, percent=90)


def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.duplicates(_table(spark, folder, "documents"))


def op9_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(_table(spark, folder, "embeddings"))


def op10_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    model = language_id.fit(docs.where(fold("doc_id", 5) != 0))
    found = language_id.predict(docs, model)
    return found.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives.mine(hard_negatives.shifted_labels(_table(spark, folder, "embeddings")))


def op12_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash_dedup.near_duplicates(_table(spark, folder, "documents"), words=3, percent=85)


def op13_conversations(spark: SparkSession, folder: str) -> DataFrame:
    turns = _table(spark, folder, "conversations")
    return conversations.repaired(conversations.damaged(turns), turns)


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES: dict[str, Query] = {
    "op1_pii": op1_pii,
    "op2_token_counts": op2_token_counts,
    "op3_revisits": op3_revisits,
    "op4_toxicity": op4_toxicity,
    "op5_mixing": op5_mixing,
    "op6_bpe": op6_bpe,
    "op7_ngram_join": op7_ngram_join,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_topk": op9_topk,
    "op10_language": op10_language,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_minhash_dedup": op12_minhash_dedup,
    "op13_conversations": op13_conversations,
    "pipeline": pipeline,
}
