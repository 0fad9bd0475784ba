"""A training corpus from raw documents in five stages, each over all that the one before has kept.

Every stage takes (spark, docs, folder of the tables) and returns a DataFrame; `run` writes each result as Parquet to the
work folder and reads it again. All stages but the last return the columns of `documents`. Empty documents give
empty results; null texts count as empty; rows that repeat id and text count as copies in the second stage. Each stage sets
the session to small Arrow batches, as executors run the stages one after the other and keep what any of them has needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brokerhouse.llm import bpe, exact_dedup, mixing, ngram_join, toxicity
from brokerhouse.llm.common import fold, free_names, materialize, same_columns, small_batches
from brokerhouse.llm.queries import quality_of, vocabulary

#: Score from which a document is rejected as toxic.
TOXIC = 0.3
#: Near duplicates share 80 % of their runs of five words.
WORDS, PERCENT = 5, 80


def _text_key(*others: str) -> Column:
    """What tells documents apart: their columns and whole text."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in others]
    return F.sha2(F.concat_ws("\n", *parts, F.coalesce(F.col("text"), F.lit(""))), 256)


def toxicity_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from three quarters of the labels."""
    small_batches(spark)
    labels = spark.read.parquet(f"{folder}/labels.parquet").where(fold("doc_id", 4) != 2)
    model = toxicity.fit(docs, labels, threshold=TOXIC)
    (score,) = free_names(docs, "_score")
    return toxicity.score(docs, model, keep=True, name=score).where(F.col(score) < TOXIC).select(*same_columns(docs))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    small_batches(spark)
    return exact_dedup.without_duplicates(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each class of near duplicates the row with the least id stays; a null id only where all are null."""
    small_batches(spark)
    key, kept = free_names(docs, "_key", "_kept")
    named = docs.withColumn(key, F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", _text_key().alias("text")))
    found = ngram_join.classes(named, WORDS, PERCENT, id_col=key)
    stays = found.where(F.col(key) == F.col("component_id")).select(F.to_json(key).alias(kept)).distinct()
    both = named.withColumn(key, F.to_json(key)).join(stays, F.col(key) == F.col(kept), "left_semi")
    return both.select(*same_columns(docs))


def mixing_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Each document is there as many times as the mix takes it."""
    small_batches(spark)
    key, size, weight, dealt, number, turn, copy = free_names(
        docs, "_key", "_size", "_weight", "_dealt", "_number", "_turn", "_copy"
    )
    named = docs.withColumn(key, _text_key("doc_id", "source"))
    weights = quality_of(spark.read.parquet(f"{folder}/labels.parquet")).withColumnRenamed("_weight", weight)
    light = named.select("doc_id", "source", key, mixing.word_count(F.col("text")).alias(size))
    light = light.join(weights, F.col("doc_id") == F.col("_labelled"), "left")
    mixed = mixing.mix(light, F.col(weight), id_col=key, size=F.col(size))
    # rows that are alike share what is taken of them
    taken = mixed.groupBy(F.col(key).alias(dealt)).agg(F.sum("times").alias(number), F.count("*").alias(copy))
    both = named.join(taken, F.col(key) == F.col(dealt)).withColumn(
        turn, F.row_number().over(Window.partitionBy(key).orderBy(key))
    )
    own = F.floor(F.col(number) / F.col(copy)) + F.when(F.col(turn) <= F.col(number) % F.col(copy), 1).otherwise(0)
    return (
        both.withColumn(number, own.cast("int"))
        .where(F.col(number) > 0)
        .withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(number))))
        .select(*same_columns(docs))
    )


def bpe_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token ids of every whole text in place of the text, and whether they decode to it."""
    small_batches(spark)
    encoded = bpe.encode_documents(docs, vocabulary())
    (count,) = free_names(encoded, "n_tokens")
    return encoded.withColumn(count, F.size(encoded.columns[-2]))


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("ngram_join", near_dedup_stage),
    ("mixing", mixing_stage),
    ("bpe", bpe_stage),
]

#: The first, third and fifth stage cannot be said in SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; the last one is left to be written by the caller."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialize(docs)
    return docs
