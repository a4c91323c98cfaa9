"""The corpus pipeline: five stages over documents, each working on all that the stage before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelyard.llm import bpe, line_dedup, mixing, simhash, toxicity
from panelyard.session import materialise

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
ORACLE_SQL = None       # learned scores, edit distances and the tokenizer are beyond SQL; tests compare with brute force


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5 by a model learned from ``labels``; texts without words stay."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model, target="toxic_score").where("toxic_score < 0.5").select(*docs.columns)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every line at its earliest place only; a document left without a word goes, one that had none stays."""
    rows = line_dedup.dedup_lines(docs)
    stays = (F.col("n_removed") == 0) | F.col("text").rlike(mixing.WORD)
    return rows.where(stays).withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long"))
                                        .otherwise(F.col("n_chars"))).select(*docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: sets of five-word shingles with a Jaccard similarity of 0.8 or more."""
    return simhash.keep_one_similar(docs, words_in_shingle=5)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, as many times as the mix takes them."""
    others = tuple(c for c in docs.columns if c not in ("doc_id", "source"))
    rows = mixing.mix(docs, cut=False, carry=others).where("copies > 0")
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, as packed little-endian 32-bit numbers."""
    rows = bpe.encode(docs, VOCABULARY)
    return rows.select("doc_id", "lang", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", without_toxic),
    ("line_dedup", without_repeated_lines),
    ("simhash_dedup", without_near_copies),
    ("mixing", mixed_sources),
    ("bpe", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
