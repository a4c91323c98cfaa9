"""The dealt queries over the given tables, each with the SQL it must agree with where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelyard.llm import (alignment, bpe, chat, conversations, digests, exact_dedup, line_dedup, mixing, secrets, sharding,
                           simhash, toxicity, vectors)
from panelyard.session import materialise

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def wrap(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql.strip()
        return fn

    return wrap


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


@query("op1_line_dedup")
def op1_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    cleaned = line_dedup.dedup_lines(table(spark, sf, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("text_sha256"))


@query("op2_bpe")
def op2_bpe(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    coded = bpe.decode(bpe.encode(docs, VOCABULARY).drop("text"), VOCABULARY)
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op3_mixing")
def op3_mixing(spark: SparkSession, sf: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


@query("op4_chat_perspectives", """
WITH r AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS role, replace(coalesce(text, ''), '<|', '< |') AS text FROM conversations),
t AS (SELECT conv_id, role, text || '<|end|>' || chr(10) AS body, row_number() OVER (
             PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS place FROM r),
s AS (SELECT DISTINCT conv_id AS c, role AS speaker FROM t WHERE role <> 'system'),
v AS (SELECT t.*, speaker, role = speaker AS own, CAST(place // 512 AS BIGINT) AS part,
             CASE WHEN role = speaker THEN '<|assistant|>' WHEN role = 'system' THEN '<|system|>'
                  ELSE '<|user name=' || role || '|>' END || chr(10) AS head
      FROM t JOIN s ON conv_id IS NOT DISTINCT FROM c),
o AS (SELECT *, CAST(sum(length(head) + length(body)) OVER (PARTITION BY conv_id, speaker, part
                       ORDER BY place ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto FROM v)
SELECT conv_id, speaker, part, count(*) AS n_turns, string_agg(head || body, '' ORDER BY place) AS rendered,
       coalesce(string_agg(CASE WHEN own THEN (upto - length(body)) || ':' || upto END, ',' ORDER BY place), '') AS masks
FROM o GROUP BY conv_id, speaker, part""")
def op4_chat_perspectives(spark: SparkSession, sf: str) -> DataFrame:
    views = chat.rotate_perspectives(table(spark, sf, "conversations"))
    spans = F.transform("masks", lambda m: F.concat_ws(":", m.start.cast("string"), m.end.cast("string")))
    return views.withColumn("masks", F.array_join(spans, ","))


@query("op5_simhash")
def op5_simhash(spark: SparkSession, sf: str) -> DataFrame:
    rows = simhash.near_classes(table(spark, sf, "documents"))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op6_sharding")
def op6_sharding(spark: SparkSession, sf: str) -> DataFrame:
    placed = sharding.ring_shards(table(spark, sf, "documents"), 24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@query("op7_secrets")
def op7_secrets(spark: SparkSession, sf: str) -> DataFrame:
    found = secrets.scan(table(spark, sf, "documents"))
    return found.select("doc_id", *[secrets.counted(F.col("base"), k).alias(f"n_{k}") for k in secrets.BASE],
                        F.sha2(secrets.joined(F.col("base")), 256).alias("base_sha256"),
                        secrets.joined(F.concat("base", "linked")).alias("spans"))


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf, "labels"))
    scored = toxicity.score(docs, model).drop("text")
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op9_vectors")
def op9_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf, "embeddings"))


@query("op10_exact_dedup", """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""")
def op10_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup.exact_copies(table(spark, sf, "documents"), hash_all=True)


@query("op11_repair")
def op11_repair(spark: SparkSession, sf: str) -> DataFrame:
    return conversations.repair_structure(conversations.damaged(table(spark, sf, "conversations")))


@query("op13_alignment")
def op13_alignment(spark: SparkSession, sf: str) -> DataFrame:
    aligned = alignment.alignments(table(spark, sf, "documents"), BYTE_VOCABULARY, PIECE_MODEL)
    hashed = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    stored = materialise(aligned.withColumn("groups_sha256", hashed).drop("groups"), "alignments")
    return alignment.scored(stored)


@query("op12_digest")
def op12_digest(spark: SparkSession, sf: str) -> DataFrame:
    return digests.edits_compared(table(spark, sf, "documents"))
