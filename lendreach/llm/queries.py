"""The registered queries of this subpackage, with production parameters, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendreach.llm.ann import near_vectors
from lendreach.llm.balltree import exact_top
from lendreach.llm.chat import canonical_turns, digests, format_chats
from lendreach.llm import sql
from lendreach.llm.common import fold, table
from lendreach.llm.jaccard import Rule, link_documents
from lendreach.llm.langid import identify, learn
from lendreach.llm.mixing import mix_sources
from lendreach.llm.negatives import mine
from lendreach.llm.packing import pack_documents
from lendreach.llm.secret_scan import scan_secrets
from lendreach.llm.sharding import grow, layout, shard_rows
from lendreach.llm.toxicity import toxic_scores
from lendreach.llm.warc import round_trip
from lendreach.llm.whitening import per_component, whiten

SHARDS = 16
TOXIC_AT = 0.7
VOCABULARY = "byte_bpe_50k.json"
CONTROL = "\\### Assistant: </turn> ok"


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20)


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = fold(F.col("doc_id"), 4) == 2
    out = identify(docs.select("doc_id", "text", held.alias("held_out")), learn(docs, ~held), ("doc_id", "held_out"))
    return out.select("doc_id", "held_out", "lang_pred", "score", "phrases", "symbols")


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_novel")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                      "offset")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (fold(F.col("doc_id"), 3) == 1).alias("held_out"))
    out = toxic_scores(docs, table(spark, sf_dir, "labels"), fold(F.col("doc_id"), 3) != 1, ("doc_id", "held_out"))
    return out.withColumn("predicted", (F.col("score") >= TOXIC_AT).cast("int"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = round_trip(table(spark, sf_dir, "pages"))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_documents(table(spark, sf_dir, "documents"), Rule(words=3, num=90, den=100))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = layout(SHARDS)
    out = shard_rows(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", tree,
                     grow(tree, SHARDS), text="text")
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard",
                      "region", "rack")


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, k=10)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix_sources(table(spark, sf_dir, "documents").select("doc_id", "source"), "source", "doc_id")
    return out.select("doc_id", "source", "phase", "block", "in_block", "release", "deadline", "slot")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return per_component(whiten(table(spark, sf_dir, "embeddings"), components=8))


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.withColumn("label", moved), F.col("id") % 100 == 0)


def op13_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(spark.createDataFrame(
        [(-7, 0, "user", CONTROL), (-7, 1, "assistant", CONTROL)], "conv_id long, turn long, role string, text string"))
    return digests(format_chats(canonical_turns(as_records(rows))))


def as_records(rows: DataFrame) -> DataFrame:
    """(conv_id, record): a JSON record a turn, in three layouts: prompts, instructions and messages."""
    kept = {"ignoreNullFields": "false"}
    return rows.select("conv_id", F.when(F.col("role") == "user", F.to_json(F.struct(
        "turn", F.col("text").alias("prompt")), kept)).when(F.col("role") == "system", F.to_json(F.struct(
            "turn", F.col("text").alias("instruction")), kept)).otherwise(F.to_json(F.struct("turn", F.struct(
                "role", F.col("text").alias("content")).alias("message")), kept)).alias("record"))


QUERIES = {f.__name__: f for f in (op1_ann, op2_langid, op3_secrets, op4_packing, op5_toxicity, op6_warc,
                                   op7_jaccard,
                                   op8_sharding, op9_topk, op10_mixing, op11_whitening, op12_negatives, op13_chat)}
ORACLES = {"op6_warc": sql.warc(), "op7_jaccard": sql.jaccard(3, 90, 100),
           "op8_sharding": sql.sharding(layout(SHARDS), grow(layout(SHARDS), SHARDS)),
           "op9_topk": sql.top_inner(100, 10), "op12_negatives": sql.negatives(100, 5, 10),
           "op13_chat": sql.chats(CONTROL)}
