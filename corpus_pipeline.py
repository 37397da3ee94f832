"""Corpus pipeline over ``documents``: toxicity, near duplicates, secrets, mixture, packing.

Each stage is a function of (spark, docs, sf_dir) whose result is written as Parquet and read again as the next
one's documents. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendreach.llm.common import table
from lendreach.llm.jaccard import Rule, link_documents
from lendreach.llm.mixing import mix_sources
from lendreach.llm.packing import pack_documents
from lendreach.llm.secret_scan import scan_secrets
from lendreach.llm.toxicity import score, train
from lendreach.session import cut_lineage

TOXIC_AT = 0.7
NEAR = Rule(words=5, num=80, den=100)
MARK = "[SECRET]"
VOCABULARY = "byte_bpe_50k.json"
WEIGHTS = None      # target shares of documents by source; None: square roots of the sources' sizes
WINDOW = 128        # slots of the mixture, of 8 documents each, within which packing orders by the curve


def unclashed(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The same rows under names that no operator uses, and those names by column."""
    names = {c: f"__{i}_{c}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def restored(rows: DataFrame, names: dict[str, str]) -> DataFrame:
    return rows.select([F.col(n).alias(c) for c, n in names.items()])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under 0.7. The factorization machine learns from all labels of ``labels``.

    Null and empty texts score the bias alone and stay; repeated rows share their fate.
    """
    machine = train(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"), F.lit(True))
    rows, names = unclashed(docs)
    scored = score(rows, machine, tuple(names.values()), text=names["text"])
    return restored(scored.filter(F.col("score") < TOXIC_AT), names)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least doc_id, of every group linked by 5-word shingles at 0.8 or more.

    Texts without a word are linked with nothing and stay. Rows that repeat a doc_id are one document, of
    which one row stays; rows without a doc_id cannot be named and stay.
    """
    kept = link_documents(docs.select("doc_id", "text"), NEAR).filter("component_id = doc_id").select(
        F.col("doc_id").alias("__kept")).distinct()
    rows, names = unclashed(docs)
    key = names["doc_id"]
    named = rows.filter(F.col(key).isNotNull()).join(kept, F.col(key) == F.col("__kept"), "left_semi")
    return restored(named.dropDuplicates([key]).unionAll(rows.filter(F.col(key).isNull())), names)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, each found secret replaced by a mark; n_chars counts the text where it changed."""
    rows, names = unclashed(docs)
    found = scan_secrets(rows, tuple(names.values()), redact=MARK, text=names["text"])
    size = F.when(F.size("found") > 0, F.length("clean_text")).otherwise(F.col(names["n_chars"]))
    kind = docs.schema["n_chars"].dataType
    return restored(found.withColumns({names["n_chars"]: size.cast(kind), names["text"]: F.col("clean_text")}), names)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, in files whose rows follow the mixture of sources by ``WEIGHTS``."""
    rows, names = unclashed(docs)
    placed = mix_sources(rows, names["source"], names["doc_id"], WEIGHTS)
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return restored(placed.repartitionByRange(parts, "slot", "in_block").sortWithinPartitions("slot", "in_block"),
                    names)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids in sequences of 1024, by window of the mixture and along the curve within it.

    Files keep no order that a reader can rely on, so the mixture is worked out again from the same rows: by
    sequence_id, every window of ``WINDOW`` slots holds its sources' shares to less than one block.
    """
    placed = mix_sources(docs.select("doc_id", "source", "text"), "source", "doc_id", WEIGHTS)
    return pack_documents(placed.withColumn("window", F.floor(F.col("slot") / WINDOW)),
                          public_tokenizers.path(VOCABULARY), window="window")


STAGES = [("toxicity", drop_toxic), ("near_copies", drop_near_copies), ("secrets", hide_secrets), ("mixture", mix),
          ("packing", pack)]
#: trained scores, byte-pair ids and earliest deadlines have no SQL form: tests hold stages against plain versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
