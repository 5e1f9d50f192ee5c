"""From raw documents to token ids: five stages, each over all that the one before has kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the ``docs`` of
the next. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

import public_tokenizers as tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfline.llm import byte_bpe, pii, rules
from shelfline.llm.minhash import first_of_each
from shelfline.llm.positions import contamination
from shelfline.session import ensure_checkpoint_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base checks and the learned decision list keep."""
    learned = rules.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return rules.keep(docs, learned)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest doc_id: five words, similarity 0.8.

    Rows without a doc_id and rows that share one are judged row by row; of a group without any doc_id one row stays.
    """
    return first_of_each(docs, words=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no ten-word window of a benchmark item stands.

    Rows are known by a hash of doc_id and text, so rows without a doc_id and rows that share one are judged one by one.
    """
    row = F.xxhash64(docs["doc_id"], docs["text"])
    found = contamination(docs.select(row.alias("doc_id"), "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=10)
    hit = found.where("contaminated").select(F.col("doc_id").alias("row")).distinct()
    return docs.join(hit, row == hit["row"], "left_anti")


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind; n_chars follows the text."""
    masked = pii.mask(docs)
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns) if "n_chars" in docs.columns else masked


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids and n_tokens of each text, and whether the ids decode to the text again."""
    path = tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = byte_bpe.encode(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), path, tokenizers.PATTERN)
    decoded = byte_bpe.decode(encoded, path)
    return decoded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"),
                          (F.col("decoded") == F.col("text").cast("binary")).alias("round_trip"))


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_dedup),
    ("decontamination", decontaminate),
    ("personal data", mask_personal_data),
    ("token ids", token_ids),
]

#: The learned rules have no form in SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
