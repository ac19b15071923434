"""From raw documents to packed training sequences, in four stages.

1. quality: documents whose top grade is too unlikely under the ordinal classifier go (trained on ``labels``).
2. near_dedup: of each class of near copies (five words, similarity 0.8) the one with the smallest id stays.
3. secrets: every secret is replaced by a mark; all documents stay.
4. packing: the documents become pieces of at most 4096 tokens in packed sequences.

Every stage's output is written and read again before the next. All but the last return the columns of ``documents``.
The quality stage judges every row by its text. In the near-dedup stage rows with a null id stay, and of near copies
all rows with the kept id.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import neardup, packing, quality, secrets
from tidemark.llm.durable import durable
from tidemark.session import ship

ORACLE_SQL = None


def _keep(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose id is in ``ids`` (one column, ``doc_id``) and rows without an id, with their columns."""
    return docs.where("doc_id is null").unionByName(docs.join(ids, "doc_id", "left_semi").select(docs.columns))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_rows(docs, quality.train(docs, labels))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    classes = neardup.near_duplicates(docs, words_each=5, percent=80)
    return _keep(docs, classes.where("kept").select("doc_id").distinct())


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return secrets.redact_column(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", quality_stage), ("near_dedup", near_dedup_stage), ("secrets", secrets_stage), ("packing", packing_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table; returns the packed pieces."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir))
    return docs
