"""The registered queries of this subpackage: each operator over its whole table, and the SQL where it can be written."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import ann, bpe, chat, html_main, media, neardup, packing, piece_bpe, quality, resample, runs, secrets, sharding
from tidemark.session import ship


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    return bpe.digest(bpe.encode(_table(spark, sf_dir, "documents"), *vocabulary, with_decoded=True))


def op1_hilbert_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(_table(spark, sf_dir, "embeddings"), is_query=F.col("id") % 50 == 0)


def op2_trigram_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(_table(spark, sf_dir, "documents")))


def op3_tree_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main.extract(_table(spark, sf_dir, "pages"))


def op4_perspective_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(_table(spark, sf_dir, "conversations"))


def op5_chroma_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.align_melodies(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 50 == 0)


def op6_odd_sketch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"), words_each=3, percent=85)


def op7_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_external_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf_dir, "documents"))


def op11_crc_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of the documents of 20 words or more, drawn towards the features of ``benchmark``; all documents are returned."""
    return resample.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_grammar_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document's words, after every tenth document has had a repetition planted by its id."""
    return runs.digest(_table(spark, sf_dir, "documents"), rewrite=runs.planted)


def op13_piece_backtracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded with begin and end ids and decoded again."""
    return piece_bpe.digest(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {f.__name__: f for f in (op1_hilbert_ann, op2_trigram_secrets, op3_tree_html, op4_perspective_chat, op5_chroma_alignment, op6_odd_sketch_dedup, op7_ordinal_quality, op8_byte_bpe, op9_vector_packing, op10_external_shuffle, op11_crc_resample, op12_grammar_runs, op13_piece_backtracking)}
ORACLE_SQL: dict[str, str] = {"op2_trigram_secrets": secrets.ORACLE_SQL, "op4_perspective_chat": chat.ORACLE_SQL, "op6_odd_sketch_dedup": neardup.ORACLE_SQL}
