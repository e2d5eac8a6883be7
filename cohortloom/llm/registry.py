"""The queries of this subpackage, one for each operator, and their SQL counterparts."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm import (
    bagminhash,
    ball_codes,
    block_anchors,
    bpe,
    count_cells,
    cross_parse,
    jump_hash,
    license_index,
    rabitq,
    spaced_seeds,
    subset_join,
    suffix_dedup,
    wavelet,
)
from cohortloom.llm.shared import documents

SHARDS = 8
#: Id that ends each document in the token files.
END_ID = 2


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and the bytes they decode to, as digests."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    docs = documents(spark, sf_dir, "doc_id", "text")
    return bpe.digests(bpe.round_trip(docs, ranks, public_tokenizers.PATTERN))


def op2_rotated_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth."""
    return rabitq.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op3_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard, slot, and shard after growth by one."""
    return jump_hash.shard_documents(documents(spark, sf_dir, "doc_id", "text"), SHARDS)


def op4_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-copy class of every document."""
    docs = documents(spark, sf_dir, "doc_id", "text")
    return bagminhash.classes(docs).select("doc_id", "class_id", "n_shingles")


def op5_license_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases, labels and score of every document."""
    return license_index.scan_licenses(documents(spark, sf_dir, "doc_id", "text")).drop("spans")


def op6_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without bytes that stood earlier."""
    docs = documents(spark, sf_dir, "doc_id", "text")
    return suffix_dedup.digests(suffix_dedup.remove_duplicates(docs))


def op7_cross_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from the rows that aren't held out."""
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    model = cross_parse.Model(cross_parse.training_texts(docs, "text", "lang", "doc_id"))
    return cross_parse.predict(docs, model).select(
        "doc_id", cross_parse.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )


def op8_wavelet_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, size and checksum of every document's ids, read back from the token files."""
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        definition = file.read()
    return wavelet.round_trip(documents(spark, sf_dir, "doc_id", "text"), definition, END_ID)


def op9_block_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without repeated windows of words."""
    docs = documents(spark, sf_dir, "doc_id", "text")
    return block_anchors.digests(block_anchors.remove_repeats(docs))


def op10_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that stand in documents."""
    docs = documents(spark, sf_dir, "doc_id", "text")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return spaced_seeds.overlaps(docs, benchmark).drop("row_key")


def op11_ball_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product codes of every vector, their errors and the codebooks' digest."""
    return ball_codes.digests(ball_codes.compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet")))


def op12_count_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances of the sources of a language, and the terms that set each source apart."""
    return count_cells.audit(documents(spark, sf_dir, "text", "lang", "source"))


def op13_subset_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of every document's shingle set, and the component of its links."""
    return subset_join.join(documents(spark, sf_dir, "doc_id", "text"))


def queries() -> dict:
    found = (
        op1_byte_bpe,
        op2_rotated_codes,
        op3_jump_sharding,
        op4_bagminhash,
        op5_license_index,
        op6_suffix_array,
        op7_cross_parse,
        op8_wavelet_matrix,
        op9_block_anchors,
        op10_spaced_seeds,
        op11_ball_codes,
        op12_count_cells,
        op13_subset_join,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {
        "op10_spaced_seeds": spaced_seeds.oracle_sql(),
        "op12_count_cells": count_cells.oracle_sql(),
    }
