"""From raw documents to token ids, in five stages that are written between each other.

Every stage takes (spark, docs, sf_dir) and works on all rows that the one before kept. All but
the last return the columns of the documents; further columns go along unchanged. Null ids,
repeated rows and empty tables pass through every stage; what each does with null and empty
texts is said there.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import public_tokenizers  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from cohortloom.llm import bagminhash, bpe, cross_parse, spaced_seeds, suffix_dedup  # noqa: E402
from cohortloom.llm.shared import free_name, written_table  # noqa: E402

RANKS = "byte_bpe_multi_50k.tiktoken"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language; texts that are null or have no letter go."""
    model = cross_parse.Model(cross_parse.training_texts(docs, "text", "lang", "doc_id"))
    pred, lead = free_name(docs, "language"), free_name(docs, "lead")
    found = cross_parse.with_language(docs, model, pred=pred, score=lead)
    # With nothing to learn from, only texts without a letter can be told.
    known = F.col(pred) != cross_parse.UNDETERMINED
    if not model.languages:
        known = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return found.where(known).drop(pred, lead)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest id."""
    return bagminhash.keep_one(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that a string of 100 bytes seen earlier covers.

    Characters that a cut breaks go whole, and n_chars follows the text. A text of which nothing
    is left stays as an empty one, and a null text becomes empty.
    """
    carried = [c for c in docs.columns if c not in ("doc_id", "text")]
    found = suffix_dedup.remove_duplicates(docs, carried=carried, characters=True)
    text = F.col("kept").cast("string")
    values = {c: F.col("more")[c] for c in carried}
    values |= {"doc_id": F.col("doc_id"), "text": text}
    if "n_chars" in carried:
        values["n_chars"] = F.length(text).cast(docs.schema["n_chars"].dataType)
    return found.select(*(values[c].alias(c) for c in docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark, even with exchanged words."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return spaced_seeds.clean(docs, benchmark)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, packed, with digests of them and of what they decode to."""
    ranks = bpe.read_ranks(public_tokenizers.path(RANKS))
    coded = bpe.round_trip(docs, ranks, public_tokenizers.PATTERN, ["doc_id", "lang", "source"])
    return coded.select(
        "doc_id",
        "lang",
        "source",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("benchmark_decontamination", decontamination),
    ("byte_bpe", encoding),
]

#: SQL can't express the language model, the registers or the merges; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
