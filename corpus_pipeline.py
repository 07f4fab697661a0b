"""From raw documents to an encoded training mix.

Every stage takes and returns rows of ``documents``; the last returns the ids. ``run`` writes the result of
each stage to a table in the shared work folder and reads it again, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsloom.llm.byte_bpe import encode_documents
from obsloom.llm.line_dedup import dedup_lines
from obsloom.llm.mixing import mix_documents
from obsloom.llm.ngram_join import drop_similar
from obsloom.llm.quality import apply_quality
from obsloom.session import work_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go, and so do boilerplate lines of the others; edge cases as in ``apply_quality``."""
    return apply_quality(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of a passage in several documents the first stays; documents that lose more than half of their words go.

    Nulls, empty texts, repeated rows and extra columns as in ``dedup_lines``.
    """
    return dedup_lines(docs, drop_depleted=True)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: shingles of five words, similarity of 0.8 or more; edge cases as in ``drop_similar``."""
    return drop_similar(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents by source weights; a document that is taken twice gives two rows. Edge cases as in ``mix_documents``."""
    return mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document of the mix, where they begin, and the hash of what they decode to.

    Edge cases as in ``encode_documents``.
    """
    encoded = encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, decoded=True)
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "offsets", "decoded_sha256")


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("ngram_join", near_duplicates),
    ("source_mixing", mix),
    ("byte_bpe", encode),
]

#: Similar sets and BPE are beyond SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another on the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = work_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
