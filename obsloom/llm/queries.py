"""The queries op1 to op13 over the whole documents table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from obsloom.llm import oracles
from obsloom.llm.byte_bpe import round_trip
from obsloom.llm.collocations import collocations
from obsloom.llm.exact_dedup import exact_duplicates
from obsloom.llm.language import train_and_predict
from obsloom.llm.line_dedup import line_report
from obsloom.llm.mixing import mix_plan
from obsloom.llm.ngram_join import similar_components
from obsloom.llm.pii import pii_report
from obsloom.llm.quality import quality_report
from obsloom.llm.registry import ORACLES, QUERIES, documents, query
from obsloom.llm.resampling import resample
from obsloom.llm.secrets import secret_report
from obsloom.llm.simhash import simhash_components
from obsloom.llm.token_files import read_token_files, write_token_files
from obsloom.session import work_path

__all__ = ["ORACLES", "QUERIES"]


@query("op6_exact_dedup", oracles.EXACT_DEDUP)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(documents(spark, sf_dir))


@query("op10_quality_rules", oracles.QUALITY)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(documents(spark, sf_dir))


@query("op3_secret_scans", oracles.SECRETS)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(documents(spark, sf_dir), work_path(spark, "ledger"))


@query("op9_source_mixing", oracles.MIXING)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_plan(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "budget")


@query("op4_byte_bpe")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op5_pii")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_report(documents(spark, sf_dir))


@query("op2_token_files")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "token-files")
    write_token_files(documents(spark, sf_dir), path, public_tokenizers.path("word_bpe_49k.json"))
    return read_token_files(spark, path)


@query("op7_language_id")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return train_and_predict(documents(spark, sf_dir))


@query("op8_ngram_join")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_components(documents(spark, sf_dir)).drop("mark")


@query("op1_line_dedup", oracles.LINES)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(documents(spark, sf_dir))


@query("op11_collocations", oracles.COLLOCATIONS)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir))


@query("op12_importance_resampling", oracles.RESAMPLING)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query("op13_simhash")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(documents(spark, sf_dir))
