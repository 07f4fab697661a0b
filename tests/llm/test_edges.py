"""Every operator on nulls, empty and very long texts, ties, repeated rows, clashing columns and empty tables."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from obsloom.llm import byte_bpe, exact_dedup, language, line_dedup, mixing, ngram_join, pii, quality, secrets, token_files
from obsloom.session import work_path
from tables import awkward, awkward_rows, clashing, empty

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
WORDS = public_tokenizers.path("word_bpe_49k.json")


def token_report(docs):
    path = work_path(docs.sparkSession, "tokens")
    token_files.write_token_files(docs, path, WORDS)
    return token_files.read_token_files(docs.sparkSession, path)


REPORTS = {
    "lines": line_dedup.line_report,
    "tokens": token_report,
    "secrets": lambda docs: secrets.secret_report(docs, work_path(docs.sparkSession, "ledger")),
    "bpe": lambda docs: byte_bpe.round_trip(docs, RANKS, PATTERN),
    "pii": pii.pii_report,
    "exact": exact_dedup.exact_duplicates,
    "language": language.train_and_predict,
    "similar": ngram_join.similar_components,
    "mixing": lambda docs: mixing.mix_plan(docs),
    "quality": lambda docs: quality.quality_report(docs),
}


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("name", REPORTS)
def test_one_row_per_row_whatever_else_the_table_holds(spark, name):
    plain = rows_of(REPORTS[name](awkward(spark)))
    assert len(plain) == len(awkward_rows())
    assert rows_of(REPORTS[name](clashing(awkward(spark)))) == plain


@pytest.mark.parametrize("name", REPORTS)
def test_an_empty_table_gives_no_rows(spark, name):
    assert REPORTS[name](empty(spark)).collect() == []


APPLIED = {
    "quality": quality.apply_quality,
    "lines": line_dedup.dedup_lines,
    "exact": exact_dedup.drop_exact_duplicates,
    "similar": ngram_join.drop_similar,
    "mixing": mixing.mix_documents,
}


@pytest.mark.parametrize("name", APPLIED)
def test_filters_keep_the_columns(spark, name):
    docs = clashing(awkward(spark))
    out = APPLIED[name](docs)
    assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
    plain = APPLIED[name](awkward(spark))
    assert sorted(out.toPandas()["doc_id"].fillna(-1)) == sorted(plain.toPandas()["doc_id"].fillna(-1))
    assert APPLIED[name](empty(spark)).count() == 0


def test_defined_results(spark):
    docs = awkward(spark)
    by_id = lambda df: {r["doc_id"]: r for r in df.filter("doc_id is not null").collect()}
    exact = exact_dedup.exact_duplicates(docs)
    assert exact.filter("kept").count() == exact.select("text_sha256").distinct().count()
    assert exact.groupBy("text_sha256").agg(F.countDistinct("keep_id").alias("n")).filter("n > 1").count() == 0
    language_of = by_id(language.train_and_predict(docs))
    assert [language_of[i]["lang_pred"] for i in (4, 5, 6)] == ["und"] * 3
    similar = by_id(ngram_join.similar_components(docs))
    assert [similar[i]["component_id"] for i in (1, 2, 4, 5, 7, 8)] == [1, 1, 4, 5, 7, 7]
    judged = by_id(quality.quality_report(docs))
    assert judged[9]["base_failed"] and judged[4]["base_failed"] and judged[1]["kept"]
    cleaned = {r["doc_id"]: r for r in line_dedup.line_report(docs).collect()}
    assert cleaned[12]["n_removed_lines"] == 0 and cleaned[14]["n_removed_lines"] > 0
