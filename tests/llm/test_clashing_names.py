"""Extra columns that have the names of what operators use or add: all of them keep their values."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from revloom.llm import line_dedup, mixing, ngram_join, quality

NAMES = [
    "n_lines", "n_removed", "_cut", "_key", "row_key", "k1", "k2", "row", "split", "gone", "h1", "h2", "place", "first", "number", "line", "value",
    "copy", "_copies", "_source", "_times", "_cutoff", "times", "copies", "cutoff", "tokens", "quota", "key", "block", "rest", "upto",
    "score", "predicted", "held_out", "at", "id", "good", "x", "quality",
    "_hash", "_doc_id", "_h", "worded", "none", "text_hash", "root", "digest", "vertex", "signature", "Score", "ROW",
]


@pytest.fixture(scope="module")
def docs(spark):
    spark.conf.set("spark.sql.caseSensitive", "false")
    base = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    names = list({n.lower(): n for n in NAMES}.values())
    return base.withColumns({n: F.concat(F.lit(f"{n} of "), F.col("doc_id")) for n in names}), names


def kept(out, docs, names):
    assert out.columns[: len(docs.columns)] == docs.columns
    wrong = [F.col(f"`{n}`").isNull() | (F.col(f"`{n}`") != F.concat(F.lit(f"{n} of "), F.col("doc_id"))) for n in names]
    assert out.where(F.array_contains(F.array(*wrong), True)).count() == 0
    assert out.count() > 0


def test_line_dedup(docs):
    docs, names = docs
    out = line_dedup.without_spread_lines(docs, 3)
    kept(out, docs, names)
    assert out.columns[len(docs.columns):] == ["n_lines_", "n_removed_"]
    plain = line_dedup.without_spread_lines(docs.select("doc_id", "text", "source"), 3)
    same = out.select("doc_id", "text", F.col("n_lines_").alias("n_lines"), F.col("n_removed_").alias("n_removed"))
    assert same.exceptAll(plain.drop("source")).isEmpty() and same.count() == plain.count()


def test_mixing(docs):
    docs, names = docs
    out = mixing.mixed(docs, max_repeats=2.0)
    kept(out, docs, names)
    assert out.columns[len(docs.columns):] == ["copy_", "place_"]
    plain = mixing.mixed(docs.select("doc_id", "text", "source"), max_repeats=2.0)
    assert out.select("doc_id", "copy_", "place_").exceptAll(plain.select("doc_id", "copy", "place")).isEmpty() and out.count() == plain.count()


def test_quality(docs, spark):
    docs, names = docs
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    out = quality.scored(docs, labels)
    kept(out, docs, names)
    assert out.columns[len(docs.columns):] == ["held_out_", "score_", "predicted_"]
    good = quality.good_documents(docs, labels)
    kept(good, docs, names)
    assert good.columns == docs.columns
    plain = quality.good_documents(docs.select("doc_id", "text"), labels)
    assert good.select("doc_id", "text").exceptAll(plain).isEmpty() and good.count() == plain.count()


def test_ngram_join(docs):
    docs, names = docs
    out = ngram_join.one_per_group(docs)
    kept(out, docs, names)
    assert out.columns == docs.columns
    plain = ngram_join.one_per_group(docs.select("doc_id", "text"))
    assert out.select("doc_id").exceptAll(plain.select("doc_id")).isEmpty() and out.count() == plain.count()


@pytest.mark.parametrize("n", range(4))
def test_stages(docs, spark, n):
    docs, names = docs
    out = corpus_pipeline.STAGES[n][1](spark, docs, "/root/testdata/sf0.001")
    kept(out, docs, names)
    assert out.columns == docs.columns
