"""Cleaning a corpus in five stages, each one of the operators of ``ledgerloom.llm``.

A stage takes (spark, docs, sf_dir) and works on everything its predecessor kept.
All but the last return the columns of documents.
"""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.llm import langid, lines, packing, quality, simhash
from ledgerloom.llm.common import prepare, table, unused, written

QUALITY_FLOOR = 0.3
LANGUAGE_FLOOR = 0.5


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted to the labelled ones, does not reject."""
    prepare(spark)
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return docs.filter(quality.scorer(spark, model)("text") >= QUALITY_FLOOR)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that could be told; texts without letters and mixtures without a main language go."""
    prepare(spark)
    model = langid.train(docs)
    found = langid.predictor(spark, model)("text")
    return docs.filter((found["lang_pred"] != langid.UNKNOWN) & (found["score"] >= LANGUAGE_FLOOR))


def without_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that many documents share; n_chars follows the text."""
    prepare(spark)
    into = unused(docs, "_lines")
    out = lines.dedup_lines(docs, into=into)
    text = F.when(F.col("text").isNotNull(), F.col(into)["kept"].cast("string"))
    return out.withColumn("text", text).withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each group of near copies."""
    prepare(spark)
    return simhash.distinct_documents(docs).select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in windows of 4096 tokens."""
    prepare(spark)
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2)


STAGES = [("quality", good_quality), ("language", known_language), ("lines", without_shared_lines),
          ("near_copies", without_near_copies), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


#: Classifiers, fingerprints and packing cannot be stated in SQL; tests/llm/test_pipeline.py has the brute-force version.
ORACLE_SQL = None
