"""The corpus pipeline: documents with a known language, without shared lines, near copies and
benchmark passages, mixed to target weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.llm import decontam, langid, linededup, mixing, simhash
from kinweave.runtime import materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; one with no letters, or with no language for half its words, goes."""
    return langid.reject_unidentified(docs, langid.train(docs))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines they share with two others or more, but for one holder; n_chars follows."""
    kept = linededup.drop_repeated_lines(docs)
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near copies."""
    return simhash.keep_representatives(docs).select(*docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    tests = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontam.decontaminate(docs, tests).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the mix takes of every document that is left."""
    return mixing.mix(docs)


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near_copies", near_copies),
    ("benchmark", benchmark),
    ("mixture", mixture),
]

#: Learned labels, fingerprints and hashed orders have no SQL; the tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each works on the table that the one before has written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
