"""A corpus pipeline of five stages: language ID, near-dedup, benchmark
decontamination, secret removal and the mix of sources.

Every stage takes (spark, docs, sf_dir) and returns the documents that go on,
with the columns of ``documents``; the last returns the mix, one row per copy.
``run`` writes each stage's result as Parquet in the cluster's shared folder
and reads it again, so that a stage is never computed twice and a lost executor
costs no earlier stage.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import decontaminate, language, mixing, near_dup, secrets
from tidewater.llm._store import discard, settle


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are in no language go."""
    model = language.fit(docs.select("text", "lang"))
    return language.identify(docs, model).where(~F.col("rejected")).select(*docs.columns)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that of least id."""
    return near_dup.keep_one(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark phrase go."""
    benchmark = spark.read.parquet(os.path.join(sf_dir, "benchmark.parquet"))
    found = decontaminate.find_contamination(docs, benchmark)
    return found.where("n_hit = 0").select(*docs.columns)


def remove_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark, at whatever depth they are encoded;
    n_chars follows the text."""
    clean = secrets.redact_secrets(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as their source's target asks for, with the
    number of the copy."""
    return mixing.mix_sources(docs)


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", remove_near_duplicates),
    ("decontaminate", remove_benchmark),
    ("secret_scan", remove_secrets),
    ("mix_sources", mix),
]

#: trigram models, signatures and nested encodings are not SQL; tests compare
#: the stages with brute-force versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs, path = spark.read.parquet(os.path.join(sf_dir, "documents.parquet")), None
    for name, stage in STAGES:
        docs, written = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if path:
            discard(spark, path)
        path = written
    return docs
