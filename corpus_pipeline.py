"""From raw documents to a mixed training set: five stages, each writing what it keeps.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep the columns of
``documents``. ``run`` writes each result as Parquet below ``spark.checkpoint.dir`` and reads it again.
A stage handles null texts, ids and sources as its operator's docstring says; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rowloom.llm import decontaminate, langid, minhash, mixing, pii
from rowloom.session import materialize


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents with a language; the model learns from the stage's own labelled rows."""
    return langid.keep_identified(docs, docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates: five-word shingles, similarity of 0.8 or more."""
    return minhash.drop_near_duplicates(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages of the benchmark; drop documents that consist of them for the most part."""
    return decontaminate.remove_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask personal data and what gives it away."""
    return pii.sanitise(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that sources meet their target weights."""
    return mixing.mixed(docs)


STAGES = [
    ("language", language),
    ("deduplicate", deduplicate),
    ("decontaminate", remove_benchmark),
    ("personal_data", mask_personal_data),
    ("mix", mix_sources),
]
# trained, hashed and seeded stages have no SQL form; tests/llm compares the stages with plain Python on planted rows
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
