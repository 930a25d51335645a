"""A training corpus from documents: good ones, once each, without personal data, mixed, as token ids.

Each stage takes all that the one before it kept. ORACLE_SQL is None, as SQL can express neither the
classifier nor the tokenizer; tests/llm/test_pipeline.py holds the stages against brute force."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from covey.llm import bpe, mixing, neardup, pii, quality
from covey.shipping import shipped
from covey.storage import scratch, stored

ORACLE_SQL = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five words, a similarity of 0.8 or more."""
    return neardup.keep_first(docs, shingle=5, percent=80)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind."""
    columns = docs.columns
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*columns)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the sources' target weights, equal ones, ask for; a document may come several times."""
    return mixing.mix(docs).select(*docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each text, and digests of them and of the bytes that decoding them gives."""
    return bpe.round_trip(docs, keep_ids=True)


STAGES = [
    ("quality", shipped(good_quality)),
    ("near_duplicates", shipped(one_of_each)),
    ("personal_data", shipped(without_personal_data)),
    ("mixing", shipped(mixed_sources)),
    ("token_ids", shipped(token_ids)),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with scratch(spark):  # a stage's working tables go once its result is written
            docs = stored(stage(spark, docs, sf_dir), name, keep=True)
    return STAGES[-1][1](spark, docs, sf_dir)
