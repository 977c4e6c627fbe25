"""A corpus of documents made ready for training, stage by stage.

Each stage takes (spark, docs, folder) and returns a table that is written and read again as the next one's documents. All but the last
return the columns they were given.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ctrprep.llm import bpe, decontaminate, minhash, pii, toxicity
from ctrprep.sources.scratch import store


def without_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents whose sentences are all clean, by a model fitted to the labelled ones among them."""
    model = toxicity.train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    return toxicity.drop_toxic(docs, model)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near duplicates, which share four fifths of their five-word shingles."""
    return minhash.drop_near_duplicates(docs)


def without_benchmarks(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Contaminated documents go; from the others, benchmark passages are cut."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{folder}/benchmark.parquet"))


def without_personal_data(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Personal data replaced by its kind."""
    return pii.redact(docs)


def encoded(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The token ids of each document, their number, and digests of the ids and of the text they decode to."""
    return bpe.digests(bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json")), ids=True)


STAGES = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_near_duplicates),
    ("decontamination", without_benchmarks),
    ("personal_data", without_personal_data),
    ("bpe", encoded),
]

#: SQL can express neither the fitted classifier nor byte-pair encoding; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, folder), f"stage-{name}")
    return docs
