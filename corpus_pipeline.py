"""From raw documents to token ids: the stages in order, each written before the next one reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from churnloom.llm import byte_bpe, decontaminate, language_id, line_dedup, simhash
from churnloom.llm.common import materialize


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach; unreadable and undecided texts go."""
    return language_id.keep_known(docs)


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that their site repeats on a large share of its pages."""
    out = line_dedup.drop_boilerplate(docs)
    return out.select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    return byte_bpe.encode(docs, outputs=("n_tokens", "ids"), keep=("doc_id", "lang", "source"))


STAGES = [
    ("language_id", known_languages),
    ("line_dedup", without_boilerplate),
    ("simhash_neardup", one_of_each_group),
    ("decontaminate", without_benchmark),
    ("byte_bpe", token_ids),
]

#: Language ID is a trained network and byte-level BPE an iteration, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
