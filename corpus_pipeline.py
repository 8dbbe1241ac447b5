"""A corpus pipeline of five stages, each calling one operator of ``statmart.llm`` on all that the one before has kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from statmart.llm import language, mixing, packing, secrets, simhash
from statmart.llm.queries import LIMIT, MIXTURE, domain
from statmart.llm.vocabulary import tokenizer_path
from statmart.session import checkpointed


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not told with confidence go; ``lang`` stays as it was given."""
    return language.accepted(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    return simhash.without_near_duplicates(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Random-looking credentials of one or two owners are masked; ``n_chars`` follows the text; no document goes."""
    masked = secrets.redacted(docs, F.col("source"), F.col("source"))
    return masked.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType)))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources by target weights: large ones give a prefix of an epoch, small ones several epochs."""
    return mixing.mixed(docs, domain(), MIXTURE)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences."""
    return packing.packed_documents(docs, tokenizer_path("word_bpe_49k.json"), LIMIT)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("secret_scan", secret_scan),
          ("source_mixing", source_mixing), ("best_fit_packing", best_fit_packing)]

# Trained models, XXH64 and a tokenizer's ids are beyond SQL: tests/llm holds the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = checkpointed(docs)
    return docs
