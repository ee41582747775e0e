"""The document pipeline: stages in order, each over all that its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lightfold.llm import chunks, jaccard, mixing, packing, toxicity
from lightfold.llm.scratch import drop, quoted, settled


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine scores under 0.7."""
    machine = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, machine).where("predicted = 0").select(*map(quoted, docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity of 0.8 or more): the smallest id."""
    return jaccard.one_of_each(docs, k=5, num=80, den=100)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that occur earlier; one of which nothing is left goes."""
    found = chunks.dedup_passages(docs)
    left = found.where((F.col("removed_words") == 0) | (F.length(F.trim("text")) > 0))
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.when(F.col("removed_words") == 0, F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
    return left.select(*map(quoted, docs.columns))


def target_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens have tempered shares of source, language and topic."""
    mixed = mixing.mix(docs, tokenizer=public_tokenizers.path("piece_bpe_32k.model"))
    return mixed.where("_kept").select(*map(quoted, docs.columns))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents in sequences of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxic_out),
    ("near duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("target weights", target_weights),
    ("packing", packed),
]
#: SQL cannot express the learned, hashed and fitted stages; they are tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next; what a stage wrote on its way is
    deleted with the stage's input, once its result is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        own = lambda: stage(spark, docs, sf_dir)  # noqa: B023, E731
        after = settled(own, name.replace(" ", "-")) if k < len(STAGES) - 1 else own()
        if 0 < k < len(STAGES) - 1:
            drop(docs)
        docs = after
    return docs
