"""The operators' queries over whole tables, with production parameters, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chunks, counts, jaccard, mixing, packing, ppm, preferences, search, toxicity, winnowing


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    machine = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    held_out = toxicity.remainder("doc_id", 3) == 1
    return toxicity.score(docs.select("doc_id", held_out.alias("held_out"), "text"), machine).drop("text")


def op2_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries are the documents whose id 100 divides, each by all terms of its whole text."""
    docs = _table(spark, sf_dir, "documents")
    return search.search(search.build(docs), docs.where("doc_id % 100 = 0"))


def op3_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table states no preference: conversation 2i is taken as chosen and 2i + 1 as rejected."""
    turns = _table(spark, sf_dir, "conversations")
    pair, rejected = F.floor(F.col("conv_id") / 2).alias("pair_id"), (F.col("conv_id") % 2 == 1).alias("rejected")
    return preferences.format_preferences(turns.select(pair, rejected, "turn", "role", "text"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_components(_table(spark, sf_dir, "documents"), k=3, num=90, den=100)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.dedup_passages(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    mixed = mixing.mix(docs, tokenizer=public_tokenizers.path("piece_bpe_32k.model"), with_text=False)
    return mixed.select("doc_id", "source", "lang", *(mixed[f"_{c}"].alias(c) for c in ("topic", "tokens", "probability", "kept")))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op9_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.fingerprints(_table(spark, sf_dir, "documents"))


def op10_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.lm_scores(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_toxicity, op2_topk_search, op3_preferences, op4_packing, op5_jaccard_join, op6_substring_dedup, op7_mixing, op8_token_counts, op9_winnowing, op10_lm_scores)
}
ORACLES: dict[str, str] = {"op3_preferences": preferences.ORACLE}
