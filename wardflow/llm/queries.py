"""Named queries over the supplied tables, one per operator, with production settings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm import (
    bpe,
    bytewindows,
    exactdedup,
    importance,
    jaccard,
    mixing,
    neighbours,
    orderhash,
    periodicruns,
    quality,
    secrets,
    tokens,
    wordwindows,
)
from wardflow.llm.common import prepare, staged, table
from wardflow.llm.oracles import ORACLES


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Staged: the sums read the histogram twice, and the texts shall be encoded once.
    return tokens.suffix_sums(staged(tokens.length_histogram(table(spark, sf_dir, "documents")), "lengths"))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.grouped(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("key")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orderhash.compared(table(spark, sf_dir, "documents"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(secrets.scan(table(spark, sf_dir, "documents")))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"))


def op8_word_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordwindows.digests(table(spark, sf_dir, "documents"))


def op10_byte_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytewindows.digests(table(spark, sf_dir, "documents"))


def op9_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodicruns.digests(periodicruns.with_planted_runs(table(spark, sf_dir, "documents")))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdedup.duplicates(table(spark, sf_dir, "documents"))


def _ready(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: fn(prepare(spark), sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: _ready(fn) for name, fn in list(globals().items()) if name.startswith("op") and name[2].isdigit()
}

__all__ = ["ORACLES", "QUERIES"]
