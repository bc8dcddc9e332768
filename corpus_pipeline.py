"""A corpus pipeline: from raw documents to the token ids of a deduplicated, clean and weighted mix.

Each stage works on all that its predecessor kept and is written to the shared folder before the next one reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm import bpe, jaccard, mixing, quality, secrets
from wardflow.llm.common import prepare, staged, table

# Near duplicates of the pipeline: word five-grams, four fifths of them shared.
SHINGLE, PERCENT = 5, 80


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    prepare(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: that with the smallest doc_id."""
    prepare(spark)
    return jaccard.one_of_each_group(docs, n=SHINGLE, percent=PERCENT)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by the name of their kind; n_chars follows the text."""
    prepare(spark)
    clean = secrets.redacted(docs)
    return clean.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars")) if "n_chars" in clean.columns else clean


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    prepare(spark)
    return mixing.repeated(docs)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix, and digests of them and of the text decoded from them.

    One pass in Python: a second one would hold a worker with a vocabulary of its own for each task.
    """
    prepare(spark)
    return bpe.digests(docs, with_ids=True)


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("secret scans", secret_scans),
    ("mixing sources to target weights", source_mixing),
    ("BPE encoding and decoding", bpe_encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), "stage-" + name.split()[0])
    return STAGES[-1][1](spark, docs, sf_dir)


# The classifier and the components have no SQL; tests hold the stages against plain versions.
ORACLE_SQL = None
