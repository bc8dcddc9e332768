"""Row-count checkpoints over many tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def layer_counts(frames: Mapping[str, DataFrame], label: str = "layer") -> DataFrame:
    """One row per table with its row count, ordered by name. Each count reads no column at all."""
    parts = [df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias(label), "n_rows") for name, df in frames.items()]
    return reduce(DataFrame.unionByName, parts).orderBy(label)


def tag_coverage(tag_refs: DataFrame) -> DataFrame:
    """How many columns carry each tag."""
    columns = tag_refs.where(F.col("domain") == "COLUMN")
    return columns.groupBy("tag_name").agg(F.count("*").alias("tagged_columns")).orderBy("tag_name")
