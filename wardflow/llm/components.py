"""Connected components of links as Spark jobs: labels sink to the smallest of a component, by hooks and shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import staged


def components(links: DataFrame) -> DataFrame:
    """node and comp (the smallest node it can reach) for every node of ``links`` (columns a, b).

    Each round every node takes the smallest label among its neighbours, then the label of its label. Labels only sink,
    and paths halve by the shortcut. The tables of a round are written to the shared folder.
    """
    both = staged(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = staged(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("comp")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "comp"), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near"))
        hooked = labels.join(near, "node").select("node", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        onward = labels.select(F.col("node").alias("comp"), F.col("comp").alias("next"))
        moved = hooked.join(onward, "comp", "left").select("node", "old", F.least("comp", F.coalesce("next", "comp")).alias("comp"))
        moved = staged(moved, "labels")
        labels = moved.select("node", "comp")
        if not moved.where("comp <> old").limit(1).count():
            return labels
