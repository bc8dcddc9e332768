"""Token counts from an exact histogram of encoded lengths.

Documents are encoded once, where they lie, and every task sends one row per length it met. From the histogram, suffix
sums answer for every context limit how many documents exceed it, how many tokens a cut at the limit keeps, and which
quantile of the lengths it is. Lengths are summed in blocks first, so no task sees more than one block of lengths plus
one row per block.

NULL texts count as empty (no tokens). An empty table gives an empty histogram. Repeated rows count as often as they occur.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from wardflow.llm.bpe import piece_pattern, vocabulary, vocabulary_path
from wardflow.llm.common import chunks, whole_text

BLOCK = 4096  # lengths per block of the suffix sums


def length_histogram(docs: DataFrame, by: Iterable[str] = (), text: str = "text", path: str | None = None) -> DataFrame:
    """Columns ``by``, n_tokens, n_docs: how many documents have each encoded length."""
    path, pattern, by = path or vocabulary_path(), piece_pattern(), list(by)
    schema = T.StructType([*[docs.schema[c] for c in by], T.StructField("n_tokens", T.LongType()), T.StructField("n_docs", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, counts, arrow = vocabulary(path, pattern), Counter(), []
        for batch in batches:
            texts = batch.column(len(by)).to_pylist()
            keys = list(zip(*[batch.column(i).to_pylist() for i in range(len(by))], strict=True)) if by else [()] * len(texts)
            arrow = [batch.schema.field(i).type for i in range(len(by))]
            ends = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
            for a, b in chunks(ends, 2_000_000):
                counts.update((*k, len(ids) // 4) for k, ids in zip(keys[a:b], vocab.packed(texts[a:b]), strict=True))
        if counts:
            columns = list(zip(*counts, strict=True))
            parts = [pa.array(c, t) for c, t in zip(columns, [*arrow, pa.int64()], strict=True)]
            yield pa.RecordBatch.from_arrays([*parts, pa.array(counts.values(), pa.int64())], names=schema.names)

    counted = docs.select(*by, whole_text(text).alias("_text")).mapInArrow(run, schema)
    return counted.groupBy(*by, "n_tokens").agg(F.sum("n_docs").alias("n_docs"))


def suffix_sums(histogram: DataFrame, by: Iterable[str] = ()) -> DataFrame:
    """For every length as a context limit: documents and tokens beyond it, tokens a cut keeps or drops, quantile.

    docs_over: longer documents; docs_within: the others; tokens_within: all tokens of those; tokens_kept: tokens left
    when every document is cut at the limit; tokens_cut: the rest; quantile: share of documents within.
    """
    by = list(by)
    rows = histogram.withColumn("_block", F.floor(F.col("n_tokens") / BLOCK)).withColumn("_tokens", F.col("n_tokens") * F.col("n_docs"))
    blocks = rows.groupBy(*by, "_block").agg(F.sum("n_docs").alias("_d"), F.sum("_tokens").alias("_t"))
    later = Window.partitionBy(*by).orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    group = Window.partitionBy(*by)
    blocks = blocks.select(
        *[F.col(c).alias(f"_b_{c}") for c in by],
        F.col("_block").alias("_b"),
        F.coalesce(F.sum("_d").over(later), F.lit(0)).alias("_docs_later"),
        F.coalesce(F.sum("_t").over(later), F.lit(0)).alias("_tokens_later"),
        F.sum("_d").over(group).alias("docs"),
        F.sum("_t").over(group).alias("tokens"),
    )
    inside = Window.partitionBy(*by, "_block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_docs_in", F.coalesce(F.sum("n_docs").over(inside), F.lit(0)))
    rows = rows.withColumn("_tokens_in", F.coalesce(F.sum("_tokens").over(inside), F.lit(0)))
    same = F.col("_block") == F.col("_b")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_b_{c}"))
    over, beyond = F.col("_docs_in") + F.col("_docs_later"), F.col("_tokens_in") + F.col("_tokens_later")
    kept = F.col("tokens") - beyond + F.col("n_tokens") * over
    return rows.join(blocks, same).select(
        *by,
        "n_tokens",
        "n_docs",
        over.alias("docs_over"),
        (F.col("docs") - over).alias("docs_within"),
        (F.col("tokens") - beyond).alias("tokens_within"),
        kept.alias("tokens_kept"),
        (F.col("tokens") - kept).alias("tokens_cut"),
        ((F.col("docs") - over) / F.col("docs")).alias("quantile"),
        "docs",
        "tokens",
    )


def at_limits(sums: DataFrame, limits: Iterable[int]) -> DataFrame:
    """Answers for any context limits, also for lengths that no document has (for one group, without ``by``)."""
    limit = F.explode(F.array(*[F.lit(int(x)).cast("long") for x in limits]))
    within = F.col("n_tokens") <= F.col("context_limit")

    def over(value: Column) -> Column:
        return F.coalesce(F.sum(F.when(~within, value)), F.lit(0))

    rows = sums.select("n_tokens", "n_docs", "docs", "tokens").withColumn("context_limit", limit)
    docs_over, beyond = over(F.col("n_docs")), over(F.col("n_docs") * F.col("n_tokens"))
    out = rows.groupBy("context_limit").agg(docs_over.alias("docs_over"), beyond.alias("_beyond"), F.first("docs").alias("docs"), F.first("tokens").alias("tokens"))
    kept = F.col("tokens") - F.col("_beyond") + F.col("context_limit") * F.col("docs_over")
    return out.select("context_limit", "docs_over", kept.alias("tokens_kept"), (F.col("tokens") - kept).alias("tokens_cut"))


def quantiles(sums: DataFrame, shares: Iterable[float]) -> DataFrame:
    """The smallest length that at least a share of the documents does not exceed (for one group)."""
    share = F.explode(F.array(*[F.lit(float(x)) for x in shares]))
    rows = sums.select("n_tokens", "quantile").withColumn("share", share).where(F.col("quantile") >= F.col("share"))
    return rows.groupBy("share").agg(F.min("n_tokens").alias("n_tokens"))
