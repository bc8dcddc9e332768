"""A quality classifier: histogram gradient-boosted trees over statistics of the text.

Statistics of every whole text are computed by numpy, a block of texts at a time: byte classes, word lengths, repeated
words and word runs, lines. Trees are fitted on the driver from a bounded sample of labelled rows (``SAMPLE`` at most,
those with the smallest hash of their doc_id). Each feature is cut into bins once, the gradients are summed per bin, and
every tree is a perfect binary tree kept as three arrays, so scoring is a few gathers per level for a whole block.

NULL texts count as empty and get a score like any other. Labels that are NULL or belong to no document are left out; of
rows that share a doc_id each is scored by its own text. Without any label the score is 0.5. Rows with a NULL doc_id are
never held out and never learnt from. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.llm.common import chunks, release_kept, run_hashes, staged, text_bytes, whole_text, word_hashes

SAMPLE = 20_000  # labelled rows a model is fitted on, at most
THRESHOLD = 0.7
HELD_OUT = 2  # remainder of crc32(doc_id) by 4 that is never learnt from
TREES, DEPTH, BINS = 80, 4, 64
RATE, RIDGE, LEAST = 0.15, 1.0, 3.0  # step, L2 on leaves, least hessian in a leaf


# --- statistics ---


def _byte_classes() -> np.ndarray:
    """One column per class of bytes."""
    b = np.arange(256)
    letters = [chr(i) if i < 128 else "" for i in range(256)]
    return np.stack(
        [
            (b >= 65) & (b <= 90),
            (b >= 97) & (b <= 122),
            (b >= 48) & (b <= 57),
            b == 32,
            b == 10,
            b >= 128,
            np.isin(letters, list(".,;:")),
            np.isin(letters, list("!?")),
            np.isin(letters, list("|")),
            np.isin(letters, list("$%&*#@^~")),
            np.isin(letters, list("<>{}[]()\\/=_+")),
            np.isin(letters, list("\"'`-")),
            (b < 32) & ~np.isin(b, [9, 10, 13]) | (b == 127),
        ],
        axis=1,
    ).astype(np.float64)


_CLASSES = _byte_classes()


def _repeats(values: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each of n texts the number of different values and how often the most frequent one occurs."""
    key = np.sort((owner.astype(np.uint64) << np.uint64(40)) | (values >> np.uint64(24)))
    heads = np.flatnonzero(np.diff(key, prepend=np.uint64(2**64 - 1)) != 0) if len(key) else np.zeros(0, np.int64)
    counts = np.diff(np.append(heads, len(key)))
    whose = (key[heads] >> np.uint64(40)).astype(np.int64)
    most = np.zeros(n)
    np.maximum.at(most, whose, counts)
    return np.bincount(whose, minlength=n).astype(np.float64), most


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of numbers per text."""
    n, sizes = len(offsets) - 1, np.diff(offsets)
    owner = np.repeat(np.arange(n), sizes)
    counts = np.bincount(owner * 256 + data, minlength=n * 256).reshape(n, 256).astype(np.float64)
    size = np.maximum(sizes, 1).astype(np.float64)
    share = counts / size[:, None]
    entropy = -(share * np.log2(np.where(share > 0, share, 1.0))).sum(1)
    words, starts, stops, first = word_hashes(data, offsets)
    n_words = np.diff(first).astype(np.float64)
    some = np.maximum(n_words, 1)
    whose = np.repeat(np.arange(n), np.diff(first))
    length = (stops - starts).astype(np.float64)

    def total(values: np.ndarray) -> np.ndarray:
        return np.bincount(whose, weights=values, minlength=n)

    mean = total(length) / some
    spread = np.sqrt(np.maximum(total(length**2) / some - mean**2, 0))
    longest = np.zeros(n)
    np.maximum.at(longest, whose, length)
    head, tail = data[starts], data[stops - 1]
    plain_tail = (tail >= 65) & (tail <= 90) | (tail >= 97) & (tail <= 122) | (tail >= 128)
    same = np.zeros(len(words))
    same[1:] = (words[1:] == words[:-1]) & (whose[1:] == whose[:-1])
    different, most = _repeats(words, whose, n)
    runs = run_hashes(words, 4)
    inside = whose[: len(runs)] == whose[len(words) - len(runs) :]
    n_runs = np.bincount(whose[: len(runs)][inside], minlength=n).astype(np.float64)
    different_runs, _ = _repeats(runs[inside], whose[: len(runs)][inside], n)
    lines = counts[:, 10] + 1
    columns = [
        np.log1p(sizes),
        np.log1p(n_words),
        np.log1p(lines),
        entropy,
        mean,
        spread,
        longest,
        total((length <= 3).astype(np.float64)) / some,
        total((length >= 12).astype(np.float64)) / some,
        total(((head >= 65) & (head <= 90)).astype(np.float64)) / some,
        total((~plain_tail).astype(np.float64)) / some,
        total((length == 1).astype(np.float64)) / some,
        total(same) / some,
        different / some,
        most / some,
        np.where(n_runs > 0, different_runs / np.maximum(n_runs, 1), 1.0),
        n_words / lines,
        sizes / lines,
    ]
    return np.column_stack([*columns, share @ _CLASSES]).astype(np.float32)


# --- trees ---


@dataclass(frozen=True)
class Forest:
    """Perfect binary trees as arrays: inner nodes of one tree lie level by level, then come its leaves."""

    base: float
    feature: np.ndarray  # trees x inner nodes
    border: np.ndarray  # trees x inner nodes; greater values go right
    leaf: np.ndarray  # trees x leaves

    def margin(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, border, leaf in zip(self.feature, self.border, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(len(leaf).bit_length() - 1):
                node = 2 * node + 1 + (x[rows, feature[node]] > border[node])
            out += leaf[node - len(feature)]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-self.margin(x)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS) -> Forest:
    """Boost trees on the logistic loss; gradients are summed per node, feature and bin."""
    inner = 2**depth - 1
    rate = (y.sum() + 0.5) / (len(y) + 1.0)
    base = float(np.log(rate / (1 - rate)))
    if not len(y) or y.min() == y.max():
        return Forest(base, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    n, m = x.shape
    borders = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for j in range(m)]
    code = np.stack([np.searchsorted(b, x[:, j], side="left") for j, b in enumerate(borders)], axis=1)
    edge = np.full((m, bins), np.inf, np.float32)
    for j, b in enumerate(borders):
        edge[j, : len(b)] = b
    margin = np.full(n, base)
    flat = code + np.arange(m) * bins
    out_feature, out_border, out_leaf = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        feature, border = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            at = ((node - first)[:, None] * (m * bins) + flat).ravel()
            size = width * m * bins
            gs = np.bincount(at, np.repeat(g, m), size).reshape(width, m, bins).cumsum(2)
            hs = np.bincount(at, np.repeat(h, m), size).reshape(width, m, bins).cumsum(2)
            ga, ha = gs[:, :1, -1:], hs[:, :1, -1:]
            gain = gs**2 / (hs + RIDGE) + (ga - gs) ** 2 / (ha - hs + RIDGE) - ga**2 / (ha + RIDGE)
            gain[(hs < LEAST) | (ha - hs < LEAST)] = 0
            best = gain.reshape(width, -1).argmax(1)
            good = gain.reshape(width, -1)[np.arange(width), best] > 1e-9
            j, k = best // bins, best % bins
            feature[first : first + width] = np.where(good, j, 0)
            border[first : first + width] = np.where(good, edge[j, k], np.inf)
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > border[node])
        leaf = node - inner
        value = -RATE * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + RIDGE)
        margin += value[leaf]
        out_feature.append(feature)
        out_border.append(border)
        out_leaf.append(value)
    return Forest(base, np.array(out_feature), np.array(out_border), np.array(out_leaf))


# --- Spark ---


def held_out(doc_id: Column) -> Column:
    """Rows that are kept for measuring: crc32 of the doc_id as text leaves the fixed remainder."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == HELD_OUT, F.lit(False))


def _blocks(batch: pa.RecordBatch, at: int) -> Iterator[tuple[int, int, np.ndarray]]:
    data, offsets = text_bytes(batch.column(at))
    for a, b in chunks(offsets):
        yield a, b, statistics(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id and the statistics (array of float) of every text."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("stats", T.ArrayType(T.FloatType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_kept()
        for batch in batches:
            for a, b, x in _blocks(batch, 1):
                offsets = pa.array(np.arange(0, x.size + 1, x.shape[1]), pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.ListArray.from_arrays(offsets, pa.array(x.ravel()))], names=["doc_id", "stats"])

    return docs.select("doc_id", whole_text(text).alias("_text")).mapInArrow(run, schema)


def train(stats: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Forest:
    """Fit on at most ``sample`` labelled rows that are not held out."""
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.select(F.col("doc_id").alias("_labelled"), F.col("quality").cast("int").alias("_y"))
    rows = stats.join(known, stats.doc_id == F.col("_labelled")).select(F.xxhash64("doc_id").alias("_order"), "doc_id", "_y", "stats")
    rows = rows.orderBy("_order", "doc_id", "_y", "stats").limit(sample).toArrow()
    if not rows.num_rows:
        return fit(np.zeros((0, 1), np.float32), np.zeros(0))
    x = rows["stats"].combine_chunks()
    x = (x.chunk(0) if isinstance(x, pa.ChunkedArray) else x).flatten().to_numpy().reshape(rows.num_rows, -1)
    return fit(x, (rows["_y"].to_numpy() > 0).astype(np.float64))


def scores(stats: DataFrame, model: Forest, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of statistics."""
    schema = T.StructType([stats.schema["doc_id"], T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(x))], names=["doc_id", "score"])

    scored = stats.select("doc_id", "stats").mapInArrow(run, schema)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score every document with a model learnt from the labels; the texts are read once."""
    stats = staged(with_statistics(docs), "statistics")
    return scores(stats, train(stats, labels))


def keep_good(docs: DataFrame, labels: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose text scores at least ``threshold``, with all their columns."""
    model = train(staged(with_statistics(docs, text), "statistics"), labels)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            filled = batch.column(at).fill_null("")
            whole = pa.RecordBatch.from_arrays([filled], names=["t"])
            good = [model.score(x) >= threshold for _, _, x in _blocks(whole, 0)]
            if good:
                yield batch.filter(pa.array(np.concatenate(good)))

    return docs.mapInArrow(run, docs.schema)
