"""Stretches of a text that repeat with a period, found by the branching-tandem test over an enhanced suffix array.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) that no neighbouring word
extends keeping that period; reported are runs of at least ``MINIMUM`` words and ``TIMES`` periods. Where a run ends, the
suffixes q apart share exactly q words, so they part at an LCP interval of depth q. Every boundary of the suffix array
parts an interval in two; each suffix i of the smaller part looks up whether suffix i + depth or i - depth lies in the
other part. Such a pair is a square that cannot be moved on; it is rotated back as far as words agree, and squares of one
stretch become one run with the smallest period. There are no tree nodes: intervals come from next smaller values.

The symbols of a suffix array are (text, word), so many texts share one array and no match crosses a text. A text in which
no stretch of 16 words (for runs of 24 words and 3 periods) occurs twice has no such run, whatever its period, so only
the others are sorted; words of those are told apart by their bytes.

NULL and empty texts have no words and no runs. A text of any length is one piece of work; its arrays take some 150 bytes
a word. Rows are worked on one by one, so repeated rows and rows without an id get their own results. An empty table
gives no rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.llm.common import chunks, run_hashes, text_bytes, whole_text, word_hashes

MINIMUM, TIMES = 24, 3
LOOKUPS = 2_000_000  # suffixes that one pass looks up
SORTED = 256 * 1024  # bytes of text that share a suffix array

RUNS = T.ArrayType(
    T.StructType([T.StructField(n, T.LongType(), False) for n in ("start", "length", "period")]),
    False,
)


# --- the enhanced suffix array ---


def suffix_array(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Suffixes in order, the place of each, and per k the class of the 2**k symbols from every position.

    Classes are first places, so those of suffixes that stand alone are final; only groups are sorted again.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    fresh = np.ones(n, bool)
    fresh[1:] = symbols[order[1:]] != symbols[order[:-1]]
    place = np.empty(n, np.int64)
    place[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    classes, step = [place.astype(np.int32)], 1
    grouped = np.flatnonzero(~(fresh & np.append(fresh[1:], True)))
    while len(grouped):
        at = order[grouped]
        behind = at + step
        key = place[at] * (n + 1) + np.where(behind < n, place[np.minimum(behind, n - 1)] + 1, 0)
        by_key = np.argsort(key, kind="stable")
        at, key = at[by_key], key[by_key]
        order[grouped] = at
        fresh = np.ones(len(at), bool)
        fresh[1:] = key[1:] != key[:-1]
        place[at] = grouped[np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))]
        grouped = grouped[~(fresh & np.append(fresh[1:], True))]
        classes.append(place.astype(np.int32))
        step *= 2
    return order, place, classes


def common_prefixes(order: np.ndarray, classes: list[np.ndarray]) -> np.ndarray:
    """Symbols that the suffix in each place shares with the one before; -1 before the first and behind the last."""
    n = len(order)
    lcp = np.zeros(n + 1, np.int64)
    lcp[[0, n]] = -1
    close = np.flatnonzero(classes[0][order[1:]] == classes[0][order[:-1]]) + 1
    i, j, shared = order[close - 1].copy(), order[close].copy(), np.zeros(len(close), np.int64)
    for k in range(len(classes) - 1, -1, -1):
        inside = np.flatnonzero(np.maximum(i, j) < n)
        same = inside[classes[k][i[inside]] == classes[k][j[inside]]]
        i[same] += 1 << k
        j[same] += 1 << k
        shared[same] += 1 << k
    lcp[close] = shared
    return lcp


def nearest_smaller(lcp: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For boundaries ``at``: the last one before with a smaller value, the next one with a smaller or equal value.

    All pointers leap together over what the one they point to has leapt over, so stretches double.
    """
    before, after = np.arange(-1, len(lcp) - 1), np.arange(1, len(lcp) + 1)
    todo = at[lcp[before[at]] >= lcp[at]]
    while len(todo):
        before[todo] = before[before[todo]]
        todo = todo[lcp[before[todo]] >= lcp[todo]]
    todo = at[lcp[after[at]] > lcp[at]]
    while len(todo):
        after[todo] = after[after[todo]]
        todo = todo[lcp[after[todo]] > lcp[todo]]
    return before[at], after[at]


def branching_squares(order: np.ndarray, place: np.ndarray, lcp: np.ndarray, longest: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Starts and depths of squares whose halves' suffixes part right behind them; depths up to ``longest`` of the place."""
    n = len(order)
    at = np.flatnonzero(lcp[:n] > 0)
    low, high = nearest_smaller(lcp, at)
    fits = lcp[at] <= longest[at]
    at, low, high = at[fits], low[fits], high[fits]
    left = at - low <= high - at
    first, size = np.where(left, low, at), np.where(left, at - low, high - at)
    other, end = np.where(left, at, low), np.where(left, high, at)
    depth, until = lcp[at], np.cumsum(size)
    a = 0
    while a < len(at):
        b = max(a + 1, int(np.searchsorted(until, (until[a - 1] if a else 0) + LOOKUPS, side="right")))
        which = np.repeat(np.arange(a, b), size[a:b])
        within = np.arange(len(which)) - np.repeat(until[a:b] - size[a:b] - (until[a - 1] if a else 0), size[a:b])
        i, d = order[first[which] + within], depth[which]
        for partner, start in ((i + d, i), (i - d, i - d)):
            known = np.flatnonzero((partner >= 0) & (partner < n))
            slot = place[partner[known]]
            hit = known[(slot >= other[which[known]]) & (slot < end[which[known]])]
            yield start[hit], d[hit]
        a = b


def rotated_back(starts: np.ndarray, periods: np.ndarray, classes: list[np.ndarray]) -> np.ndarray:
    """By how many words each square can be moved back, word by word."""
    moved = np.zeros(len(starts), np.int64)
    for k in range(len(classes) - 1, -1, -1):
        to = starts - moved - (1 << k)
        inside = np.flatnonzero(to >= 0)
        same = inside[classes[k][to[inside]] == classes[k][to[inside] + periods[inside]]]
        moved[same] += 1 << k
    return moved


def runs_of(symbols: np.ndarray, sizes: np.ndarray, minimum: int = MINIMUM, times: int = TIMES) -> np.ndarray:
    """Rows (start, length, period) by start, then period, of all runs; symbols of different texts differ.

    ``sizes``: how many symbols the text of each symbol has.
    """
    order, place, classes = suffix_array(symbols)
    lcp = common_prefixes(order, classes)
    found = []
    for starts, periods in branching_squares(order, place, lcp, sizes[order] // max(2, times)):
        moved = rotated_back(starts, periods, classes)
        length = moved + 2 * periods
        long_enough = (length >= minimum) & (length >= times * periods)
        found.append(np.stack([starts - moved, length, periods], axis=1)[long_enough])
    runs = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    # A stretch with period q also has squares of 2q, 3q: of those that cover the same words the smallest counts.
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    first = np.ones(len(runs), bool)
    first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[first]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


# --- texts ---


def repeated_words(minimum: int, times: int) -> int:
    """Words that the halves of a run, one period apart, share at least: the length less the period."""
    return max(1, min(max(minimum - q, times * q - q) for q in range(1, minimum + 1)))


def may_repeat(hashes: np.ndarray, owner: np.ndarray, n_texts: int, window: int) -> np.ndarray:
    """Which texts hold some window of words twice; by hashes, so none that does is missed."""
    grams = run_hashes(hashes, window)
    whole = owner[: len(grams)] == owner[window - 1 :] if len(grams) else np.zeros(0, bool)
    grams, owner = grams[whole], owner[: len(grams)][whole]
    order = np.lexsort((grams, owner))
    grams, owner = grams[order], owner[order]
    twice = owner[1:][(grams[1:] == grams[:-1]) & (owner[1:] == owner[:-1])]
    out = np.zeros(n_texts, bool)
    out[twice] = True
    return out


def runs_of_texts(data: np.ndarray, offsets: np.ndarray, minimum: int = MINIMUM, times: int = TIMES) -> list[np.ndarray]:
    """Runs of each text, as rows (start, length, period) in words of the text."""
    n = len(offsets) - 1
    out = [np.zeros((0, 3), np.int64)] * n
    hashes, _, _, first = word_hashes(data, offsets)
    owner = np.repeat(np.arange(n), np.diff(first))
    wanted = np.flatnonzero(may_repeat(hashes, owner, n, repeated_words(minimum, times)))
    del hashes, owner
    bounds = np.concatenate([[0], np.cumsum(offsets[wanted + 1] - offsets[wanted])])
    for a, b in chunks(bounds, SORTED):
        own = wanted[a:b]
        words = [data[offsets[t] : offsets[t + 1]].tobytes().split() for t in own]
        counts = np.array([len(w) for w in words])
        names, distinct = pd.factorize(np.array([x for w in words for x in w], dtype=object))
        runs = runs_of(np.repeat(np.arange(len(own)), counts) * len(distinct) + names, np.repeat(counts, counts), minimum, times)
        begins = np.concatenate([[0], np.cumsum(counts)])
        cuts = np.searchsorted(runs[:, 0], begins)
        for i, t in enumerate(own):
            out[t] = runs[cuts[i] : cuts[i + 1]] - [begins[i], 0, 0]
    return out


def collapsed(text: bytes, runs: np.ndarray) -> bytes:
    """The words, joined by one space, without those behind the first period of a run."""
    words = text.split()
    if len(runs):
        change = np.zeros(len(words) + 1, np.int64)
        np.add.at(change, runs[:, 0] + runs[:, 2], 1)
        np.add.at(change, runs[:, 0] + runs[:, 1], -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]
    return b" ".join(words)


def _per_text(docs: DataFrame, text: str, id_column: str, fields: list[T.StructField], row, minimum: int, times: int) -> DataFrame:
    schema = T.StructType([docs.schema[id_column], *fields])
    types = [T.StructType([f]) for f in fields]
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = [to_arrow_schema(t).field(0).type for t in types]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for a, b in chunks(offsets):
                part, own = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                raw = part.tobytes()
                rows = [row(raw[own[i] : own[i + 1]], runs) for i, runs in enumerate(runs_of_texts(part, own, minimum, times))]
                columns = list(zip(*rows, strict=True)) or [()] * len(fields)
                arrays = [pa.array(c, t) for c, t in zip(columns, arrow, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *arrays], names=schema.names)

    return docs.select(id_column, whole_text(text).alias("_text")).mapInArrow(work, schema)


def periodic_runs(docs: DataFrame, text: str = "text", id_column: str = "doc_id", minimum: int = MINIMUM, times: int = TIMES) -> DataFrame:
    """The id of every row, its runs by start and period, and the text left when all but one period of each is dropped."""

    def row(raw: bytes, runs: np.ndarray) -> tuple:
        return [dict(zip(("start", "length", "period"), r, strict=True)) for r in runs.tolist()], collapsed(raw, runs).decode("utf-8")

    fields = [T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType())]
    return _per_text(docs, text, id_column, fields, row, minimum, times)


def digests(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """The number of runs, the run with the greatest exponent, and digests of all runs and of the collapsed text."""

    def row(raw: bytes, runs: np.ndarray) -> tuple:
        best = [None] * 4
        if len(runs):
            # Exact comparison of length / period: ties go to the smallest start, then period.
            s, n, q = 0, 0, 1
            for start, length, period in runs.tolist():
                if length * q > n * period:
                    s, n, q = start, length, period
            best = [s, n, q, 1000 * n // q]
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs.tolist())
        return len(runs), *best, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapsed(raw, runs)).hexdigest()

    longs = ["n_runs", "start", "length", "period", "exponent_milli"]
    fields = [T.StructField(n, T.LongType()) for n in longs] + [T.StructField(n, T.StringType()) for n in ("runs_sha256", "collapsed_sha256")]
    return _per_text(docs, text, id_column, fields, row, MINIMUM, TIMES)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text; of every tenth document by the hash of its id, the words behind some place repeat with a period.

    With h the CRC-32 of the decimal id, g = h div 10 and n words: where h is divisible by 10, each word i from
    a = g % n on becomes word a + (i - a) % p, with p = 1 + (n - a) div (3 + g % 8). Rows without an id stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    planted = F.expr(
        "transform(sequence(0, size(_w) - 1), i -> _w[if(i < _a, i, _a + (i - _a) % _p)])"
    )
    # Words are taken only of the documents that change: the condition stands before everything else.
    words = F.when(h % 10 == 0, F.regexp_extract_all(whole_text(), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    split = docs.select("doc_id", "text", words.alias("_w"), F.floor(h / 10).alias("_g"))
    start = split.withColumn("_a", F.expr("if(size(_w) > 0, cast(_g % size(_w) as int), 0)"))
    period = start.withColumn("_p", F.expr("cast(1 + (size(_w) - _a) div (3 + _g % 8) as int)"))
    return period.select("doc_id", F.when(F.expr("size(_w) > 0"), F.array_join(planted, " ")).otherwise(F.col("text")).alias("text"))
