"""Importance resampling towards a target corpus, over hashed word features that an Aho-Corasick automaton emits.

A feature is a run of 1 to ``n`` consecutive words joined by one space; its bucket is the CRC-32 of its bytes modulo
``buckets``. The dictionary of the automaton holds distinct words, each between two blanks, with CRC and length as payload.
One scan of a piece of text emits the payloads of its words; the CRC of a longer run comes from the payloads of its parts
alone (a CRC behind L more bytes is a linear map of the one before), so no feature is ever put together as a string.
Each worker fills its dictionary with the words it meets, up to ``WORDS``, and keeps it from task to task; a word that it
lacks gets the same payload on the spot, so the dictionary changes the speed and never a result.

Buckets are written once, counted for both corpora, and scored from there: the gain of a bucket is
floor(1000 * ln((t + 1) * (S + buckets) / ((s + 1) * (T + buckets)))), a document weighs the floored mean gain of its
features, and Gumbel noise of its id is added, so the highest scores are a draw without replacement.

Words are runs of letters a-z (A-Z in lower case), digits and all characters beyond ASCII, of whole texts of any length.
NULL and empty texts have no features and weigh 0; texts of fewer than ``LEAST`` words are scored, never drawn. A row
without an id gets the noise of the text "null" and comes last among ties; repeated rows get ranks of their own. An empty
target or corpus is counted as zeros; an empty table gives no rows. Columns other than id and text are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import chunks, keeps, staged, text_bytes, whole_text

BUCKETS = 10_000
GRAMS = 1
LEAST = 20
PERCENT = 10
SEED = 2024
WORDS = 120_000  # words of a dictionary at most
FRESH = 2_000  # new words met before the automaton is made again, or a quarter of those it has

_POLYNOMIAL = 0xEDB88320  # fixed value: CRC-32 in reversed bit order
_LOW = np.uint32(0xFF)


# --- CRCs of runs from CRCs of their parts ---


def _apply(table: np.ndarray, x: np.ndarray) -> np.ndarray:
    """A linear map of 32 bits, given by what it makes of each byte in each of the four places."""
    return table[0][x & _LOW] ^ table[1][(x >> np.uint32(8)) & _LOW] ^ table[2][(x >> np.uint32(16)) & _LOW] ^ table[3][x >> np.uint32(24)]


def _moves() -> list[np.ndarray]:
    """Maps that carry a CRC behind 1, 2, 4, ... zero bytes; each is the one before, twice."""
    byte = np.arange(256, dtype=np.uint32)
    step = byte
    for _ in range(8):
        step = np.where(step & np.uint32(1), (step >> np.uint32(1)) ^ np.uint32(_POLYNOMIAL), step >> np.uint32(1))
    maps = [np.stack([step, byte, byte << np.uint32(8), byte << np.uint32(16)])]
    while len(maps) < 31:
        maps.append(np.stack([_apply(maps[-1], row) for row in maps[-1]]))
    return maps


_MOVES = _moves()


def appended(first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of two strings behind each other, of the CRC-32 of either and the bytes of the second."""
    out = first.copy()
    for k in range(int(length.max(initial=0)).bit_length()):
        mine = np.flatnonzero((length >> k) & 1)
        out[mine] = _apply(_MOVES[k], out[mine])
    return out ^ second


# --- the dictionary ---


# How a byte of UTF-8 counts: delimiters become blanks, A-Z lower case, all else stays.
def _folding() -> np.ndarray:
    out = np.arange(256, dtype=np.uint8)
    out[65:91] += 32
    word = np.zeros(256, bool)
    word[48:58] = word[97:123] = word[128:] = True
    out[~word[out]] = 32
    return out


_FOLDED = _folding()


class Dictionary:
    """Delimited words with payloads (CRC, and length above it), as an automaton."""

    def __init__(self, limit: int = WORDS, step: int = FRESH) -> None:
        self.limit, self.step = limit, step
        self.known: dict[str, int] = {}
        self.fresh: dict[str, int] = {}
        self.automaton: ahocorasick.Automaton | None = None

    def _learn(self) -> None:
        self.known |= self.fresh
        self.fresh = {}
        made = ahocorasick.Automaton()
        for word, payload in self.known.items():
            made.add_word(f" {word} ", payload)
        made.make_automaton()
        self.automaton = made

    def payloads(self, folded: str, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """The payload of every word of ``folded``, one character a byte, with a blank before and behind each word."""
        out = np.full(len(starts), -1, np.int64)
        if self.automaton is not None:
            emitted = np.fromiter(chain.from_iterable(self.automaton.iter(folded)), np.int64).reshape(-1, 2)
            out[np.searchsorted(stops, emitted[:, 0])] = emitted[:, 1]
        missing = np.flatnonzero(out < 0)
        rest = np.empty(len(missing), np.int64)
        for i, (a, b) in enumerate(zip(starts[missing].tolist(), stops[missing].tolist(), strict=True)):
            word = folded[a:b]
            payload = self.fresh.get(word)
            if payload is None:
                payload = zlib.crc32(word.encode("latin-1")) | (b - a) << 32
                if len(self.known) + len(self.fresh) < self.limit:
                    self.fresh[word] = payload
            rest[i] = payload
        out[missing] = rest
        if self.fresh and len(self.fresh) >= max(self.step, len(self.known) // 4):
            self._learn()
        return out


_DICTIONARIES: dict[tuple[int, int], Dictionary] = {}


def kept_dictionary(limit: int = WORDS, step: int = FRESH) -> Dictionary:
    """The dictionary of this worker, with what it learned in earlier tasks."""
    keeps("word dictionary", _DICTIONARIES.clear)
    return _DICTIONARIES.setdefault((limit, step), Dictionary(limit, step))


def text_buckets(data: np.ndarray, offsets: np.ndarray, grams: int, buckets: int, words: Dictionary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all features, the first of each text, and the words of each text. Every text ends in a delimiter."""
    folded = np.empty(len(data) + 1, np.uint8)
    folded[0] = 32
    folded[1:] = _FOLDED[data]
    blank = folded == 32
    starts = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
    stops = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    payload = words.payloads(folded.tobytes().decode("latin-1"), starts, stops)
    crc, length = (payload & 0xFFFFFFFF).astype(np.uint32), payload >> 32
    first = np.searchsorted(starts, offsets + 1)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    rows, owners = [crc % np.uint32(buckets)], [owner]
    behind = appended(np.full(len(crc), zlib.crc32(b" "), np.uint32), crc, length) if grams > 1 else crc
    run = crc
    for n in range(2, grams + 1):
        if len(crc) < n:
            break
        run = appended(run[:-1], behind[n - 1 :], length[n - 1 :] + 1)
        whole = owner[: len(run)] == owner[n - 1 :]
        rows.append((run % np.uint32(buckets))[whole])
        owners.append(owner[: len(run)][whole])
    found, owners = np.concatenate(rows), np.concatenate(owners)
    if grams > 1:
        found, owners = found[(by_text := np.argsort(owners, kind="stable"))], owners[by_text]
    return found, np.searchsorted(owners, np.arange(len(offsets))), np.diff(first)


def _stored(buckets: int) -> str:
    return "<u2" if buckets <= 2**16 else "<u4"


def features(docs: DataFrame, keys: tuple[str, ...] = ("doc_id",), text: str = "text", grams: int = GRAMS, buckets: int = BUCKETS, words: int = WORDS, fresh: int = FRESH) -> DataFrame:
    """``keys``, n_words, n_features and the buckets of all features, as little-endian numbers behind each other."""
    kind = _stored(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = kept_dictionary(words, fresh)
        for batch in batches:
            data, offsets = text_bytes(batch.column(len(keys)))
            for a, b in chunks(offsets):
                found, first, n_words = text_buckets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], grams, buckets, known)
                body = pa.py_buffer(found.astype(kind).tobytes())
                cuts = pa.py_buffer((first * int(kind[2])).astype(np.int64).tobytes())
                packed = pa.Array.from_buffers(pa.large_binary(), b - a, [None, cuts, body]).cast(pa.binary())
                columns = [*[batch.column(i).slice(a, b - a) for i in range(len(keys))], pa.array(n_words, pa.int64()), pa.array(np.diff(first), pa.int64()), packed]
                yield pa.RecordBatch.from_arrays(columns, names=[*keys, "n_words", "n_features", "buckets"])

    schema = ", ".join(f"{k} {docs.schema[k].dataType.simpleString()}" for k in keys)
    # A blank behind every text keeps the words of neighbours apart.
    source = docs.select(*keys, F.concat(whole_text(text), F.lit(" ")).alias("_text"))
    return source.mapInArrow(run, ", ".join([*([schema] if schema else []), "n_words long, n_features long, buckets binary"]))


def bucket_counts(found: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket and n: how many features lie in each bucket that has any. A task sends a row per bucket at most."""
    kind = _stored(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(text_bytes(batch.column(0))[0].view(kind), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some], pa.int64())], names=["bucket", "n"])

    return found.select("buckets").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of every bucket. The tables have a row per bucket at most, whatever they were counted from."""
    counts = []
    for counted in (corpus, target):
        n = np.zeros(buckets, np.int64)
        for bucket, found in counted.collect():
            n[bucket] = found
        counts.append(n)
    all_s, all_t = (float(int(c.sum()) + buckets) for c in counts)
    return np.array([math.floor(1000 * math.log((t + 1.0) * all_s / ((s + 1.0) * all_t))) for s, t in zip(*(c.tolist() for c in counts), strict=True)], np.int64)


def weighted(found: DataFrame, gain: np.ndarray, buckets: int = BUCKETS) -> DataFrame:
    """All columns of ``found`` but the buckets, and weight: the floored mean gain of the features."""
    kind, names = _stored(buckets), [c for c in found.columns if c != "buckets"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(len(names)))
            total = np.concatenate([[0], np.cumsum(gain[data.view(kind)])])
            ends = offsets // int(kind[2])
            n = np.diff(ends)
            weight = (total[ends[1:]] - total[ends[:-1]]) // np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(weight, pa.int64())], names=[*names, "weight"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found.schema if f.name != "buckets")
    return found.select(*names, "buckets").mapInArrow(run, f"{schema}, weight long")


# --- the draw ---


def noisy(rows: DataFrame, seed: int = SEED, id_column: str = "doc_id") -> DataFrame:
    """With score: the weight plus Gumbel noise of the id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000.0 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    return rows.withColumn("score", F.col("weight") + noise)


def drawn(rows: DataFrame, least: int = LEAST, percent: int = PERCENT, id_column: str = "doc_id") -> DataFrame:
    """With rank: 1, 2, ... for the floor(percent * N / 100) highest scores of the N rows with enough words, else NULL.

    Scores are whole numbers of a narrow range, so a histogram tells the lowest score that can be drawn; the rows from
    there on are sorted by range over all tasks and numbered by the sizes of the ranges.
    """
    spark = rows.sparkSession
    enough = F.col("n_words") >= least
    histogram = rows.where(enough).groupBy("score").count().orderBy(F.desc("score")).collect()
    wanted = percent * sum(r["count"] for r in histogram) // 100
    lowest, seen = None, 0
    for r in histogram:
        if seen >= wanted:
            break
        lowest, seen = r["score"], seen + r["count"]
    high = F.lit(False) if lowest is None else enough & (F.col("score") >= lowest)
    order = [F.desc("score"), F.asc_nulls_last(id_column)]
    ordered = staged(rows.where(high).orderBy(*order).withColumn("_n", F.monotonically_increasing_id()), "drawn")
    part = F.shiftright("_n", 33)
    sizes = sorted(ordered.groupBy(part.alias("part")).count().collect())  # a row per task
    begins, total = [], 0
    for part_id, n in sizes:
        begins.append((part_id, total))
        total += n
    starts = spark.createDataFrame(begins, "part long, begin long")
    ranked = ordered.join(F.broadcast(starts), part == F.col("part")) if len(begins) <= 10_000 else ordered.join(starts, part == F.col("part"))
    rank = F.col("begin") + F.col("_n").bitwiseAND(2**33 - 1) + 1
    above = ranked.select(*rows.columns, F.when(rank <= wanted, rank).alias("rank"))
    return above.unionByName(rows.where(~high).withColumn("rank", F.lit(None).cast("long")))


def resampled(docs: DataFrame, target: DataFrame, text: str = "text", id_column: str = "doc_id", target_text: str = "text", grams: int = GRAMS, buckets: int = BUCKETS, seed: int = SEED, least: int = LEAST, percent: int = PERCENT, words: int = WORDS, fresh: int = FRESH) -> DataFrame:
    """Per document id, n_features, weight, score and rank; the drawn documents are those with a rank."""
    found = staged(features(docs, (id_column,), text, grams, buckets, words, fresh), "features")
    aimed = features(target, (), target_text, grams, buckets, words, fresh)
    gain = gains(bucket_counts(found, buckets), bucket_counts(aimed, buckets), buckets)
    scored = staged(noisy(weighted(found, gain, buckets), seed, id_column), "scored")
    return drawn(scored, least, percent, id_column).select(id_column, "n_features", "weight", "score", "rank")
