"""Helpers that several operators share: staged tables, whole texts as numpy bytes, word hashes, interval unions."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.session import new_workspace

# What separates words, [\x20\x09-\x0D].
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
WORD = r"[^\x20\x09-\x0D]+"
# Batches handed to Python stay small, whatever the length of the texts.
BATCH_ROWS = 1000
BATCH_BYTES = 8 * 1024 * 1024
# Bytes of text that one numpy pass works on; longer texts are cut, with as much overlap as the pass needs.
CHUNK = 1024 * 1024

_U = np.uint64
_BYTE_HASH = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64)
_BASE = _U(0x9E3779B97F4A7C15)
_BASE_INV = _U(pow(0x9E3779B97F4A7C15, -1, 2**64))


# What a Python worker keeps from task to task, and how to let go of it: workers are shared by all operators.
_KEPT: dict[str, Callable[[], None]] = {}


def keeps(name: str, forget: Callable[[], None]) -> None:
    _KEPT[name] = forget


def release_kept() -> None:
    """Called where an operator needs the memory of the worker for itself; what was kept goes back to the machine."""
    if not _KEPT:
        return
    for forget in _KEPT.values():
        forget()
    _KEPT.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another allocator than glibc's
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings the operators rely on; limits for broadcasts stay as the session has them."""
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it again: the lineage ends there and a lost executor costs nothing."""
    path = new_workspace(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_text(column: str = "text") -> Column:
    """The text; NULL counts as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def text_key(column: str = "text") -> Column:
    """A 64-bit key of the text that tells apart rows with the same doc_id but different texts."""
    return F.xxhash64(whole_text(column))


def n_parts(n_bytes: int, each: int) -> int:
    """How many parts of about ``each`` bytes; grows with the data."""
    return max(1, -(-n_bytes // each))


# --- texts of an Arrow batch as numpy bytes ---


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts of a column (without NULLs) and the offsets where each begins."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    if data is None or not len(offsets):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes each; a longer text gets a range of its own."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(n, max(last, first + 1))
        yield first, last
        first = last


# --- hashes ---


def _power_table(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


@lru_cache(maxsize=2)
def _usual_powers(base: int) -> np.ndarray:
    return _power_table(_U(base), CHUNK + CHUNK // 2)


def powers(n: int) -> np.ndarray:
    return _usual_powers(int(_BASE))[:n] if n <= CHUNK + CHUNK // 2 else _power_table(_BASE, n)


def inverse_powers(n: int) -> np.ndarray:
    return _usual_powers(int(_BASE_INV))[:n] if n <= CHUNK + CHUNK // 2 else _power_table(_BASE_INV, n)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits evenly (the finaliser of splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """h[i] covers the first i bytes, so the hash of data[a:b] is (h[b] - h[a]) / base**a."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_HASH[data] * powers(len(data)), out=out[1:])
    return out


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end byte of every word, and for each text the index of its first word (one more than texts)."""
    if lower:
        capital = (data >= 65) & (data <= 90)
        data = np.where(capital, data + np.uint8(32), data)
    inside = np.ones(len(data) + 2, bool)
    inside[0] = inside[-1] = False
    inside[1:-1] = ~((data == 32) | ((data >= 9) & (data <= 13)))
    begins, ends = inside[1:] & ~inside[:-1], inside[:-1] & ~inside[1:]
    # Texts lie back to back; a word also begins and ends at their borders.
    border = offsets[(offsets > 0) & (offsets < len(data))]
    begins[border] |= inside[border + 1]
    ends[border] |= inside[border]
    starts, stops = np.flatnonzero(begins[: len(data) + 1]), np.flatnonzero(ends[: len(data) + 1])
    h = prefix_hashes(data)
    words = mixed((h[stops] - h[starts]) * inverse_powers(len(data) + 1)[starts] + (stops - starts).astype(np.uint64))
    return words, starts, stops, np.searchsorted(starts, offsets)


def run_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """The hash of each run of n consecutive words (texts are not told apart)."""
    m = max(0, len(words) - n + 1)
    out = np.zeros(m, np.uint64)
    for i in range(n):
        out = out * _U(0xD6E8FEB86659FD93) + words[i : i + m]
    return mixed(out)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """The smallest of each w consecutive values, by doubling."""
    have, out = 1, x
    while have < w:
        step = min(have, w - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def united(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of half-open intervals as maximal runs; runs that touch become one."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.ones(len(starts), bool)
    new[1:] = starts[1:] > ends[:-1]
    last = np.append(np.flatnonzero(new)[1:] - 1, len(starts) - 1)
    return starts[new], ends[last]
