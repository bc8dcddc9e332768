"""Substring dedup over words: remove what repeats a window of words of a document with a smaller doc_id.

Windows are routed in super-k-mers (see superkmers.py); in its shard every string is cut into windows, and sorting them
brings equal ones together, where the smallest doc_id is known exactly. All decisions are taken on the input.

NULL texts have no words. Rows without a doc_id come after all others. Rows with the same doc_id do not repeat one
another: they are no smaller. An empty table gives no rows. Extra columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import chunks, run_hashes, sliding_min, word_hashes
from wardflow.llm.superkmers import Occurrence, repeated_spans, window_runs, without_spans

WINDOW = 13
GRAM = 3


def _runs(data: np.ndarray, offsets: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> Iterator[tuple[bytes, int, int, int, int]]:
    """(words joined by one space, text, first word, windows, minimiser) of every super-k-mer."""
    for a, b in chunks(offsets):
        part = data[offsets[a] : offsets[b]]
        words, starts, stops, first = word_hashes(part, offsets[a : b + 1] - offsets[a])
        if len(words) < window:
            continue
        minima = sliding_min(run_hashes(words, gram), window - gram + 1)
        owner = np.repeat(np.arange(b - a), np.diff(first))
        valid = owner[: len(minima)] == owner[window - 1 :]
        heads, lasts = window_runs(minima, valid)
        # Words with other than one space between them are written anew.
        odd = np.zeros(len(words) + 1, np.int64)
        odd[1:-1] = np.cumsum((starts[1:] - stops[:-1] != 1) | (part[np.minimum(stops[:-1], len(part) - 1)] != 32))
        raw = part.tobytes()
        ends = lasts + window - 1
        rows = zip(starts[heads].tolist(), stops[ends].tolist(), (odd[ends] != odd[heads]).tolist(), owner[heads].tolist(), (heads - first[owner[heads]]).tolist(), (lasts - heads + 1).tolist(), minima[heads].view(np.int64).tolist(), strict=True)
        for x, y, anew, t, start, n, minimum in rows:
            string = raw[x:y]
            yield b" ".join(string.split()) if anew else string, a + t, start, n, minimum


def _compare(strings: list[Occurrence], window: int = WINDOW) -> Iterator[tuple[int, int, int, int]]:
    rows = []
    for i, (string, place, *_) in enumerate(strings):
        words = string.split(b" ")
        rows += [(b" ".join(words[j : j + window]), place, i, j) for j in range(len(words) - window + 1)]
    rows.sort()
    head, smallest = None, 0
    for words, place, i, j in rows:
        if words != head:
            head, smallest = words, place
        elif place > smallest:
            _, p, key, start, _, _ = strings[i]
            yield p, key, start + j, start + j + window


def _later(a: tuple, b: tuple) -> bool:
    return a[0] > b[0]


def repeated_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """Spans of words to remove: ord, key, start, end (word numbers, end exclusive)."""
    return repeated_spans(docs, _runs, _compare, _later, WINDOW - 1, text)


def _cut(text: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[int, int, str]:
    words = text.split()
    kept, at = [], 0
    for x, y in zip(starts.tolist(), ends.tolist(), strict=True):
        kept += words[at:x]
        at = y
    kept += words[at:]
    return len(words), len(words) - len(kept), b" ".join(kept).decode("utf-8")


def deduplicated(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed and what is left of every text (``kept``, words joined by one space)."""
    return without_spans(docs, repeated_words(docs, text), _cut, "n_words long, n_removed long, kept string", text)


def digests(docs: DataFrame) -> DataFrame:
    return deduplicated(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
