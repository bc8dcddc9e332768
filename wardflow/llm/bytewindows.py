"""Substring dedup over bytes: remove what repeats an earlier string of 100 bytes.

Windows are routed in super-k-mers (see superkmers.py), so equal ones meet in a shard. There the strings that may share
a part lie one after another in the order of the corpus, and induced sorting (see induced.py) gives their suffixes with
common prefixes: suffixes that share 100 bytes or more are copies of one window, of which the first one in the corpus
stays. All decisions are taken on the input; overlaps count.

NULL texts are empty. Rows without a doc_id come after all others; rows with the same doc_id but different texts follow
each other in the order of a key of the text; equal rows are one document and get the same result. An empty table gives
no rows. Extra columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import CHUNK, inverse_powers, mixed, prefix_hashes, sliding_min
from wardflow.llm.induced import sorted_suffixes
from wardflow.llm.superkmers import Occurrence, repeated_spans, window_runs, without_spans

WINDOW = 100
GRAM = 16


def _runs(data: np.ndarray, offsets: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> Iterator[tuple[bytes, int, int, int, int]]:
    """(bytes, text, first byte, windows, minimiser) of every super-k-mer; longer data are cut, with an overlap."""
    for begin in range(0, max(1, len(data)), CHUNK):
        part = data[begin : begin + CHUNK + window - 1]
        if len(part) < window:
            continue
        h = prefix_hashes(part)
        grams = mixed((h[gram:] - h[:-gram]) * inverse_powers(len(part))[: len(part) - gram + 1])
        minima = sliding_min(grams, window - gram + 1)
        valid = np.ones(len(minima), bool)
        for border in offsets[np.searchsorted(offsets, begin + 1) : np.searchsorted(offsets, begin + len(part))].tolist():
            valid[max(0, border - begin - window + 1) : max(0, border - begin)] = False
        heads, lasts = window_runs(minima, valid)
        # Empty texts begin where the next one does; the last text that begins there owns the byte.
        owner = np.searchsorted(offsets, heads + begin, side="right") - 1
        raw = part.tobytes()
        starts = heads + begin - offsets[owner]
        for x, y, t, start, minimum in zip(heads.tolist(), lasts.tolist(), owner.tolist(), starts.tolist(), minima[heads].view(np.int64).tolist(), strict=True):
            yield raw[x : y + window], t, start, y - x + 1, minimum


def _alone(string: bytes, window: int = WINDOW, gram: int = GRAM) -> bool:
    """Whether a string may hold the same window twice: then what all its windows share occurs once more behind it."""
    n = len(string) - window + 1
    return n > window - gram or string.find(string[n - 1 : n - 1 + gram], n) >= 0


def _trimmed(strings: list[Occurrence], window: int = WINDOW) -> list[Occurrence]:
    """The stretches of the strings whose windows have a 32-bit hash that another window of the shard has too.

    Windows that repeat are never lost by this; those that only look alike are told apart by the sorting that follows.
    """
    hashes, at = [], 0
    while at < len(strings):
        part, size = [], 0
        while at < len(strings) and size < CHUNK // 2:
            part.append(strings[at])
            size += len(strings[at][0])
            at += 1
        data = np.frombuffer(b"".join(o[0] for o in part), np.uint8)
        h = prefix_hashes(data)
        whole = mixed((h[window:] - h[:-window]) * inverse_powers(len(data))[: len(data) - window + 1])
        inside = np.ones(len(whole), bool)
        for end in np.cumsum([len(o[0]) for o in part])[:-1].tolist():
            inside[end - window + 1 : end] = False
        hashes.append((whole[inside] >> np.uint64(32)).astype(np.uint32))
    found = np.concatenate(hashes)
    ordered = np.sort(found)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return []
    table = np.zeros(1 << 24, bool)
    table[twice >> np.uint32(8)] = True
    repeated = table[found >> np.uint32(8)]
    maybe = np.flatnonzero(repeated)
    repeated[maybe] = np.isin(found[maybe], twice)
    counts = np.array([o[4] for o in strings], np.int64)
    ends = np.cumsum(counts)
    edge = np.zeros(len(found) + 1, bool)
    edge[ends] = edge[0] = True
    heads = np.flatnonzero(repeated & (edge[:-1] | ~np.append(False, repeated[:-1])))
    lasts = np.flatnonzero(repeated & (edge[1:] | ~np.append(repeated[1:], False)))
    whose = np.searchsorted(ends, heads, side="right")
    first = heads - (ends - counts)[whose]
    out = []
    for i, x, n in zip(whose.tolist(), first.tolist(), (lasts - heads + 1).tolist(), strict=True):
        string, place, key, start, _, minimum = strings[i]
        out.append((string[x : x + n + window - 1], place, key, start + x, n, minimum))
    return out


def _compare(strings: list[Occurrence], window: int = WINDOW) -> Iterator[tuple[int, int, int, int]]:
    strings = sorted(_trimmed(strings, window), key=lambda o: o[1:4]) if strings else []
    if not strings:
        return
    sizes = np.array([len(o[0]) + 1 for o in strings], np.int64)
    begins = np.cumsum(sizes) - sizes
    # Bytes count from 2, 1 ends a string and 0 the text.
    text = np.frombuffer(b"\0".join(o[0] for o in strings) + b"\0\0", np.uint8).astype(np.int16) + 2
    text[begins[1:] - 1] = 1
    text[-2:] = 1, 0
    position, shared = sorted_suffixes(text, window)
    group = np.cumsum(shared < window)
    owner = np.searchsorted(begins, position, side="right") - 1
    windows = np.array([o[4] for o in strings], np.int64)
    within = position - begins[owner]
    whole = np.flatnonzero(within < windows[owner])
    position, group, owner, within = position[whole], group[whole], owner[whole], within[whole]
    order = np.lexsort((position, group))
    repeats = order[1:][group[order][1:] == group[order][:-1]]
    # Neighbouring repeats of a string are one span.
    at = np.sort(position[repeats])
    new = np.ones(len(at), bool)
    new[1:] = at[1:] != at[:-1] + 1
    firsts = at[new]
    lasts = at[np.append(np.flatnonzero(new)[1:] - 1, len(at) - 1)] if len(at) else at
    whose = np.searchsorted(begins, firsts, side="right") - 1
    for i, x, y in zip(whose.tolist(), (firsts - begins[whose]).tolist(), (lasts - begins[whose]).tolist(), strict=True):
        _, place, key, start, _, _ = strings[i]
        yield place, key, start + x, start + y + window


def _later(a: tuple, b: tuple) -> bool:
    return a[:3] > b[:3]


def repeated_bytes(docs: DataFrame, text: str = "text") -> DataFrame:
    """Spans of bytes to remove: ord, key, start, end (end exclusive)."""
    return repeated_spans(docs, _runs, _compare, _later, WINDOW - 1, text, _alone)


def _cut(text: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[int, int, int, bytes]:
    kept, at = [], 0
    for x, y in zip(starts.tolist(), ends.tolist(), strict=True):
        kept.append(text[at:x])
        at = y
    kept.append(text[at:])
    left = b"".join(kept)
    return len(text), len(text) - len(left), len(starts), left


def deduplicated(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the bytes that are left of every text (``kept``)."""
    return without_spans(docs, repeated_bytes(docs, text), _cut, "n_bytes long, n_removed long, n_spans long, kept binary", text)


def digests(docs: DataFrame) -> DataFrame:
    return deduplicated(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
