"""Routing of all windows of a corpus by their minimisers, in packed strings.

A window is a run of symbols (words or bytes) of fixed length. Its minimiser is the smallest hash of the m-grams inside.
Consecutive windows with the same minimiser travel as one string to the shard of that hash, so equal windows always
meet, wherever they stand. Before anything is sent, equal strings of a batch are reduced to the earliest one: all windows
of the others are known to have an earlier twin. The same is done once more in the shard, and strings whose minimiser is
left in no other string are put aside there, so only strings that may share a part are compared window by window.
However often a string occurs, a shard gets it once per batch.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import n_parts, text_bytes, text_key, united, whole_text

FLUSH = 40 * 1024 * 1024  # bytes of strings that a task gathers before it sends them
SHARD = 24 * 1024 * 1024  # bytes of strings a shard gets, about
EXPANSION = 3  # strings overlap: bytes sent per byte of text, about
LEVEL = 5
PAYLOADS = "shard int, payload binary"
SPANS = "ord long, key long, start long, end long"
LAST = 2**63 - 1  # rows without a doc_id come after all others

# A string of an occurrence: the text of the run, the document (place in order, key), its first symbol, its windows.
Occurrence = tuple[bytes, int, int, int, int, int]


def order_of(column: str = "doc_id") -> Column:
    return F.coalesce(F.col(column), F.lit(LAST))


def window_runs(minima: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last window of each run of neighbouring valid windows with one minimiser."""
    same = np.zeros(len(minima) + 1, bool)
    same[1:-1] = (minima[1:] == minima[:-1]) & valid[1:] & valid[:-1]
    return np.flatnonzero(valid & ~same[:-1]), np.flatnonzero(valid & ~same[1:])


class Batch:
    """What a task gathers: the earliest occurrence of every string, and spans that are repeats for sure."""

    def __init__(self, later: Callable[[tuple[int, int, int], tuple[int, int, int]], bool], covers: int):
        self.later, self.covers = later, covers  # covers: symbols a window reaches beyond its start
        self.found: dict[bytes, list[tuple[int, int, int, int, int]]] = {}
        self.repeats: list[tuple[int, int, int, int]] = []
        self.size = 0

    def add(self, string: bytes, place: int, key: int, start: int, n: int, minimum: int) -> None:
        new = (place, key, start, n, minimum)
        known = self.found.get(string)
        if known is None:
            self.found[string] = [new]
            self.size += len(string)
        elif self.later(new, known[0]):
            self.repeats.append((place, key, start, start + n + self.covers))
        elif self.later(known[0], new):
            self.repeats += [(p, k, s, s + m + self.covers) for p, k, s, m, _ in known]
            self.found[string] = [new]
        elif new not in known:
            known.append(new)  # neither repeats the other

    def rows(self, n_shards: int) -> Iterator[tuple[int, bytes]]:
        strings = [s for s, places in self.found.items() for _ in places]
        table = np.array([p for places in self.found.values() for p in places], np.int64).reshape(-1, 5)
        place, key, start, n = table[:, :4].T
        minimum = table[:, 4].astype(np.uint64)
        shard = (minimum % np.uint64(n_shards)).astype(np.int64)
        order = np.lexsort((start, key, place, shard))
        cuts = np.searchsorted(shard[order], np.arange(n_shards + 1))
        repeats = np.array(list(merged_spans(self.repeats)), np.int64).reshape(-1, 4)
        to = ((repeats[:, 0] ^ repeats[:, 1]) & 0x7FFFFFFF) % n_shards
        pack = zstandard.ZstdCompressor(level=LEVEL)
        for i in range(n_shards):
            own, spans = order[cuts[i] : cuts[i + 1]], repeats[to == i]
            if not len(own) and not len(spans):
                continue
            mine = [strings[j] for j in own.tolist()]
            new = np.ones(len(own), bool)
            new[1:] = (place[own][1:] != place[own][:-1]) | (key[own][1:] != key[own][:-1])
            body = (
                b"".join(mine),
                np.array([len(s) for s in mine], np.int32),
                np.stack([place[own][new], key[own][new]], axis=1),
                new,
                start[own],
                n[own].astype(np.int32),
                (minimum[own] // np.uint64(n_shards) & np.uint64(0xFFFFFFFF)).astype(np.uint32),
                spans,
            )
            yield i, pack.compress(pickle.dumps(body, protocol=5))


def unpacked(payload: bytes) -> tuple[list[Occurrence], np.ndarray]:
    body, lengths, docs, new, starts, windows, minima, spans = pickle.loads(zstandard.ZstdDecompressor().decompress(payload))
    ends = np.cumsum(lengths, dtype=np.int64).tolist()
    own = docs[np.cumsum(new) - 1].tolist() if len(new) else []
    rows = zip(ends, lengths.tolist(), own, starts.tolist(), windows.tolist(), minima.tolist(), strict=True)
    return [(body[e - n : e], p, k, s, w, m) for e, n, (p, k), s, w, m in rows], spans


def merged_spans(spans: list[tuple[int, int, int, int]]) -> Iterator[tuple[int, int, int, int]]:
    """The union of spans per document."""
    at: tuple[int, int] | None = None
    first = last = 0
    for place, key, start, end in sorted(spans):
        if at == (place, key) and start <= last:
            last = max(last, end)
            continue
        if at is not None:
            yield (*at, first, last)
        at, first, last = (place, key), start, end
    if at is not None:
        yield (*at, first, last)


def repeated_spans(
    docs: DataFrame,
    runs: Callable[[np.ndarray, np.ndarray], Iterator[tuple[bytes, int, int, int, int]]],
    compare: Callable[[list[Occurrence]], Iterator[tuple[int, int, int, int]]],
    later: Callable,
    covers: int,
    text: str = "text",
    alone: Callable[[bytes], bool] = lambda string: False,
) -> DataFrame:
    """Spans of symbols (ord, key, start, end) that windows with an earlier twin cover; they may overlap.

    ``runs`` gives (string, text, first symbol, windows, minimiser) for the texts of a batch; ``compare`` gets the strings
    of a shard that share minimisers and gives the spans among them. ``alone`` tells whether a string must be looked at although no other shares its minimiser.
    """
    n_shards = n_parts(EXPANSION * (docs.agg(F.sum(F.octet_length(text))).first()[0] or 0), SHARD)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = Batch(later, covers)

        def flushed() -> pa.RecordBatch:
            shards, payloads = zip(*batch.rows(n_shards), strict=True)
            return pa.RecordBatch.from_arrays([pa.array(shards, pa.int32()), pa.array(payloads, pa.binary())], names=["shard", "payload"])

        for rows in batches:
            data, offsets = text_bytes(rows.column(2))
            places, keys = rows.column(0).to_pylist(), rows.column(1).to_pylist()
            for string, t, start, n, minimum in runs(data, offsets):
                batch.add(string, places[t], keys[t], start, n, minimum)
                if batch.size > FLUSH:
                    yield flushed()
                    batch = Batch(later, covers)
        if batch.found or batch.repeats:
            yield flushed()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows of a partition are sorted by shard; one shard at a time is unpacked.
        waiting: list[bytes] = []
        current = None
        for rows in batches:
            for shard, payload in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
                if shard != current and waiting:
                    yield shard_spans(waiting)
                    waiting = []
                current = shard
                waiting.append(payload)
        if waiting:
            yield shard_spans(waiting)

    def shard_spans(payloads: list[bytes]) -> pa.RecordBatch:
        batch, spans = Batch(later, covers), []
        for payload in payloads:
            found, ready = unpacked(payload)
            spans += map(tuple, ready.tolist())
            for o in found:
                batch.add(*o)
        owners: dict[int, int] = {}
        for places in batch.found.values():
            owners[places[0][4]] = owners.get(places[0][4], 0) + 1
        shared = [(s, *p) for s, places in batch.found.items() for p in places if owners[p[4]] > 1 or alone(s)]
        spans += batch.repeats
        spans += compare(shared)
        columns = list(zip(*merged_spans(spans), strict=True)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["ord", "key", "start", "end"])

    source = docs.select(order_of().alias("ord"), text_key(text).alias("key"), whole_text(text).alias("_text"))
    sent = source.mapInArrow(send, PAYLOADS)
    return sent.repartition(n_shards, "shard").sortWithinPartitions("shard").mapInArrow(meet, SPANS)


def without_spans(docs: DataFrame, spans: DataFrame, cut: Callable, schema: str, text: str = "text") -> DataFrame:
    """Apply ``cut(text bytes, starts, ends)`` to every row of ``docs`` with the united spans of its text."""
    gathered = spans.groupBy("ord", "key").agg(F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends"))
    rows = docs.select("doc_id", order_of().alias("ord"), text_key(text).alias("key"), whole_text(text).alias("_text"))
    joined = rows.join(gathered, ["ord", "key"], "left").select("doc_id", "_text", "starts", "ends")
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t, starts, ends in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                out.append(cut(t.encode("utf-8"), *united(np.array(starts or [], np.int64), np.array(ends or [], np.int64))))
            columns = list(zip(*out, strict=True)) or [()] * len(names)
            kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
            types = [kinds[f.split()[1]] for f in schema.split(", ")]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]], names=["doc_id", *names])

    return joined.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {schema}")

