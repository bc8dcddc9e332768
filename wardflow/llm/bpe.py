"""BPE encoding and decoding with a pair occurrence index.

All different pieces of a batch of texts are merged together. An index maps each pair of neighbouring symbols to all its
positions in the batch. A heap hands out the ranks that occur, in ascending order; one step merges all positions of a
pair from left to right and adds the pairs that arise to their lists. Entries that a merge made stale are seen and
skipped when their rank comes up. The vocabulary file is a parameter; every task reads it from the installed library.

NULL texts count as empty and give no ids. Rows are handled one by one, so repeated rows give repeated results, and
columns other than the keys and the text are never read.
"""

from __future__ import annotations

import gc
import hashlib
import heapq
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.llm.common import chunks, keeps, whole_text

REMEMBERED = 200_000  # strings of one generation of what a worker remembers
CHARACTERS = 2_000_000  # of texts that are merged together
WIDE = 1 << 32  # a pair of ids as one number: left * WIDE + right
DOUBLE_SPACE = re.compile(r"\s\s")


def _byte_letters() -> dict[str, int]:
    """The letters byte-level vocabularies write for bytes: printable ones stand for themselves, others follow from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Remembered:
    """Ids of strings met before, four bytes each, in two generations: what was not met again for a whole generation is
    forgotten."""

    def __init__(self):
        self.now: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def missing(self, wanted: set[str]) -> list[str]:
        """The strings of ``wanted`` that are unknown; all others are in ``now`` afterwards."""
        if len(self.now) > REMEMBERED:
            self.now, self.old = {}, self.now
        now, old, out = self.now, self.old, []
        for w in wanted:
            if w not in now:
                if w in old:
                    now[w] = old[w]
                else:
                    out.append(w)
        return out

    def add(self, strings: Iterable[str], ids: Iterable[bytes]) -> None:
        self.now.update(zip(strings, ids, strict=True))


class Vocabulary:
    """Ranks, bytes and added tokens of a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters, ids = _byte_letters(), spec["model"]["vocab"]
        self.piece = regex.compile(pattern)
        self.bytes_of = {i: bytes(letters[c] for c in token) for token, i in ids.items()}
        self.id_of_byte = np.zeros(256, np.int64)
        for letter, b in letters.items():
            self.id_of_byte[b] = ids[letter]
        self.merges: list[tuple[int, int, int]] = []
        self.rank: dict[int, int] = {}  # of a pair, written as one number
        made: dict[int, int] = {}
        for left, right in (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]):
            a, b, new = ids[left], ids[right], ids[left + right]
            rank = len(self.merges)
            # The index takes all positions of a rank at once, so a merge must never give rise to a lower rank.
            if max(made.get(a, -1), made.get(b, -1)) >= rank:
                raise ValueError(f"merge {rank} uses a token that a later merge makes")
            made.setdefault(new, rank)
            self.rank.setdefault(a * WIDE + b, rank)
            self.merges.append((a, b, new))
        self.pair_keys = np.array(sorted(self.rank), np.int64)
        self.pair_ranks = np.array([self.rank[k] for k in self.pair_keys.tolist()], np.int64)
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of |= {i: content.encode() for content, i in self.added.items()}
        self.split_added = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        size = max(self.bytes_of) + 1
        self.lengths, self.starts, self.flat = _laid_out([self.bytes_of.get(i, b"") for i in range(size)])
        self.digits = _laid_out([b"%d," % i for i in range(size)])
        self.known, self.cuts = Remembered(), Remembered()

    # --- encoding ---

    def merge_all(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece, four bytes each, merged together through one pair occurrence index."""
        if not pieces:
            return []
        spelled = [p.encode("utf-8") for p in pieces]
        lengths = np.array([len(x) for x in spelled], np.int64)
        ends = np.cumsum(lengths)
        n = int(ends[-1])
        first = self.id_of_byte[np.frombuffer(b"".join(spelled), np.uint8)]
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[ends - 1] = -1
        before[ends - lengths] = -1
        # The index: for each rank that occurs, the positions of its pair, from left to right.
        keys = first[:-1] * WIDE + first[1:]
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        here = np.flatnonzero((self.pair_keys[at] == keys) & (after[:-1] >= 0))
        ranks = self.pair_ranks[at[here]]
        order = np.argsort(ranks, kind="stable")
        here, ranks = here[order].tolist(), ranks[order]
        heads = np.flatnonzero(np.diff(ranks, prepend=-1))
        cuts = [*heads.tolist(), len(here)]
        heap = ranks[heads].tolist()  # sorted, so a heap
        places = {r: here[x:y] for r, x, y in zip(heap, cuts, cuts[1:], strict=False)}
        symbols, after, before = first.tolist(), after.tolist(), before.tolist()
        get, merges, push, pop = self.rank.get, self.merges, heapq.heappush, heapq.heappop
        while heap:
            r = pop(heap)
            a, b, new = merges[r]
            positions = places.pop(r)
            positions.sort()
            new_left = new * WIDE
            for i in positions:
                j = after[i]
                if symbols[i] != a or j < 0 or symbols[j] != b:
                    continue
                symbols[i] = new
                symbols[j] = -1
                k = after[i] = after[j]
                h = before[i]
                if k >= 0:
                    before[k] = i
                    q = get(new_left + symbols[k])
                    if q is not None:
                        if q in places:
                            places[q].append(i)
                        else:
                            places[q] = [i]
                            push(heap, q)
                if h >= 0:
                    q = get(symbols[h] * WIDE + new)
                    if q is not None:
                        if q in places:
                            places[q].append(h)
                        else:
                            places[q] = [h]
                            push(heap, q)
        bounds = [0, *ends.tolist()]
        left = np.array(symbols, np.int64)
        alive = (4 * np.concatenate([[0], np.cumsum(left >= 0)])[bounds]).tolist()
        packed = left[left >= 0].astype(np.int32).tobytes()
        return [packed[x:y] for x, y in zip(alive, alive[1:], strict=False)]

    def encode(self, texts: list[str]) -> list[list[int]]:
        """The ids of each text, added tokens included."""
        return [np.frombuffer(x, np.int32).tolist() for x in self.packed(texts)]

    def packed(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, four bytes each.

        A piece never runs past a space that stands alone, so texts are first cut there and what follows each such
        space is looked up as a whole; only unknown cuts are split into pieces, and only unknown pieces are merged.
        """
        gc.disable()  # no cycles arise here, and the many remembered strings make collections slow
        try:
            return self._packed(texts)
        finally:
            gc.enable()

    def _packed(self, texts: list[str]) -> list[bytes]:
        cuts: list[tuple[list[str], list[str]]] = []
        for t in texts:
            if any(content in t for content in self.added) or DOUBLE_SPACE.search(t):
                cuts.append((self._pieces(t), []))
            else:
                first, *rest = t.split(" ")
                cuts.append((self.piece.findall(first), rest))
        wanted = set().union(*[rest for _, rest in cuts])
        split = {c: self.piece.findall(" " + c) for c in self.cuts.missing(wanted)}
        pieces = set().union(*[head for head, _ in cuts], *split.values())
        new = [p for p in self.known.missing(pieces) if p not in self.added]
        self.known.add(new, self.merge_all(new))
        known = self.known.now
        for content, i in self.added.items():
            known[content] = np.int32(i).tobytes()
        self.cuts.add(split, [b"".join([known[p] for p in ps]) for ps in split.values()])
        whole = self.cuts.now
        return [b"".join([*map(known.__getitem__, head), *map(whole.__getitem__, rest)]) for head, rest in cuts]

    def _pieces(self, text: str) -> list[str]:
        if self.split_added is None:
            return self.piece.findall(text)
        out, at = [], 0
        for m in self.split_added.finditer(text):
            out += self.piece.findall(text[at : m.start()])
            out.append(m[0])
            at = m.end()
        return out + self.piece.findall(text[at:])

    # --- decoding ---

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """The text of each run of ids; bytes that are no UTF-8 become the replacement character."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.lengths)):
            keep = (ids >= 0) & (ids < len(self.lengths))  # unknown ids stand for nothing
            offsets = np.concatenate([[0], np.cumsum(keep)])[offsets]
            ids = ids[keep]
        return [x.decode("utf-8", "replace") for x in _spelled(ids, offsets, self.lengths, self.starts, self.flat)]

    def decimal(self, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """Each run of ids in decimal, joined by commas."""
        return [x[:-1] for x in _spelled(ids, offsets, *self.digits)]


def _spelled(ids: np.ndarray, offsets: np.ndarray, lengths: np.ndarray, starts: np.ndarray, flat: np.ndarray) -> list[bytes]:
    """The strings that ids stand for, put together for each run of them."""
    each = lengths[ids]
    ends = np.cumsum(each)
    at = np.repeat(starts[ids] - (ends - each), each) + np.arange(ends[-1] if len(ends) else 0)
    data = flat[at].tobytes()
    bounds = np.concatenate([[0], ends])[offsets].tolist()
    return [data[x:y] for x, y in zip(bounds, bounds[1:], strict=False)]


def _laid_out(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lengths = np.array([len(p) for p in parts], np.int64)
    return lengths, np.cumsum(lengths) - lengths, np.frombuffer(b"".join(parts), np.uint8)


@lru_cache(maxsize=2)
def vocabulary(path: str, pattern: str) -> Vocabulary:
    keeps("vocabulary", vocabulary.cache_clear)
    return Vocabulary(path, pattern)


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the installed library keeps a vocabulary; the same on every machine of a cluster."""
    import public_tokenizers

    return public_tokenizers.path(name)


def piece_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def _flat(packed: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All ids behind each other, and where those of each text begin."""
    offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in packed])]).astype(np.int64)
    return np.frombuffer(b"".join(packed), np.int32), offsets


def encode(docs: DataFrame, keys: Iterable[str] = ("doc_id",), text: str = "text", path: str | None = None) -> DataFrame:
    """``keys`` and the token ids (``ids``) of every whole text."""
    path, pattern = path or vocabulary_path(), piece_pattern()
    keys = list(keys)
    schema = T.StructType([*[docs.schema[k] for k in keys], T.StructField("ids", T.ArrayType(T.IntegerType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path, pattern)
        for batch in batches:
            texts = batch.column(len(keys)).to_pylist()
            lengths = np.array([len(t) for t in texts], np.int64)
            for a, b in chunks(np.concatenate([[0], np.cumsum(lengths)]), CHARACTERS):
                ids, offsets = _flat(vocab.packed(texts[a:b]))
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([*[batch.column(i).slice(a, b - a) for i in range(len(keys))], lists], names=[*keys, "ids"])

    return docs.select(*keys, whole_text(text).alias("_text")).mapInArrow(run, schema)


def decode(encoded: DataFrame, ids: str = "ids", text: str = "decoded", path: str | None = None) -> DataFrame:
    """All columns of ``encoded`` and the text its ids stand for."""
    path, pattern = path or vocabulary_path(), piece_pattern()
    schema = T.StructType([*encoded.schema.fields, T.StructField(text, T.StringType())])
    at = encoded.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path, pattern)
        for batch in batches:
            lists = batch.column(at)
            offsets = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]).astype(np.int64)
            texts = []
            values = lists.flatten().to_numpy(zero_copy_only=False)
            for a, b in chunks(offsets, 500_000):
                texts += vocab.decode(values[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, text])

    return encoded.mapInArrow(run, schema)


def digest_columns() -> list[Column]:
    """doc_id, n_tokens and the digests of ids and decoded text, from the columns ``ids`` and ``decoded``."""
    return [
        F.col("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    ]


def digests(docs: DataFrame, path: str | None = None, text: str = "text", with_ids: bool = False) -> DataFrame:
    """Per document the number of ids, their digest, and the digest of the text decoded from them, in one pass: ids (unless
    asked for, as a last column) and decoded text are put together from tables of bytes and never leave the task."""
    path, pattern = path or vocabulary_path(), piece_pattern()
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType(), False)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path, pattern)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in chunks(np.concatenate([[0], np.cumsum([len(t) for t in texts])]), CHARACTERS):
                ids, offsets = _flat(vocab.packed(texts[a:b]))
                counts, written, decoded = np.diff(offsets), [], []
                for x, y in chunks(offsets, 500_000):
                    part, own = ids[offsets[x] : offsets[y]], offsets[x : y + 1] - offsets[x]
                    written += [hashlib.sha256(d).hexdigest() for d in vocab.decimal(part, own)]
                    decoded += [hashlib.sha256(d.encode()).hexdigest() for d in vocab.decode(part, own)]
                columns = [batch.column(0).slice(a, b - a), pa.array(counts, pa.int64()), pa.array(written, pa.string()), pa.array(decoded, pa.string())]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids)))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *[f.name for f in fields]])

    return docs.select("doc_id", whole_text(text).alias("_text")).mapInArrow(run, T.StructType([docs.schema["doc_id"], *fields]))
