"""Induced sorting of the suffixes of a large byte text, with the lengths of their common prefixes.

Suffixes that are smaller than their successor (S) and those that are larger (L) are told apart; the leftmost S of each
run are sorted first, from the names of the substrings between them, and induce all others: going up through the sorted
suffixes, each puts its L predecessor at the end of a queue for the first symbol; going down, the same for S. The queues
of all symbols together are one priority queue, since an entry that is put later is never smaller. Each entry carries its
position and the length of the prefix that it shares with the entry before it, which follows from the smallest such
length among the suffixes passed between the two. Queues keep blocks of entries and move them to unnamed temporary
files beyond ``MEMORY`` bytes; blocks, not single entries, are handled at once.

Names of equal rank call for recursion on the text of names. Its suffixes are sorted by doubling, which needs few rounds:
only ``depth`` symbols of a suffix matter here, and a name stands for two symbols or more.
"""

from __future__ import annotations

import tempfile
from collections import deque

import numpy as np

BLOCK = 1 << 16
MEMORY = 64 * 1024 * 1024  # bytes of entries that all queues of a text keep in memory


class Queues:
    """One queue of (position, shared prefix) blocks per symbol."""

    def __init__(self, n_symbols: int):
        self.blocks: list[deque] = [deque() for _ in range(n_symbols)]
        self.size = 0
        self.file = None

    def put(self, symbol: int, position: np.ndarray, shared: np.ndarray) -> None:
        nbytes = position.nbytes + shared.nbytes
        if self.size + nbytes <= MEMORY:
            self.size += nbytes
            self.blocks[symbol].append((position, shared))
            return
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(0, 2)
        at = self.file.tell()
        self.file.write(position.tobytes() + shared.tobytes())
        self.blocks[symbol].append((at, len(position)))

    def take(self, symbol: int) -> tuple[np.ndarray, np.ndarray] | None:
        """The oldest block, or as many of the oldest blocks as make one."""
        got, n = [], 0
        queue = self.blocks[symbol]
        while queue and n < BLOCK:
            position, shared = queue.popleft()
            if isinstance(position, int):
                self.file.seek(position)
                count = shared
                position = np.frombuffer(self.file.read(8 * count), np.int64)
                shared = np.frombuffer(self.file.read(2 * count), np.int16)
            else:
                self.size -= position.nbytes + shared.nbytes
            got.append((position, shared))
            n += len(position)
        if not got:
            return None
        return np.concatenate([p for p, _ in got]), np.concatenate([s for _, s in got])

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def by_fours(text: np.ndarray) -> np.ndarray:
    """Four symbols from each place on as one number; zeros follow the end."""
    ahead = np.append(text, np.zeros(4, text.dtype)).astype(np.uint64)
    return sum(ahead[i : i + len(text)] << np.uint64(16 * i) for i in range(4))


def shared_prefix(fours: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    """Length, at most ``depth``, of the common prefix of the suffixes at a and b of a text given by its ``by_fours``."""
    out, last = np.zeros(len(a), np.int64), len(fours) - 1
    going = np.arange(len(a))
    while len(going):
        i, j = a[going] + out[going], b[going] + out[going]
        differs = fours[np.minimum(i, last)] ^ fours[np.minimum(j, last)]
        inside = np.minimum(last + 1 - np.maximum(i, j), 4)  # the end of the text is no part of a prefix
        equal = np.where(differs == 0, 4, ((differs & (~differs + np.uint64(1))).astype(np.float64)))
        some = differs != 0
        equal[some] = (np.frexp(equal[some])[1] - 1) // 16
        step = np.minimum(equal.astype(np.int64), inside)
        out[going] += step
        going = going[(step == 4) & (out[going] < depth)]
    return np.minimum(out, depth)


def _types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than its successor; the last symbol counts as such."""
    n = len(text)
    differs = np.append(text[1:] != text[:-1], True)
    following = np.where(differs, np.arange(n), n)
    following = np.minimum.accumulate(following[::-1])[::-1]
    rises = np.append(text[1:] > text[:-1], True)
    return rises[following]


def _names(text: np.ndarray, rises: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Dense ranks of the substrings that run from each start to the next one (included), in their order.

    Of equal symbols one whose suffix rises comes last, so the type takes part in the comparison.
    """
    lengths = np.append(np.diff(starts) + 1, 1)
    rank = np.zeros(len(starts), np.int64)
    step, at = 6, 0
    active = np.arange(len(starts))
    while len(active):
        key = np.zeros(len(active), np.int64)
        for i in range(step):
            offset = at + i
            inside = offset < lengths[active]
            where = np.minimum(starts[active] + offset, len(text) - 1)
            key = (key << 10) | np.where(inside, 2 * text[where].astype(np.int64) + rises[where] + 1, 0)
        full = np.zeros(len(starts), np.int64)
        full[active] = key + 1
        order = np.lexsort((full, rank))
        new = np.ones(len(order), bool)
        new[1:] = (rank[order][1:] != rank[order][:-1]) | (full[order][1:] != full[order][:-1])
        fresh = np.empty_like(rank)
        fresh[order] = np.cumsum(new) - 1
        rank, at = fresh, at + step
        # Only substrings that go on and still share their rank need another look.
        counts = np.bincount(rank)
        active = np.flatnonzero((lengths > at) & (counts[rank] > 1))
    return rank


def _order_of_names(names: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes of the text of names, sorted by at least ``depth`` names."""
    n, rank, width = len(names), names.astype(np.int64), 1
    order = np.argsort(rank, kind="stable")
    while width < depth and n and rank.max() + 1 < n:
        following = np.full(n, -1, np.int64)
        following[: max(0, n - width)] = rank[width:]
        both = rank * (n + 1) + following + 1
        order = np.argsort(both, kind="stable")
        ordered = both[order]
        new = np.ones(n, bool)
        new[1:] = ordered[1:] != ordered[:-1]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new) - 1
        width *= 2
    return order


def _least_between(shared: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The smallest of shared[first..last] for each pair, from minima over runs of powers of two."""
    length = last - first + 1
    level = np.frexp(length.astype(np.float64))[1] - 1
    out = np.empty(len(first), shared.dtype)
    table, width = shared, 1
    for k in range(int(level.max()) + 1 if len(level) else 0):
        if k:
            table = np.minimum(table[:-width], table[width:])
            width *= 2
        at = np.flatnonzero(level == k)
        out[at] = np.minimum(table[first[at]], table[last[at] - width + 1])
    return out


class _Pass:
    """One direction of inducing: blocks of sorted suffixes come in, their predecessors of one type go to the queues."""

    def __init__(self, text: np.ndarray, wanted: np.ndarray, n_symbols: int, depth: int):
        self.text, self.wanted, self.depth = text, wanted, depth
        self.queues = Queues(n_symbols)
        # Per symbol the smallest shared prefix among suffixes passed since its last entry; -1 before the first entry.
        self.since = np.full(n_symbols, -1, np.int16)

    def pass_on(self, position: np.ndarray, shared: np.ndarray) -> None:
        for i in range(0, len(position), BLOCK):
            self._block(position[i : i + BLOCK], shared[i : i + BLOCK])

    def _block(self, position: np.ndarray, shared: np.ndarray) -> None:
        at = np.flatnonzero(position > 0)
        at = at[self.wanted[position[at] - 1]]
        lowest = np.minimum.accumulate(shared)
        ended = np.minimum(self.since, lowest[-1])
        if len(at):
            symbol = self.text[position[at] - 1].astype(np.int64)
            order = np.argsort(symbol, kind="stable")
            at, symbol = at[order], symbol[order]
            heads = np.flatnonzero(np.diff(symbol, prepend=-1))
            least = np.empty(len(at), np.int16)
            least[heads] = np.minimum(self.since[symbol[heads]], lowest[at[heads]])
            rest = np.ones(len(at), bool)
            rest[heads] = False
            rest = np.flatnonzero(rest)
            least[rest] = _least_between(shared, at[rest - 1] + 1, at[rest])
            value = np.minimum(least + 1, self.depth).astype(np.int16)
            lasts = np.append(heads[1:], len(at)) - 1
            below = np.append(np.minimum.accumulate(shared[::-1])[::-1], self.depth)
            ended[symbol[heads]] = below[at[lasts] + 1]
            places = position[at] - 1
            for a, b in zip(heads.tolist(), (lasts + 1).tolist(), strict=True):
                self.queues.put(int(symbol[a]), places[a:b], value[a:b])
        self.since = ended.astype(np.int16)


def sorted_suffixes(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """All suffixes in falling order, by ``depth`` symbols at least, and the prefix each shares with the one before.

    ``text`` holds small numbers and ends with a 0 that occurs nowhere else.
    """
    n_symbols = int(text.max()) + 1
    rises = _types(text)
    is_left = rises.copy()
    is_left[1:] &= ~rises[:-1]
    is_left[0] = False
    is_left[-1] = True
    starts = np.flatnonzero(is_left)
    left = starts[_order_of_names(_names(text, rises, starts), depth)]
    left_shared = np.zeros(len(left), np.int16)
    fours = by_fours(text)
    left_shared[1:] = shared_prefix(fours, left[:-1], left[1:], depth)
    left_symbol = text[left]
    bounds = np.searchsorted(left_symbol, np.arange(n_symbols + 1))

    def seam(a: int, b: int) -> int:
        return int(shared_prefix(fours, np.array([a]), np.array([b]), depth)[0])

    up = _Pass(text, ~rises, n_symbols, depth)
    larger: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(n_symbols)]
    for c in range(n_symbols):
        last = None
        while (got := up.queues.take(c)) is not None:
            position, shared = got[0], got[1].copy()
            if last is None:
                shared[0] = 0
            larger[c].append((position, shared))
            up.pass_on(position, shared)
            last = int(position[-1])
        a, b = bounds[c], bounds[c + 1]
        if b > a:
            shared = left_shared[a:b].copy()
            shared[0] = 0 if last is None else seam(last, int(left[a]))
            up.pass_on(left[a:b], shared)
    up.queues.close()
    down = _Pass(text, rises, n_symbols, depth)
    out: list[tuple[np.ndarray, np.ndarray]] = []
    for c in range(n_symbols - 1, -1, -1):
        last = None
        while (got := down.queues.take(c)) is not None:
            position, shared = got[0], got[1].copy()
            if last is None:
                shared[0] = 0
            out.append((position, shared))
            down.pass_on(position, shared)
            last = int(position[-1])
        if larger[c]:
            position = np.concatenate([p for p, _ in larger[c]])[::-1]
            rising = np.concatenate([s for _, s in larger[c]])
            shared = np.empty(len(rising), np.int16)
            shared[1:] = rising[1:][::-1]
            shared[0] = 0 if last is None else seam(last, int(position[0]))
            out.append((position, shared))
            down.pass_on(position, shared)
            larger[c] = []
        elif c == 0 and last is None:
            out.append((np.array([len(text) - 1]), np.zeros(1, np.int16)))
    down.queues.close()
    return np.concatenate([p for p, _ in out]), np.concatenate([s for _, s in out])
