"""Sizes and components against all pairs of plain sets."""

import random
import re

import pytest

from wardflow.llm import jaccard


def shingles(text, n=4):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if len(words) >= n else frozenset([tuple(words)])


def plain(rows, n=4, percent=85):
    sets = [shingles(t, n) for _, t, *_ in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    out = []
    for i, (d, *_) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        out.append((d, len(sets[i]), min(ids, default=None)))
    return sorted(out, key=str)


def corpus(seed):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    passage = [r.choice(words) for _ in range(30)]
    rows = []
    for i in range(50):
        rows.append((r.randint(0, 10**6), [r.choice(words) for _ in range(r.randint(1, 120))] + (passage if i % 3 == 0 else [])))
    for _ in range(60):  # near and exact copies, some of copies
        d, w = r.choice(rows)
        w = list(w)
        for _ in range(r.choice([0, 0, 1, 1, 2, 3])):
            w[r.randrange(len(w))] = r.choice(words)
        rows.append((r.randint(0, 10**6), w + r.choice([[], ["tail"]])))
    base = [r.choice(words) for _ in range(200)]
    for i in range(60):  # one large group of near copies
        w = list(base)
        w[r.randrange(200)] = f"x{i}"
        rows.append((2 * 10**6 + i, w))
    out = [(d, r.choice([" ", "\n", "\t "]).join(w)) for d, w in rows]
    out += [(3 * 10**6, None), (3 * 10**6 + 1, ""), (3 * 10**6 + 2, " \n"), (3 * 10**6 + 3, "one two"), (3 * 10**6 + 4, "ONE  two"), (3 * 10**6 + 5, "one two three")]
    out += [(None, out[0][1]), (None, "alone " * 9), (out[3][0], out[3][1]), (out[3][0], "another text of that id")]
    return out


@pytest.mark.parametrize(("seed", "fragment", "flush", "centres"), [(1, 500, 800, 3), (2, jaccard.FRAGMENT, jaccard.FLUSH, 1), (3, 300, 5000, 0)])
def test_components(spark, monkeypatch, seed, fragment, flush, centres):
    monkeypatch.setattr(jaccard, "FRAGMENT", fragment)
    monkeypatch.setattr(jaccard, "FLUSH", flush)
    monkeypatch.setattr(jaccard, "CENTRES", centres)
    monkeypatch.setattr(jaccard, "FRAGMENTS", 5)
    rows = corpus(seed)
    docs = spark.createDataFrame([(*x, 1, "n") for x in rows], "doc_id long, text string, class int, comp string").repartition(3)
    got = jaccard.grouped(docs).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == plain(rows)


def test_one_of_each_group(spark):
    rows = corpus(4)
    docs = spark.createDataFrame([(*x, 1) for x in rows], "doc_id long, text string, key int")
    kept = jaccard.one_of_each_group(docs, n=5, percent=80)
    assert kept.columns == docs.columns
    got, want = kept.collect(), plain(rows, 5, 80)
    empty = sum(not shingles(t) for _, t in rows)
    groups = {g for d, n, g in want if n}
    assert len(got) == empty + len(groups)


def test_empty_and_unlinked(spark):
    docs = spark.createDataFrame([(1, "a b c d e"), (2, "f g h i j")], "doc_id long, text string")
    assert sorted(r.component_id for r in jaccard.grouped(docs).collect()) == [1, 2]
    assert jaccard.grouped(docs.limit(0)).collect() == []
