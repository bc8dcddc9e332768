"""Runs of words against a search over all periods."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wardflow.llm import periodicruns
from wardflow.llm.common import CHUNK

SCHEMA = "doc_id long, text string, runs string, _w string, n_runs int"


def plain_runs(words, minimum, times):
    """Every maximal stretch with some period; of the periods of a stretch the smallest."""
    found, n = {}, len(words)
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if length >= max(minimum, times * q):
                found.setdefault((start, length), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def by_order(runs):
    return sorted(runs, key=lambda r: (r[0], r[2]))


TEXT = st.one_of(
    st.text("ab", max_size=40),
    st.text("abc", max_size=60),
    st.builds(lambda a, b, k, c, m: a + b * k + c + (b + c) * m, st.text("ab", max_size=5), st.text("abc", max_size=6), st.integers(0, 9), st.text("ab", max_size=4), st.integers(0, 6)),
)


@settings(deadline=None, max_examples=150)
@given(texts=st.lists(TEXT, min_size=1, max_size=5), minimum=st.sampled_from([1, 4, 9, 24]), times=st.sampled_from([2, 3, 4]))
def test_runs_of_several_texts(texts, minimum, times):
    words = [" ".join(t).encode() for t in texts]
    data, offsets = np.frombuffer(b"".join(words), np.uint8), np.cumsum([0, *map(len, words)])
    got = periodicruns.runs_of_texts(data, offsets, minimum, times)
    assert [list(map(tuple, g.tolist())) for g in got] == [by_order(plain_runs(t, minimum, times)) for t in texts]


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


@pytest.mark.parametrize("text", [fibonacci(600), "a" * 700, "ab" * 300 + "aab" * 100, ("abc" * 9 + "d") * 25, "".join(random.Random(3).choice("ab") for _ in range(800))])
def test_texts_full_of_repeats(text, monkeypatch):
    monkeypatch.setattr(periodicruns, "LOOKUPS", 100)
    raw = " ".join(text).encode()
    (got,) = periodicruns.runs_of_texts(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), 6, 3)
    assert list(map(tuple, got.tolist())) == by_order(plain_runs(text, 6, 3))


def test_suffix_array_and_prefixes():
    r = random.Random(1)
    for size in (1, 2, 50, 300):
        s = [r.randint(0, 2) for _ in range(size)]
        order, place, classes = periodicruns.suffix_array(np.array(s))
        assert order.tolist() == sorted(range(size), key=lambda i: s[i:])
        assert place[order].tolist() == list(range(size))
        lcp = periodicruns.common_prefixes(order, classes)
        for k in range(1, size):
            a, b = s[order[k - 1] :], s[order[k] :]
            assert lcp[k] == next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


def plain_row(doc_id, text, planted=False):
    words = (text or "").encode().split()
    n = len(words)
    if planted and doc_id is not None and n and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = by_order(plain_runs(words, 24, 3))
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else None
    numbers = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()
    return (doc_id, len(runs), *numbers, hashlib.sha256(listed).hexdigest(), hashlib.sha256(kept).hexdigest())


def corpus():
    r = random.Random(5)
    words = [f"w{i}" for i in range(30)] + ["é", "中文", " "]
    rows = []
    for i in range(150):
        text = [r.choice(words) for _ in range(r.randint(0, 120))]
        if i % 3 == 0:
            piece = [r.choice(words) for _ in range(r.randint(1, 12))]
            text += piece * r.randint(2, 12) + piece[: r.randint(0, len(piece))] + text[:5]
        rows.append((i, r.choice([" ", "\t", "  \n"]).join(text)))
    rows += [(500, None), (501, ""), (502, " \n"), (503, "one"), (504, "the " * 5000), (None, "x y " * 30), (None, "x y " * 30), (7, "x y " * 12), (7, "x y " * 11 + "x"), (7, "x y " * 12)]
    rows += [(505, " ".join(f"n{i % 700}" for i in range(2500))), (506, "a " * 24 + "b " * 24), (507, "a " * 23), (508, "a b c d e f g h " * 3), (509, "a b c d e f g h " * 2 + "a b c d e f g")]
    return [(*x, "clash", "clash", -1) for x in rows]


def test_digests(spark, monkeypatch):
    monkeypatch.setattr(periodicruns, "SORTED", 5000)
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted(map(tuple, periodicruns.digests(docs).collect()), key=str)
    assert got == sorted((plain_row(d, t) for d, t, *_ in rows), key=str)
    assert sum(x[1] > 0 for x in got) > 30
    assert periodicruns.digests(docs.limit(0)).collect() == []


def test_runs_and_collapsed_text(spark):
    docs = spark.createDataFrame([(1, "say " + "a b c " * 10 + "end"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in periodicruns.periodic_runs(docs).collect()}
    assert [tuple(x) for x in got[1].runs] == [(1, 30, 3)] and got[1].collapsed == "say a b c end"
    assert got[2].runs == [] and got[2].collapsed == ""


def test_planted(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(2)
    got = sorted(map(tuple, periodicruns.digests(periodicruns.with_planted_runs(docs)).collect()), key=str)
    assert got == sorted((plain_row(d, t, True) for d, t, *_ in rows), key=str)
    assert periodicruns.with_planted_runs(docs.limit(0)).collect() == []


def test_a_text_longer_than_a_chunk(spark):
    r = random.Random(2)
    period = " ".join(f"longword{r.randint(0, 10**6)}" for _ in range(30_000))
    text = f"{period} {period} {period} tail"
    assert len(text) > CHUNK
    row = periodicruns.digests(spark.createDataFrame([(1, text), (2, "x")], "doc_id long, text string")).where("doc_id = 1").first()
    assert (row.n_runs, row.start, row.length, row.period) == (1, 0, 90_000, 30_000)
    assert row.collapsed_sha256 == hashlib.sha256(f"{period} tail".encode()).hexdigest()
