"""Removal of repeated windows against plain loops over all windows."""

import hashlib
import random

import pytest

from wardflow.llm import bytewindows, superkmers, wordwindows


def corpus(r):
    words = [f"w{i}" for i in range(60)] + ["é", "中文", "the", "the"]
    passage = " ".join(r.choice(words) for _ in range(40))
    rows = []
    for i in range(60):
        parts = [" ".join(r.choice(words) for _ in range(r.randint(0, 60))) for _ in range(3)]
        if i % 3 == 0:
            parts.insert(r.randint(0, 3), passage if i % 2 else passage.replace(" ", "\n ", 7))
        rows.append((i * 3 % 101, r.choice([" ", "\t", "  \n"]).join(parts)))
    rows += [(200 + i, rows[4][1]) for i in range(20)]
    rows += [(400, None), (401, ""), (402, "one two"), (403, "again " * 500), (404, "again " * 300), (405, "  lead " + passage), (406, passage), (None, passage), (7, passage), (7, passage), (7, passage + " more"), (500, "x" * 5000)]
    return [(*x, "clash", 0) for x in rows]


def plain_words(rows, window=13):
    order = {i: (2**63 - 1 if d is None else d) for i, (d, *_) in enumerate(rows)}
    words = [(t or "").encode().split() for _, t, *_ in rows]
    smallest = {}
    for i, w in enumerate(words):
        for j in range(len(w) - window + 1):
            k = tuple(w[j : j + window])
            smallest[k] = min(smallest.get(k, order[i]), order[i])
    out = []
    for i, w in enumerate(words):
        gone = set()
        for j in range(len(w) - window + 1):
            if smallest[tuple(w[j : j + window])] < order[i]:
                gone.update(range(j, j + window))
        kept = b" ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((rows[i][0], len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("flush", [1000, superkmers.FLUSH])
def test_words(spark, monkeypatch, flush):
    monkeypatch.setattr(superkmers, "FLUSH", flush)
    rows = corpus(random.Random(flush))
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string, n_words int").repartition(3)
    got = sorted(map(tuple, wordwindows.digests(docs).collect()), key=str)
    assert got == plain_words(rows)
    assert wordwindows.digests(docs.limit(0)).collect() == []


def plain_bytes(rows, window=100):
    keyed = {}
    for d, t, *_ in rows:
        keyed.setdefault((2**63 - 1 if d is None else d, t or ""), None)
    seen, cut = set(), {}
    for order, t in sorted(keyed, key=lambda x: x[0]):
        data, gone = t.encode(), set()
        for j in range(len(data) - window + 1):
            piece = data[j : j + window]
            if piece in seen:
                gone.update(range(j, j + window))
            seen.add(piece)
        runs = sum(j - 1 not in gone for j in gone)
        kept = bytes(b for j, b in enumerate(data) if j not in gone)
        cut[order, t] = (len(data), len(gone), runs, hashlib.sha256(kept).hexdigest())
    return sorted(((d, *cut[2**63 - 1 if d is None else d, t or ""]) for d, t, *_ in rows), key=str)


@pytest.mark.parametrize("flush", [3000, superkmers.FLUSH])
def test_bytes(spark, monkeypatch, flush):
    monkeypatch.setattr(superkmers, "FLUSH", flush)
    # The order of different texts with one doc_id follows a key, which the plain version does not know.
    rows = [x for x in corpus(random.Random(flush)) if x[0] != 7 or not x[1].endswith("more")]
    rows = list({x[0]: x for x in rows if x[0] != 7}.values()) + [x for x in rows if x[0] == 7]
    rows += [(600, "abc" * 40, "", 0), (601, "abcabcab" * 30, "", 0), (602, "é" * 120, "", 0), (603, "q" * 99, "", 0), (604, "q" * 101, "", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string, n_bytes int").repartition(3)
    got = sorted(map(tuple, bytewindows.digests(docs).collect()), key=str)
    assert got == plain_bytes(rows)
    assert bytewindows.digests(docs.limit(0)).collect() == []


def test_texts_longer_than_a_chunk(spark, monkeypatch):
    monkeypatch.setattr(bytewindows, "CHUNK", 700)
    r = random.Random(1)
    rows = [(i, "".join(r.choice("abcdefgh ") for _ in range(2000))) for i in range(4)]
    rows += [(9, rows[0][1][300:900] + rows[1][1][:1500] + rows[0][1][:150])]
    got = sorted(map(tuple, bytewindows.digests(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == plain_bytes(rows)
