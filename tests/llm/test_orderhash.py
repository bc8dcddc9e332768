"""Edited texts and neighbours against plain Python, and what a fingerprint must and must not tell apart."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from wardflow.llm import orderhash


def plain(rows):
    order = sorted((r for r in rows), key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = {}
    for i, (d, t, *_) in enumerate(order):
        t, following = t or "", order[(i + 1) % len(order)][1] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + following[:half]
        out[d] = (len(t), hashlib.sha256(edited.encode()).hexdigest(), edited == t, following == t)
    return out


@pytest.mark.parametrize("range_bytes", [150, orderhash.RANGE])
def test_edited_texts(spark, monkeypatch, range_bytes):
    monkeypatch.setattr(orderhash, "RANGE", range_bytes)
    r = random.Random(1)
    rows = [(i * 7 % 53, " ".join(r.choice(["alpha", "é\U0001f600", "中文字", "b", "averyveryverylongword"]) for _ in range(r.randint(0, 30)))) for i in range(40)]
    rows += [(100, None), (101, ""), (102, rows[0][1]), (103, rows[0][1]), (104, "same line\n" * 700), (None, "no id")]
    docs = spark.createDataFrame([(*x, 1, "clash") for x in rows], "doc_id long, text string, n_chars long, key string").repartition(3)
    got, want = orderhash.compared(docs).collect(), plain(rows)
    assert len(got) == len(rows)
    by_text = {}
    for g in got:
        n, digest, edited_same, next_same = want[g.doc_id]
        assert (g.n_chars, g.edited_sha256) == (n, digest)
        assert 0 <= g.near_edited <= 1 and 0 <= g.near_next <= 1 and len(g.fingerprint) == len(g.edited_fingerprint) == 8 * orderhash.BINS
        assert not edited_same or g.near_edited == 1
        assert not next_same or g.near_next == 1
        by_text.setdefault(dict(rows)[g.doc_id] or "", set()).add(g.fingerprint)
    assert all(len(prints) == 1 for prints in by_text.values())


def test_order_counts(spark):
    r = random.Random(3)
    words = [f"{r.randint(0, 10**6)}" for _ in range(400)]
    blocks = [words[i : i + 20] for i in range(0, 400, 20)]
    shuffled = blocks[:]
    r.shuffle(shuffled)
    few = words[:]
    few[100] = few[300] = "changed"
    texts = [" ".join(words), " ".join(w for b in shuffled for w in b), " ".join(few), " ".join(str(r.random()) for _ in words)]
    prints = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(orderhash.fingerprint(F.col("t"))).collect()]

    def like(a, b):
        return spark.range(1).select(orderhash.likeness(F.lit(a), F.lit(b))).first()[0]

    same, moved, edited, other = (like(prints[0], p) for p in prints)
    assert same == 1 and other < 0.05 < moved < edited < 1


def test_occurrences_are_numbered(spark):
    rows = spark.createDataFrame([("a b c " * 5,), ("a b c " * 50,), ("a b c " * 5,)], "t string").select(orderhash.fingerprint(F.col("t"))).collect()
    assert rows[0] == rows[2] != rows[1]


def test_one_and_none(spark):
    one = spark.createDataFrame([(1, "abcdef gh")], "doc_id long, text string")
    got = orderhash.compared(one).collect()[0]
    assert got.edited_sha256 == hashlib.sha256(b"abcdeabcd").hexdigest() and got.near_next == 1
    assert orderhash.compared(one.limit(0)).collect() == []
    twins = spark.createDataFrame([(1, "abcdef gh"), (1, "abcdef gh"), (1, None)], "doc_id long, text string")
    assert len(orderhash.compared(twins).collect()) == 3
