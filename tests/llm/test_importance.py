"""Importance resampling against plain loops, and CRCs put together from parts."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from wardflow.llm import importance

SCHEMA = "doc_id long, text string, weight string, buckets int, rank string"


def words_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def plain_features(text, grams, buckets):
    w = words_of(text)
    runs = [" ".join(w[i : i + n]) for n in range(1, grams + 1) for i in range(len(w) - n + 1)]
    return [zlib.crc32(x.encode()) % buckets for x in runs]


def plain(rows, target, grams=1, buckets=importance.BUCKETS, least=importance.LEAST, percent=importance.PERCENT):
    found = [plain_features(t, grams, buckets) for _, t, *_ in rows]
    aimed = [b for t in target for b in plain_features(t, grams, buckets)]
    s, t = np.bincount([b for f in found for b in f], minlength=buckets), np.bincount(aimed, minlength=buckets)
    all_s, all_t = int(s.sum()), int(t.sum())
    gain = [math.floor(1000 * math.log((y + 1) * (all_s + buckets) / ((x + 1) * (all_t + buckets)))) for x, y in zip(s.tolist(), t.tolist(), strict=True)]
    out = []
    for (d, text, *_), f in zip(rows, found, strict=True):
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'null' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append([d, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, len(words_of(text))])
    enough = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0]))
    for i, r in enumerate(enough[: percent * len(enough) // 100], 1):
        r[4] = i
    return [tuple(r[:5]) for r in out]


def corpus(r):
    words = [f"w{i}" for i in range(40)] + ["É", "中文", "İ", "ſt", "THE", "Don't", "x_y", "a-b", "9", " "]
    rows = [(i, r.choice([" ", "\n", ", "]).join(r.choice(words) for _ in range(r.randint(0, 60)))) for i in range(220)]
    rows += [(None, rows[0][1] + " w1" * 30), (1000, None), (1001, ""), (1002, "... --- !"), (1003, "z" * 200_000 + " w1" * 25), (1004, "w2 " * 60_000)]
    rows += [(3, rows[3][1]), (3, rows[3][1])]
    return [(*x, "clash", 0, "clash") for x in rows]


TARGET = ["w1 w2 w3 THE the", "w4 w5 É", None, ""]


def ranked(rows):
    return sorted((r for r in rows), key=str)


@pytest.mark.parametrize(("limit", "fresh", "grams", "percent"), [(importance.WORDS, importance.FRESH, 1, 10), (importance.WORDS, 1, 1, 100), (5, 1, 2, 33), (0, 1, 3, 0)])
def test_against_plain_loops(spark, limit, fresh, grams, percent):
    # The dictionary may learn all words, some or none.
    rows = corpus(random.Random(grams))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    target = spark.createDataFrame([(i, t) for i, t in enumerate(TARGET)], "item_id long, text string")
    got = importance.resampled(docs, target, grams=grams, percent=percent, words=limit, fresh=fresh)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    got, want = [tuple(r) for r in got.collect()], plain(rows, TARGET, grams, percent=percent)
    assert ranked(r[:4] for r in got) == ranked(r[:4] for r in want)
    # Rows with one id and one score may change places.
    assert sorted(r[4] for r in got if r[4]) == sorted(r[4] for r in want if r[4])
    assert ranked((r[4], r[0], r[3]) for r in got if r[4]) == ranked((r[4], r[0], r[3]) for r in want if r[4])


def test_empty_tables(spark):
    docs = spark.createDataFrame(corpus(random.Random(0))[:60], SCHEMA)
    target = spark.createDataFrame([(0, "w1 w2")], "item_id long, text string")
    assert importance.resampled(docs.limit(0), target).collect() == []
    got = [tuple(r) for r in importance.resampled(docs, target.limit(0)).collect()]
    assert ranked(got) == ranked(plain(corpus(random.Random(0))[:60], []))


WORD = st.text(st.characters(codec="utf-8", exclude_categories=["Cs"]), min_size=1, max_size=12)


@given(st.lists(st.tuples(st.binary(max_size=30), st.binary(max_size=300)), min_size=1, max_size=20))
def test_crc_of_two_strings_behind_each_other(pairs):
    first = np.array([zlib.crc32(a) for a, _ in pairs], np.uint32)
    second = np.array([zlib.crc32(b) for _, b in pairs], np.uint32)
    lengths = np.array([len(b) for _, b in pairs], np.int64)
    assert importance.appended(first, second, lengths).tolist() == [zlib.crc32(a + b) for a, b in pairs]


def test_crc_of_a_very_long_string():
    tail = b"ab" * 3_000_000
    got = importance.appended(np.array([zlib.crc32(b"head")], np.uint32), np.array([zlib.crc32(tail)], np.uint32), np.array([len(tail)]))
    assert got.tolist() == [zlib.crc32(b"head" + tail)]


@given(st.lists(st.lists(WORD, max_size=12), min_size=1, max_size=6), st.integers(1, 4), st.booleans())
def test_features_of_any_text(texts, grams, learn):
    bodies = [" ".join(t) for t in texts]
    raw = [f"{b} ".encode() for b in bodies]
    words = importance.Dictionary()
    if learn:
        words.fresh = {w.encode().decode("latin-1"): zlib.crc32(w.encode()) | len(w.encode()) << 32 for b in bodies for w in words_of(b)[::2]}
        if words.fresh:
            words._learn()
    found, first, n_words = importance.text_buckets(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]), grams, 10_000, words)
    for i, body in enumerate(bodies):
        assert sorted(found[first[i] : first[i + 1]].tolist()) == sorted(plain_features(body, grams, 10_000))
        assert n_words[i] == len(words_of(body))
