"""Exact dedup against a dictionary of normalised texts, and the codes it sends."""

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from wardflow.llm import exactdedup

SCHEMA = "doc_id long, text string, block string, norm string, id int, pos int"


def corpus(r):
    texts = [" ".join(r.choice("ab") for _ in range(r.randint(1, 4))) for _ in range(300)]
    texts += [None, "", None, "", " ", "\t\n", "  ", "a b", "a  b", "a b", "a\x0bb", "é", "é", "x" * 300_000, "x" * 300_000, " x", "x "]
    rows = [(r.randint(0, 400), t, "clash", None, 1, i) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, "only here", "", None, 0, 0), (None, "only here", "", None, 0, 1), (None, "a b", "", None, 0, 2), (-5, "a b", "", None, 0, 3)]
    return rows


def plain(rows):
    classes = {}
    for d, t, *_ in rows:
        classes.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(d)
    out = []
    for text, ids in classes.items():
        ordered = sorted(ids, key=lambda d: (d is None, d))
        digest = hashlib.sha256(text.encode()).hexdigest()
        out += [(d, ordered[0], len(ids), i == 0, digest) for i, d in enumerate(ordered)]
    return sorted(out, key=str)


@pytest.mark.parametrize(("slack", "owner"), [(exactdedup.SLACK, exactdedup.OWNER), (exactdedup.SLACK, 7), (0, 50), (-8, 3)])
def test_against_a_dictionary(spark, monkeypatch, slack, owner):
    # With few bits many rows are suspected for nothing; the result stays the same.
    monkeypatch.setattr(exactdedup, "SLACK", slack)
    monkeypatch.setattr(exactdedup, "OWNER", owner)
    rows = corpus(random.Random(owner))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert sorted(map(tuple, exactdedup.duplicates(docs).collect()), key=str) == plain(rows)


def test_one_row_of_each_class_stays_with_all_columns(spark):
    rows = corpus(random.Random(1))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    kept = exactdedup.deduplicated(docs)
    assert kept.columns == docs.columns
    got = [tuple(r) for r in kept.collect()]
    def folded(r):
        return re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "")

    smallest = {folded(r): min((d for d, t, *_ in rows if folded((0, t)) == folded(r)), key=lambda d: (d is None, d)) for r in got}
    assert all(smallest[folded(r)] == r[0] for r in got)
    assert set(got) <= set(rows) and len(got) == sum(r[3] for r in plain(rows))


def test_empty_and_single(spark):
    docs = spark.createDataFrame(corpus(random.Random(2)), SCHEMA)
    assert exactdedup.duplicates(docs.limit(0)).collect() == [] == exactdedup.deduplicated(docs.limit(0)).collect()
    assert [tuple(r)[:4] for r in exactdedup.duplicates(docs.where("pos = 5").limit(1)).collect()][0][2:] == (1, True)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("wardflow_exact")]


def test_hot_text(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'the same', concat('own ', id)) AS text").repartition(8)
    got = exactdedup.duplicates(docs)
    assert got.where("group_size = 1000 AND keep_id = 0").count() == 1000 and got.where("kept").count() == 2001


@given(st.sets(st.integers(0, 2**40), max_size=200), st.integers(0, 40))
def test_codes(values, low):
    ordered = np.array(sorted(values), np.int64)
    if len(ordered) and np.diff(ordered, prepend=0).max() >> low > 10_000:
        return  # gaps that long are not coded with so few low bits
    assert exactdedup.from_golomb(exactdedup.golomb(ordered, low)).tolist() == ordered.tolist()


def test_codes_are_short():
    r = np.random.default_rng(0)
    span, n = 2**36, 50_000
    values = np.unique(r.integers(0, span, n))
    code = exactdedup.golomb(values, exactdedup.low_bits(span, len(values)))
    assert exactdedup.from_golomb(code).tolist() == values.tolist()
    assert 8 * len(code) / len(values) < np.log2(span / n) + 1.7


@given(st.integers(0, 500_000_000))
def test_every_fingerprint_has_an_owner(n_rows):
    ranges = exactdedup.Ranges(n_rows)
    prints = ranges.prints(np.array([-1, 0, 1, 2**63 - 1, -(2**63)], np.int64))
    assert prints.min() >= 0 and prints.max() // ranges.width < ranges.n_owners
