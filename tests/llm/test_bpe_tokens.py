"""Encoding against the tokenizers library, decoding as a round trip, and the length histogram against plain counts."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wardflow.llm import bpe, tokens

LETTERS = [*map(chr, range(1, 300)), "\x85", "\xa0", " ", "　", "​", "\U0001f600", "中", "²", "'s", "'ll", " ", "  ", "the", "\n\n", "<|endoftext|>"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.vocabulary_path())


def texts(n=400):
    r = random.Random(7)
    out = ["".join(r.choice(LETTERS) for _ in range(r.randint(0, 60))) for _ in range(n)]
    return [*out, "", " ", "a" * 3000, " " * 2000, "ab" * 2000, "word " * 5000, "the the", " lead", "trail "]


def test_ids_equal_the_library(library):
    vocab = bpe.vocabulary(bpe.vocabulary_path(), bpe.piece_pattern())
    want = [e.ids for e in library.encode_batch(texts(), add_special_tokens=False)]
    assert vocab.encode(texts()) == want
    assert vocab.encode(texts()) == want  # from memory


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    vocab = bpe.Vocabulary(bpe.vocabulary_path(), bpe.piece_pattern())
    for t in texts(60):
        assert vocab.encode([t])[0] == library.encode(t, add_special_tokens=False).ids


def test_decoding_broken_bytes(library):
    vocab = bpe.vocabulary(bpe.vocabulary_path(), bpe.piece_pattern())
    ids = library.encode("中é", add_special_tokens=False).ids
    for part in (ids[:1], ids[1:], ids[:2], ids):
        assert vocab.decode(np.array(part), np.array([0, len(part)])) == [library.decode(part, skip_special_tokens=False)]


def test_digests(spark, library):
    rows = [(1, "a  b <|endoftext|> é\n", "x"), (2, None, "y"), (3, "", None), (1, "a  b <|endoftext|> é\n", "x"), (None, "word " * 3000, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").withColumn("decoded", F.lit(1))
    got = sorted(bpe.digests(docs).collect(), key=str)
    want = []
    for doc_id, text, _ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want.append((doc_id, len(ids), *[hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), back)]))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert bpe.digests(docs.limit(0)).collect() == []


def test_histogram_and_sums(spark, library, monkeypatch):
    monkeypatch.setattr(tokens, "BLOCK", 4)
    r = random.Random(3)
    rows = [(i, r.choice([None, "", "a b", "tok " * r.randint(1, 30)]), r.choice(["s", None])) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("n_tokens", F.lit("clash")).drop("n_tokens")
    lengths = [len(library.encode(t or "", add_special_tokens=False).ids) for _, t, _ in rows]
    for got in tokens.suffix_sums(tokens.length_histogram(docs)).collect():
        limit = got.n_tokens
        assert got.n_docs == lengths.count(limit) and got.docs == 120 and got.tokens == sum(lengths)
        assert got.docs_over == sum(x > limit for x in lengths) and got.docs_within == 120 - got.docs_over
        assert got.tokens_within == sum(x for x in lengths if x <= limit)
        assert got.tokens_kept == sum(min(x, limit) for x in lengths) and got.tokens_cut == sum(lengths) - got.tokens_kept
    sums = tokens.suffix_sums(tokens.length_histogram(docs))
    for row in tokens.at_limits(sums, [0, 7, 1000]).collect():
        assert row.tokens_kept == sum(min(x, row.context_limit) for x in lengths)
    for row in tokens.quantiles(sums, [0.1, 0.5, 1.0]).collect():
        assert row.n_tokens == sorted(lengths)[-(-round(row.share * 1200) // 10) - 1]
    by_source = tokens.suffix_sums(tokens.length_histogram(docs, by=["source"]), by=["source"]).collect()
    for s in ("s", None):
        own = [n for n, (_, _, src) in zip(lengths, rows, strict=True) if src == s]
        assert {(g.n_tokens, g.docs_over) for g in by_source if g.source == s} == {(n, sum(x > n for x in own)) for n in own}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert tokens.suffix_sums(tokens.length_histogram(docs)).collect() == []
