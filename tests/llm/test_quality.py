"""Statistics against plain Python, trees against a plain walk, and accuracy on rows the model never saw."""

import os
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wardflow.llm import quality
from wardflow.llm.common import table, text_bytes

FOLDER = "/root/testdata/sf0.01"


def test_statistics_of_a_text():
    texts = ["", "One two  two\nTHREE|| 4é", "x", "a b c d a b c d", "\n", "w " * 3000]
    data, offsets = text_bytes(pa.array(texts))
    x = quality.statistics(data, offsets)
    assert np.isfinite(x).all()
    for row, t in zip(x, texts, strict=True):
        words, size = t.split(), max(1, len(t.encode()))
        some = max(1, len(words))
        assert row[1] == np.float32(np.log1p(len(words)))
        assert row[4] == np.float32(sum(len(w.encode()) for w in words) / some)
        assert row[12] == np.float32(sum(a == b for a, b in zip(words, words[1:], strict=False)) / some)
        assert row[13] == np.float32(len(set(words)) / some)
        assert row[14] == np.float32(max([words.count(w) for w in set(words)], default=0) / some)
        runs = [tuple(words[i : i + 4]) for i in range(len(words) - 3)]
        assert row[15] == np.float32(len(set(runs)) / len(runs) if runs else 1)
        assert row[18] == np.float32(sum("A" <= c <= "Z" for c in t) / size)
    # A text gives the same numbers wherever it stands in a block.
    alone = [quality.statistics(*text_bytes(pa.array([t])))[0] for t in texts]
    assert (x == np.array(alone)).all()


def test_flat_trees_equal_a_plain_walk():
    r = np.random.default_rng(1)
    x = r.normal(size=(800, 5)).astype(np.float32)
    y = ((x[:, 0] > 0.2) ^ (x[:, 3] > -0.1)).astype(float)
    f = quality.fit(x, y, trees=12, depth=3)

    def walk(row):
        out = f.base
        for feature, border, leaf in zip(f.feature, f.border, f.leaf, strict=True):
            node = 0
            for _ in range(3):
                node = 2 * node + (2 if row[feature[node]] > border[node] else 1)
            out += leaf[node - 7]
        return out

    assert np.allclose(f.margin(x), [walk(row) for row in x])
    assert ((f.score(x) > 0.5) == (y > 0.5)).mean() > 0.95
    assert len(quality.fit(x[:0], y[:0]).leaf) == 0 and quality.fit(x, y * 0).score(x).max() < 0.01


def test_edge_rows(spark):
    rows = [(i, t, "s") for i, t in enumerate([None, "", "good text here " * 20, "bad bad bad bad " * 20] * 10)]
    rows += [(None, "no id", "s"), (3, "bad bad bad bad " * 20, "s"), (3, "bad bad bad bad " * 20, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, None if i % 7 == 0 else int(i % 4 == 2)) for i in range(50)] + [(None, 1)], "doc_id long, quality int")
    got = quality.classify(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= g.score <= 1 and g.predicted == int(g.score >= 0.7) for g in got)
    assert all(g.held_out == (g.doc_id is not None and zlib.crc32(str(g.doc_id).encode()) % 4 == 2) for g in got)
    assert len({g.score for g in got if g.doc_id == 3}) == 1
    assert [g.score for g in quality.classify(docs, labels.limit(0)).collect()] == [0.5] * len(rows)
    assert quality.classify(docs.limit(0), labels).collect() == []
    kept = quality.keep_good(docs, labels, threshold=0.0)
    assert kept.columns == docs.columns and kept.count() == len(rows)


def test_held_out_labels_change_nothing(spark):
    docs = spark.createDataFrame([(i, "word " * (i % 17) + "x" * (i % 5)) for i in range(300)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id long, quality int")
    flipped = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted(quality.classify(docs, x).collect()) for x in (labels, flipped))
    assert a == b


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no supplied tables")
def test_accuracy_on_held_out_rows(spark):
    labels = table(spark, FOLDER, "labels")
    got = quality.classify(table(spark, FOLDER, "documents"), labels).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([g.predicted == g.quality for g in got]) > 0.9
