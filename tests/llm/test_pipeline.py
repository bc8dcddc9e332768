"""Every stage of the pipeline against a plain version of it, on the smallest supplied tables."""

import collections
import os

import pytest
from test_jaccard import plain as plain_groups
from test_mixing import plain_targets
from test_secrets import plain as plain_spans
from tokenizers import Tokenizer

import corpus_pipeline
from wardflow.llm import bpe, quality
from wardflow.llm.common import staged, table

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no supplied tables")


@pytest.fixture(scope="module")
def stages(spark):
    docs = table(spark, FOLDER, "documents")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(staged(stage(spark, out[-1], FOLDER), "test-stage"))
    return [s.collect() for s in out], [s.columns for s in out]


def test_columns_stay(stages):
    rows, columns = stages
    assert all(c == columns[0] for c in columns[:-1])
    assert all(rows)


def test_rejected_documents_go(spark, stages):
    scored = quality.classify(table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels")).where("predicted = 1").collect()
    assert sorted(s.doc_id for s in scored) == sorted(r.doc_id for r in stages[0][1])


def test_one_document_per_group(stages):
    before, after = stages[0][1], stages[0][2]
    groups = plain_groups([(r.doc_id, r.text) for r in before], 5, 80)
    want = {g for _, n, g in groups if n} | {d for d, n, _ in groups if not n}
    assert sorted(r.doc_id for r in after) == sorted(want)


def test_secrets_are_replaced(stages):
    clean = {r.doc_id: r for r in stages[0][3]}
    assert len(clean) == len(stages[0][2])
    for r in stages[0][2]:
        out, at = "", 0
        for start, _, kind, end in plain_spans(r.text, 300)[1]:
            if start >= at:
                out += r.text[at:start] + f"[{kind}]"
            at = max(at, end)
        assert clean[r.doc_id].text == out + r.text[at:] and clean[r.doc_id].n_chars == len(out + r.text[at:])


def test_sources_meet_their_targets(stages):
    size = collections.Counter()
    for r in stages[0][3]:
        size[r.source] += len(r.text.split())
    taken = collections.Counter()
    for r in stages[0][4]:
        taken[r.source] += len(r.text.split())
    longest = max(len(r.text.split()) for r in stages[0][3])
    for source, target in plain_targets(size).items():
        assert abs(taken[source] - target) <= max(5, 0.02 * target, min(longest, 0.1 * target))
    assert max(collections.Counter(r.doc_id for r in stages[0][4]).values()) <= 3


def test_ids_equal_the_library(stages):
    library = Tokenizer.from_file(bpe.vocabulary_path())
    want = sorted((r.doc_id, library.encode(r.text, add_special_tokens=False).ids) for r in stages[0][4])
    assert sorted((r.doc_id, list(r.ids)) for r in stages[0][5]) == want


def test_run_is_the_stages(spark, stages):
    got = corpus_pipeline.run(spark, FOLDER).select("doc_id", "n_tokens").collect()
    assert sorted(map(tuple, got)) == sorted((r.doc_id, r.n_tokens) for r in stages[0][5])


def test_encoding_takes_one_pass(spark):
    """A second pass in Python holds a second worker with a vocabulary for each task, on top of the memory of the stages."""
    texts = ["", None, "a word", "  two  spaces\n", "é 漢字 \U0001f600 <|endoftext|>", "x" * 3000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    got = corpus_pipeline.bpe_encoding(spark, docs, FOLDER)
    assert got._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    want = bpe.decode(bpe.encode(docs)).select(*bpe.digest_columns(), "ids")
    assert got.columns == want.columns and got.schema["ids"].dataType == want.schema["ids"].dataType
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
