"""Every stage on what the one before has kept, against plain restatements."""

from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from linecheck.llm import bpe, repeats
from linecheck.llm.oracle import OP8
from tests.llm.cases import awkward_docs, covered, near_duplicates, no_docs

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark):
    """The documents after each stage."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = [docs.collect()]
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(found[-1], docs.schema)
        docs = stage(spark, docs, FOLDER)
        found.append(docs.collect())
    return found


def test_stages_keep_the_columns(kept):
    for rows in kept[1:5]:
        assert rows[0].asDict().keys() == kept[0][0].asDict().keys()


def test_quality_rules(kept):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{FOLDER}/documents.parquet'")
    wanted = [i for (i,) in con.execute(f"select doc_id from ({OP8}) where kept").fetchall()]
    assert sorted(r.doc_id for r in kept[1]) == sorted(wanted)


def test_near_duplicates(kept):
    root = near_duplicates({r.doc_id: r.text for r in kept[1]}, 5, 80)
    assert sorted(r.doc_id for r in kept[2]) == sorted(i for i, (_, c) in root.items() if i == c)
    assert len(kept[2]) < len(kept[1])


def test_repeated_passages(kept):
    texts = {r.doc_id: r.text for r in kept[2]}
    found = {r.doc_id: r for r in kept[3]}
    assert found.keys() == texts.keys()
    for i, (raw, marks) in covered(texts, 100).items():
        edges = np.flatnonzero(np.diff(np.concatenate(([0], np.frombuffer(marks, np.int8), [0])))).reshape(-1, 2)
        left, at = [], 0
        for a, b in repeats.whole_characters(raw, edges).tolist():
            left.append(raw[at:a])
            at = b
        text = b"".join([*left, raw[at:]]).decode()
        assert found[i].text == text and found[i].n_chars == len(text)


def test_source_mixing(kept):
    before, after = Counter(r.doc_id for r in kept[3]), Counter(r.doc_id for r in kept[4])
    assert after.keys() <= before.keys() and max(after.values()) <= 2
    words = {r.doc_id: len(r.text.split()) for r in kept[3]}
    spent = sum(n * words[i] for i, n in after.items())
    assert 0.9 * sum(words.values()) < spent <= sum(words.values()) * (1 + 1e-9)


def test_tokens(kept):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = bpe.parsed(file.read())
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text for r in kept[4]}
    assert Counter(r.doc_id for r in kept[5]) == Counter(r.doc_id for r in kept[4])
    for r in kept[5]:
        assert r.token_ids == own.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.n_bytes) == (len(r.token_ids), len(texts[r.doc_id].encode()))


def test_awkward_documents_and_none(spark):
    for docs in (awkward_docs(spark, clashes=True), no_docs(spark)):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = spark.createDataFrame(stage(spark, docs, "").collect(), stage(spark, docs, "").schema)
            assert docs.columns == columns or name == corpus_pipeline.STAGES[-1][0]
        assert "token_ids" in docs.columns


def test_tokens_need_one_python_process_a_task(spark):
    docs = awkward_docs(spark, clashes=True)
    plan = corpus_pipeline.tokens(spark, docs, "")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_tokens_of_awkward_documents_in_small_pieces(spark):
    docs = awkward_docs(spark, clashes=True)
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = bpe.parsed(file.read())
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        found = corpus_pipeline.tokens(spark, docs, "").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    texts = Counter((r.doc_id, tuple(own.encode_ordinary(r.text or "")), len((r.text or "").encode())) for r in docs.collect())
    assert Counter((r.doc_id, tuple(r.token_ids), r.n_bytes) for r in found) == texts
    assert all(r.n_tokens == len(r.token_ids) for r in found)
