import math

import numpy as np
import pytest
import xxhash

from linecheck.llm import mixing
from tests.llm.cases import DOCS, awkward_docs, no_docs


def corpus(spark):
    rows, at = [], 0
    for source, docs, words in (("big", 300, 10), ("mid", 60, 12), ("low", 20, 9), (None, 10, 11)):
        for i in range(docs):
            rows.append((at, " ".join(["w"] * (words + i % 5)), "en", source, None))
            at += 1
    return spark.createDataFrame(rows, DOCS)


def entropy(shares, e):
    p = np.array(shares) ** e
    p = p / p.sum()
    return float(-(p * np.log(p)).sum())


@pytest.mark.parametrize("seed", [0, 1])
def test_entropy_is_met_and_budgets_are_filled(spark, seed, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 16)
    docs = corpus(spark)
    target = mixing.Target(entropy=0.8, passes=9.0, seed=seed)
    texts = docs.collect()
    totals = {}
    for r in texts:
        totals[r.source] = totals.get(r.source, 0) + len(r.text.split())
    whole = sum(totals.values())
    shares = [t / whole for t in totals.values()]
    rows = docs.select("source", mixing.n_tokens(docs.text).alias("tokens"))
    plan = mixing.weights(rows, target).collect()
    assert sum(r.weight for r in plan) == pytest.approx(1)
    found = -sum(r.weight * math.log(r.weight) for r in plan)
    assert found == pytest.approx(0.8 * math.log(4), abs=1e-6) and entropy(shares, 1) < found < entropy(shares, 0)

    used = mixing.schedule(docs, target).collect()
    for r in plan:
        own = [u for u in used if u.source == r.source]
        spent = sum(u.n_tokens for u in own)
        assert r.budget - 16 < spent <= r.budget * (1 + 1e-9)
        ids = {t.doc_id for t in texts if t.source == r.source}
        for epoch in range(int(r.budget // r.tokens)):
            assert {u.doc_id for u in own if u.epoch == epoch} == ids
        in_order = sorted(own, key=lambda u: u.position)
        assert [u.epoch for u in in_order] == sorted(u.epoch for u in own)
        before = 0
        for u in in_order:
            assert u.position == pytest.approx(before / r.budget)
            before += u.n_tokens


def hashed(*values):
    """Spark's 64-bit hash of whole numbers, each with its width in bytes; missing ones are passed over."""
    h = 42
    for value, width in values:
        if value is not None:
            h = xxhash.xxh64(value.to_bytes(width, "little", signed=True), seed=h % 2**64).intdigest()
    return h - 2**64 if h >= 2**63 else h


def restated(rows, budgets, seed, size):
    """The schedule of (key, source, tokens): source by source, pass by pass, block by block."""
    found = []
    for source, budget in budgets.items():
        tokens = {}
        for key, own, n in rows:
            if own == source:
                tokens[key] = tokens.get(key, 0) + n
        blocks = {}
        for key in tokens:
            blocks.setdefault(hashed((seed, 4), (key, 8)) % -(-len(tokens) // size), []).append(key)
        used = epoch = 0
        while epoch <= 1000 and used < budget:
            for block in sorted(blocks, key=lambda b: (hashed((seed, 4), (epoch, 8), (b, 8)), b)):
                for key in sorted(blocks[block], key=lambda k: (hashed((seed, 4), (epoch, 8), (k, 8)), k is not None, k or 0)):
                    if used + tokens[key] <= budget * (1 + 1e-12):
                        found.append((-1 if key is None else key, str(source), tokens[key], epoch, round(used / budget, 9)))
                    used += tokens[key]
            epoch += 1
    return sorted(found)


@pytest.mark.parametrize("seed, entropy_wanted", [(0, 0.8), (5, 0.99)])
def test_schedule_is_that_of_plain_loops(spark, seed, entropy_wanted, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 16)
    extra = [(None, "w w w", "en", "mid", None), (None, "w", "en", "mid", None), (3, "w w", "en", "big", None), (7000, None, "en", "low", None)]
    docs = corpus(spark).union(spark.createDataFrame(extra, DOCS))
    target = mixing.Target(entropy=entropy_wanted, passes=9.0, seed=seed)
    counted = docs.select("doc_id", "source", mixing.n_tokens(docs.text).alias("tokens"))
    rows = [(r.doc_id, r.source, r.tokens) for r in counted.collect()]
    budgets = {r.source: r.budget for r in mixing.weights(counted, target).collect()}
    found = [
        (-1 if r.doc_id is None else r.doc_id, str(r.source), r.n_tokens, r.epoch, round(r.position, 9))
        for r in mixing.schedule(docs, target).collect()
    ]
    assert sorted(found) == restated(rows, budgets, seed, 16)


def test_passes_limit_the_mixture(spark):
    docs = corpus(spark)
    rows = docs.select("source", mixing.n_tokens(docs.text).alias("tokens"))
    plan = mixing.weights(rows, mixing.Target(entropy=1.0, passes=2.0)).collect()
    assert max(r.budget / r.tokens for r in plan) == pytest.approx(2.0, rel=1e-6)
    plan = mixing.weights(rows, mixing.Target(entropy=1.0, passes=0.5)).collect()
    assert [r.weight for r in plan] == pytest.approx([r.share for r in plan])


def test_awkward_documents(spark):
    docs = awkward_docs(spark, clashes=True)
    used = mixing.schedule(docs, mixing.Target(entropy=0.5, passes=2.0)).collect()
    keys = {(r.doc_id, r.source) for r in docs.collect()}
    assert {(r.doc_id, r.source) for r in used} <= keys
    mixture = mixing.mixture(docs, mixing.Target(entropy=0.5, passes=2.0))
    assert mixture.columns == docs.columns
    # Repeated rows are used together.
    rows = [r.doc_id for r in mixture.collect()]
    assert rows.count(6) == 2 * sum(u.doc_id == 6 for u in used)


def test_nothing_to_mix(spark):
    target = mixing.Target(entropy=0.9, passes=2.0)
    assert mixing.schedule(no_docs(spark), target).count() == 0
    blank = spark.createDataFrame([(1, "", "en", "a", 0), (2, None, "en", None, 0)], DOCS)
    assert mixing.mixture(blank, target).count() == 0
