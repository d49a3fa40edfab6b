import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from linecheck.llm import graph, jaccard
from tests.llm.cases import awkward_docs, components, near_duplicates, no_docs, prose


def found(docs, size, percent):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs, size, percent).collect()}


def crowd(copies, seed=5):
    """Copies of one text with a few words changed, so that similarities lie around the threshold."""
    rnd = random.Random(seed)
    base = prose(11, 90).split(" ")
    texts = []
    for _ in range(copies):
        words = list(base)
        for at in rnd.sample(range(len(words)), rnd.choice((0, 1, 2, 3, 4, 6))):
            words[at] = f"w{rnd.randint(0, 9)}"
        texts.append(" ".join(words))
    return texts


@pytest.mark.parametrize("size, percent", [(4, 85), (5, 80), (1, 100)])
def test_awkward_documents(spark, size, percent):
    docs = awkward_docs(spark, clashes=True)
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id is not None}
    assert found(docs.where("doc_id is not null"), size, percent) == near_duplicates(texts, size, percent)


def test_rows_without_key_and_repeated_rows(spark):
    docs = awkward_docs(spark)
    rows = jaccard.near_duplicates(docs, 4, 85).collect()
    assert len(rows) == docs.count()
    assert sorted(r.component_id or -1 for r in rows if r.doc_id is None) == [-1, 6]
    assert len({r for r in rows if r.doc_id == 6}) == 1


def test_no_rows(spark):
    assert jaccard.near_duplicates(no_docs(spark), 4, 85).count() == 0
    assert jaccard.one_of_each(no_docs(spark), 4, 85).count() == 0


def test_crowds_go_through_long_lists_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SHORT", 8)
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 16)
    texts = dict(enumerate([*crowd(120), *[f"{prose(20 + i, 20)} {prose(12, 40)}" for i in range(40)]]))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert found(docs, 4, 85) == near_duplicates(texts, 4, 85)


def test_one_of_each_keeps_columns_and_smallest(spark):
    docs = awkward_docs(spark, clashes=True)
    left = jaccard.one_of_each(docs, 5, 80)
    assert left.columns == docs.columns
    kept = [r.doc_id for r in left.collect()]
    assert kept.count(6) == 2 and kept.count(None) == 2
    assert not {7, 8, 9, 21} & set(kept)
    assert {0, 1, 2, 3, 4, 11, 12, 19, 20} <= set(kept)


def test_links_connect_all_that_are_similar():
    rnd = random.Random(2)
    sets = [np.unique(np.array(rnd.choices(range(40), k=rnd.randint(1, 30)), np.uint64)) for _ in range(60)]
    a, b = jaccard.links(sets, 60)
    every = []
    for i in range(60):
        for j in range(i):
            n = len(set(sets[i].tolist()) & set(sets[j].tolist()))
            if 100 * n >= 60 * (len(sets[i]) + len(sets[j]) - n):
                every.append((j, i))
    assert {(min(x), max(x)) for x in zip(a, b, strict=True)} <= set(every)
    assert components(range(60), zip(a, b, strict=True)) == components(range(60), every)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components(spark, seed):
    rnd = random.Random(seed)
    edges = [(rnd.randint(0, 80), rnd.randint(0, 80)) for _ in range(50)] + [(200 + i, 201 + i) for i in range(40)]
    edges += [(5, 5), (300, 301), (301, 300)]
    ids = {x for e in edges for x in e}
    wanted = components(ids, edges)
    rows = graph.components(spark.createDataFrame([*edges, (None, 4)], "a long, b long")).collect()
    assert {r.node: r.root for r in rows} == {i: r for i, r in wanted.items() if i != r}


def test_no_edges(spark):
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_row_of_each_judges_rows(spark):
    base, near = prose(1, 120), " ".join([*prose(1, 118).split(" "), "end", "here"])
    other, third = prose(31, 60), prose(32, 60)
    rows = [(6, base, "x"), (6, base, "x"), (None, base, "x"), (None, near, "x"), (7, near, "x"), (7, other, "x")]
    rows += [(None, third, "x"), (None, third, "x"), (None, f"{third} end", "x"), (8, None, "x"), (8, "", "x"), (9, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, digest string")
    left = jaccard.one_row_of_each(docs, 5, 80)
    assert left.columns == docs.columns
    kept = [(r.doc_id, r.text) for r in left.collect()]
    lost = [t for i, t in kept if i is None]
    assert sorted((i, t or "") for i, t in kept if i is not None) == [(6, base), (7, other), (8, ""), (8, ""), (9, "")]
    assert len(lost) == 1 and lost[0] in (third, f"{third} end")


def test_pipeline_drops_copies_without_id_and_repeated_rows(spark):
    docs = awkward_docs(spark, clashes=True)
    left = corpus_pipeline.near_duplicates(spark, docs, "")
    assert left.columns == docs.columns
    kept = [r.doc_id for r in left.collect()]
    assert kept.count(6) == 1 and kept.count(11) == 1 and kept.count(None) == 1
    assert not {7, 8, 9, 21} & set(kept)


def test_repeated_rows_and_many_texts_of_a_key_are_compared_once(spark, monkeypatch):
    base = prose(11, 90).split(" ")
    texts = [" ".join([*base[:at], f"w{at}", *base[at + 1 :]]) for at in range(12)]
    rows = [*[(1, texts[0])] * 30, *[(2, t) for t in texts[1:11]], (3, texts[11]), (3, texts[11])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    seen = []
    verified = jaccard._verified

    def watched(docs, members, size, percent):
        same = ["rep", "mark"] if "mark" in members.columns else ["rep"]
        marked = docs.select(docs.doc_id.alias("rep"), F.xxhash64("text").alias("mark"), "text")
        seen.append((members.count(), members.join(marked, same).count()))
        return verified(docs, members, size, percent)

    monkeypatch.setattr(jaccard, "_verified", watched)
    left = jaccard.near_duplicates(docs, 4, 85).collect()
    assert len(left) == len(rows) and {r.component_id for r in left} == {1}
    assert seen == [(12, 12)]
