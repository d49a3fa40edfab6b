import random
import re

import pytest
from pyspark.sql import functions as F

from linecheck.llm import winnowing
from tests.llm.cases import awkward_docs, awkward_texts, no_docs, prose, sha

RUNS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string"


def words(text):
    return RUNS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def judged(text, items):
    """The operator's row for a text, by looking at every window of every item."""
    own = words(text)
    hit, found = set(), set()
    for item, other in items:
        w = words(other)
        size = min(len(w), winnowing.SIZE)
        windows = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if w else set()
        for i in range(len(own) - size + 1):
            if tuple(own[i : i + size]) in windows:
                hit.update(range(i, i + size))
                found.add(item)
    ids = sorted(str(i) for i in found - {None})
    return len(own), len(hit), len(ids), sha(",".join(ids).encode()), bool(hit)


def compare(spark, docs, items):
    found = winnowing.contaminated(docs, spark.createDataFrame(items, ITEMS))
    rows = sorted(tuple(r) for r in found.select(F.coalesce("doc_id", F.lit(-1)), *found.columns[1:]).collect())
    wanted = [(-1 if r.doc_id is None else r.doc_id, *judged(r.text, items)) for r in docs.collect()]
    assert rows == sorted(wanted)
    return rows


def test_awkward_documents_and_items(spark):
    texts = awkward_texts()
    base, passage = texts[6], prose(2, 60)
    items = [
        (1, base),
        (2, passage[40:260]),
        (3, f"Nothing of this occurs 77 {passage.upper()}"),
        (3, "one two"),
        (4, "One"),
        (10, "漢字 never, a"),
        (None, " ".join(base.split(" ")[20:40])),
        (5, None),
        (6, ""),
        (7, "... ---"),
        (8, "ab " * 40),
        (8, "ab " * 40),
        (9, texts[20][1000:1400]),
    ]
    rows = compare(spark, awkward_docs(spark, clashes=True), items)
    assert len({r[4] for r in rows}) > 3


@pytest.mark.parametrize("seed", range(4))
def test_few_words_that_repeat(spark, seed):
    """Texts of two or three words have equal hashes in every window."""
    rnd = random.Random(seed)
    kinds = "abc"[: 2 + seed % 2]

    def text(n):
        return " ".join(rnd.choice(kinds) for _ in range(n))

    docs = [(i, text(rnd.choice([0, 1, 3, 9, 10, 11, 40, 90]))) for i in range(40)]
    items = [(i, text(rnd.choice([9, 10, 11, 12, 20]))) for i in range(8)]
    if seed == 3:
        items += [(20 + n, text(n)) for n in range(8)]
    compare(spark, spark.createDataFrame(docs, "doc_id long, text string"), items)


def test_every_window_keeps_a_print(spark):
    text = prose(5, 300, "ab")
    row = spark.createDataFrame([(text,)], "text string").select(winnowing.words(F.col("text")).alias("words"))
    grams = winnowing.gram_hashes(row).first().grams
    prints = winnowing.fingerprints(row).first().prints
    assert len(prints) == len(set(prints)) < len(grams)
    for i in range(len(words(text)) - winnowing.SIZE + 1):
        assert min(grams[i : i + winnowing.SIZE - winnowing.GRAM + 1]) in prints


def test_boundaries_of_the_index_do_not_matter(spark, monkeypatch):
    """Joins without any broadcast give the same."""
    docs = [(i, prose(i % 7, 60)) for i in range(30)]
    items = [(i, prose(i, 30)) for i in range(5)]
    monkeypatch.setattr(winnowing, "small_side", lambda table: table)
    monkeypatch.setattr(winnowing, "is_small", lambda table: False)
    compare(spark, spark.createDataFrame(docs, "doc_id long, text string"), items)


def test_no_rows(spark):
    items = spark.createDataFrame([(1, prose(1, 30))], ITEMS)
    nothing = spark.createDataFrame([], ITEMS)
    assert winnowing.contaminated(no_docs(spark), items).count() == 0
    rows = winnowing.contaminated(awkward_docs(spark), nothing).collect()
    assert len(rows) == awkward_docs(spark).count() and not any(r.contaminated for r in rows)


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, prose(1, 30))], "doc_id long, text string")
    found = winnowing.contaminated(docs, spark.createDataFrame([(1, prose(1, 30))], ITEMS))
    plan = found._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
