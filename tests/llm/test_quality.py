import duckdb
import pytest

from linecheck.llm import quality
from linecheck.llm.oracle import OP8
from tests.llm.cases import awkward_docs, awkward_texts, no_docs

COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "failed")


def test_ledger_equals_sql_on_awkward_texts(spark):
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    texts = [t.replace("\0", "") if t else t for t in awkward_texts()]
    con.executemany("insert into documents values (?, ?)", list(enumerate(texts)))
    wanted = con.execute(f"select doc_id, {', '.join(COLUMNS)} from ({OP8}) order by doc_id").fetchall()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = quality.ledger(docs).select("doc_id", *COLUMNS).orderBy("doc_id").collect()
    assert [tuple(row) for row in found] == wanted


def test_repeated_rows_missing_keys_and_clashing_columns(spark):
    docs = awkward_docs(spark, clashes=True)
    rows = quality.ledger(docs).collect()
    assert len(rows) == docs.count()
    assert sum(row.doc_id is None for row in rows) == 2
    assert len({row[1:] for row in rows if row.doc_id == 6}) == 1
    assert quality.accepted(docs, ("prose", 2)).columns == docs.columns


def test_accepted_are_those_without_failed_bits(spark):
    docs = awkward_docs(spark)
    good = quality.ledger(docs).where(quality.passes(quality.F.col("failed"), ("prose", 2)))
    left = quality.accepted(docs, ("prose", 2))
    assert sorted(r.doc_id or -1 for r in good.collect()) == sorted(r.doc_id or -1 for r in left.collect())
    assert {6, 20} <= {r.doc_id for r in left.collect()}
    assert not {0, 1, 2, 3, 18, 19} & {r.doc_id for r in left.collect()}


def test_no_rows(spark):
    assert quality.ledger(no_docs(spark)).count() == 0
    assert quality.accepted(no_docs(spark), ("prose", 1)).count() == 0
    counts = quality.ablations(quality.ledger(no_docs(spark)), ("prose", 1)).collect()
    assert [(r.n_failed, r.n_only, r.n_kept_without) for r in counts] == [(0, 0, 0)] * 3


@pytest.mark.parametrize("policy", list(quality.POLICIES))
def test_ablations_are_policies_without_one_rule(spark, policy):
    rows = quality.ledger(awkward_docs(spark))
    bits = [r.failed for r in rows.collect()]
    whole = quality.mask(quality.POLICIES[policy])
    for r in quality.ablations(rows, policy).collect():
        bit = quality.mask((r.rule,))
        assert r.n_failed == sum(b & bit != 0 for b in bits)
        assert r.n_kept_without == sum(b & (whole - bit) == 0 for b in bits)
        assert r.n_only == r.n_kept_without - sum(b & whole == 0 for b in bits)


def test_words_in_repeated_windows():
    def count(text):
        return quality.measured(text.encode())[quality.MEASURES.index("n_repeat_words")]

    assert count("a b c") == 0
    assert count("a b c a b c") == 6
    assert count("a a a a") == 4
    assert count("a b c x a b c") == 6
    assert count("A b c a b c") == 0
