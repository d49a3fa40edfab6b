import duckdb
import pytest

from linecheck.llm import language
from linecheck.llm.queries import op10_language_id
from tests.llm.cases import awkward_docs, no_docs

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def found(spark):
    return {r.doc_id: r for r in op10_language_id(spark, FOLDER).collect()}


def test_accuracy_on_documents_that_were_held_out(found):
    rows = duckdb.sql(f"select doc_id, lang, length(text) from '{FOLDER}/documents.parquet'").fetchall()
    assert len(found) == len(rows)
    out = [(lang, found[i].lang_pred) for i, lang, n in rows if found[i].held_out and n >= 100]
    assert len(out) > 100 and sum(a == b for a, b in out) / len(out) > 0.97
    assert all(0 <= r.score <= 1 for r in found.values())


def test_awkward_documents(spark):
    docs = awkward_docs(spark, clashes=True)
    model = language.fit(docs)
    assert sorted(x for names in model.languages.values() for x in names) == ["de", "en"]
    rows = language.identified(docs, model).collect()
    assert len(rows) == docs.count()
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in rows:
        blank = not any(c.isalpha() for c in texts.get(r.doc_id) or "") and r.doc_id is not None
        assert (r.lang_pred == "und") == blank and (r.score == 0) == blank


def test_one_language_and_own_families(spark):
    one = spark.createDataFrame([(1, "abc", "xx"), (2, "abd", "xx")], "doc_id long, text string, lang string")
    assert language.fit(one).predict("zzz") == ("xx", 1.0)
    rows = [(i, t * 20, l) for i, (t, l) in enumerate([("abab ", "xx"), ("cdcd ", "yy"), ("efef ", "en"), ("ghgh ", "de")] * 5)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.families == ["germanic", "own xx", "own yy"]
    assert [model.predict(t * 9)[0] for t in ("abab ", "cdcd ", "efef ", "ghgh ")] == ["xx", "yy", "en", "de"]


def test_nothing_to_learn_from(spark):
    model = language.fit(no_docs(spark))
    assert model.predict("some text") == ("und", 0.0)
    assert language.identified(no_docs(spark), model).count() == 0
    assert {r.lang_pred for r in language.identified(awkward_docs(spark), model).collect()} == {"und"}


def test_rare_languages_are_learned_however_many_there_are(spark, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE", 10)
    monkeypatch.setattr(language, "LANGUAGES", 2)
    words = {"en": ("abab ", 200), "xx": ("cdcd ", 100), "yy": ("efef ", 3), "zz": ("ghgh ", 1)}
    rows = [(f"{lang}{i}", word * 20, lang) for lang, (word, n) in words.items() for i in range(n)]
    model = language.fit(spark.createDataFrame(rows, "doc_id string, text string, lang string"))
    assert sorted(x for names in model.languages.values() for x in names) == sorted(words)
    assert [model.predict(word * 9)[0] for word, _ in words.values()] == list(words)
