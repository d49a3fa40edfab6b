from itertools import combinations

import pytest
from pyspark.sql import functions as F

from linecheck.llm import urls
from linecheck.llm.queries import URL_RULES, op9_url_filters

URLS = [
    None,
    "",
    "no scheme/en/",
    "http://",
    "://x",
    "HTTP://WWW.Example.COM/en/1",
    "http://example.com/en/1?x=://y/z#t",
    "http://badexample.com/en/",
    "http://a.b.example.com/en/",
    "http://example.com/en",
    "http://example.com?en/",
    "http://example.com#/en/",
    "https://m.spot.net/es/5",
    "https://m.spot.net/fr",
    "https://net/fr/\n/x",
    "http://ÄB.org/ü?k=v&k=w&=q",
    "http://x.org//9/a/",
]


def split(url):
    rest = (url or "").partition("://")
    if not rest[1]:
        return "", ""
    rest = rest[2]
    end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host, rest = rest[:end], rest[end:]
    path = rest[: min((rest.find(c) for c in "?#" if c in rest), default=len(rest))]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def ruled(host, path):
    fits = [
        (rule, verdict)
        for rule, verdict in URL_RULES
        if (host == rule.partition("/")[0] or host.endswith("." + rule.partition("/")[0]))
        and path.startswith("/" + rule.partition("/")[2])
    ]
    return max(fits, key=lambda f: len(f[0]), default=(None, None))


def frame(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, items string, hit string, rule string")


def test_stated_rules(spark):
    rows = [(i, u, "x", "y", "z") for i, u in enumerate(URLS)] + [(5, URLS[5], "x", "y", "z"), (None, URLS[5], "x", "y", "z")]
    none = urls.mined(spark.createDataFrame([], "url string, blocked boolean"))
    found = urls.judged(frame(spark, rows), URL_RULES, none).collect()
    assert len(found) == len(rows)
    for r in found:
        host, path = split(r.url)
        rule, verdict = ruled(host, path)
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict or "allow")


def test_tokens(spark):
    rows = frame(spark, [(i, u, "", "", "") for i, u in enumerate(URLS)])
    found = {r.page_id: r.t for r in rows.select("page_id", urls.tokens(rows.url).alias("t")).collect()}
    assert found[0] == found[1] == found[2] == []
    assert found[5] == ["host=www", "host=example", "host=com", "path=en", "path=0"]
    assert found[15] == ["host=ÄB", "host=org", "path=ü", "key=k"] or found[15][0].startswith("host=")


@pytest.fixture(scope="module")
def labelled():
    rows = []
    for i in range(60):
        spam = i % 3 == 0
        host = "win.casino.org" if spam else ("www.casino.org" if i % 2 else "win.news.org")
        rows.append((f"http://{host}/en/{i}", spam))
    rows += [("http://old.shop.org/de/1", True), ("http://old.shop.org/de/2", False), (None, True), ("http://x.org/", None)]
    return rows


def test_mined_rules_equal_all_combinations(spark, labelled):
    def tokens(url):
        host, path = split(url)
        items = [f"host={h}" for h in host.split(".") if h]
        return frozenset(items + [f"path={'0' if p.isdigit() else p}" for p in path.split("/") if p])

    known = [(tokens(u), b) for u, b in labelled if u is not None and b is not None]
    every = {frozenset(c) for t, _ in known for n in range(1, len(t) + 1) for c in combinations(sorted(t), n)}
    rules = {}
    for items in every:
        hits = [b for t, b in known if items <= t]
        if sum(hits) >= 0.02 * len(known) and sum(hits) / len(hits) >= 0.6:
            rules[items] = sum(hits) / len(hits)
    least = {r for r in rules if not any(s < r and rules[s] >= rules[r] for s in rules)}
    mined = urls.mined(spark.createDataFrame(labelled, "url string, blocked boolean"), 0.02, 0.6)
    assert {frozenset(r.items) for r in mined.collect()} == least
    assert frozenset({"host=win", "host=casino"}) in least

    pages = [(i, u, "", "", "") for i, (u, _) in enumerate(labelled)]
    found = urls.judged(frame(spark, pages), (), mined).collect()
    for r in found:
        hit = r.url is not None and any(items <= tokens(r.url) for items in least)
        assert r.verdict == ("block" if hit else "allow")


def test_no_pages(spark, labelled):
    mined = urls.mined(spark.createDataFrame(labelled, "url string, blocked boolean"), 0.02, 0.6)
    assert urls.judged(frame(spark, []), URL_RULES, mined).count() == 0


def test_number_of_the_document(spark):
    wanted = {
        "http://a.org/en/7817": 7817,
        "http://a.org/en/7817/?page=2": 7817,
        "http://a.org/2/en/78.html#9": 78,
        "http://a.org/en/7x": None,
        "http://a.org/en/?id=5": None,
        "http://a.org:80": None,
        f"http://a.org/{'9' * 30}": None,
        None: None,
    }
    rows = spark.createDataFrame([(u,) for u in wanted], "url string").select("url", urls.document(F.col("url")).alias("n"))
    assert {r.url: r.n for r in rows.collect()} == wanted


def test_pages_are_labelled_by_the_document_they_show(spark, tmp_path):
    spam = [i % 3 == 0 for i in range(60)]
    pages = [(1000 + i, f"http://{'spam' if spam[i] else 'news'}.site{i}.info/en/{i}.html") for i in range(60)]
    # By page_id, the labels would be the other way round.
    labels = [(i, int(not spam[i]), 0) for i in range(60)] + [(1000 + i, int(spam[i]), 0) for i in range(60)] + [(0, 1, 0)]
    spark.createDataFrame(pages, "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    found = op9_url_filters(spark, str(tmp_path)).collect()
    assert {r.page_id: r.verdict for r in found} == {1000 + i: "block" if spam[i] else "allow" for i in range(60)}


def test_chance_hits_are_no_rule(spark):
    rows = [(f"http://a{i}.org/x/", i < 9) for i in range(300)] + [("http://bad.net/", True)] * 9 + [("http://ill.net/", True)] * 10
    mined = urls.mined(spark.createDataFrame(rows, "url string, blocked boolean"))
    assert {tuple(r.items) for r in mined.collect()} == {("host=ill",), ("host=net",)}
