import random

import duckdb
import pytest

from linecheck.llm import topk
from linecheck.llm.oracle import OP3
from linecheck.llm.queries import op3_exact_topk

VECTORS = "id long, vector array<long>, asks boolean, block string, rank string"


def brute(rows, k):
    good = [(name, vector, bool(asks)) for name, vector, asks in rows if name is not None and vector is not None and None not in vector]
    found = []
    for name in {name for name, _, asks in good if asks}:
        own = [vector for other, vector, asks in good if asks and other == name]
        scores = [(-sum(a * b for a, b in zip(q, v, strict=False)), o) for q in own for o, v, _ in good if o != name]
        found += [(name, i + 1, o, -s) for i, (s, o) in enumerate(sorted(scores)[:k])]
    return sorted(found)


def run(spark, rows, k):
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], VECTORS)
    return sorted(tuple(r) for r in topk.top_k(frame, "asks", k).select("query_id", "rank", "vec_id", "score").collect())


def some(n, dims, most, seed=1):
    rnd = random.Random(seed)
    return [(i, [rnd.randint(-most, most) for _ in range(dims)], i % 7 == 0) for i in range(n)]


@pytest.mark.parametrize("block, queries", [(4096, 1024), (16, 5)])
def test_equals_all_inner_products(spark, monkeypatch, block, queries):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "QUERIES", queries)
    rows = some(150, 12, 60) + [(1000 + i, [3] * 12, i == 0) for i in range(40)]
    rows += [(2000, [0] * 12, True), (2001, [500] * 12, True), (2002, [-500] * 12, True)]
    assert run(spark, rows, 20) == brute(rows, 20)


def test_awkward_rows(spark):
    rows = some(8, 3, 5)
    rows += [(None, [1, 2, 3], True), (50, None, True), (51, [1, None, 2], True), (52, [], True), (53, [4], True)]
    rows += [(3, [9, 9, 9], True), (3, [9, 9, 9], None), (54, [1, 1, 1], None)]
    assert run(spark, rows, 20) == brute(rows, 20)


def test_query_equals_its_sql_on_repeated_ids_and_empty_vectors(spark, tmp_path):
    rows = [(i, [random.Random(i).uniform(-1, 1) for _ in range(3)]) for i in range(30)]
    rows += [(20, [0.5, 0.5, 0.5]), (20, [0.5, 0.5, 0.5]), (7, [0.9, 0.1, 0.0]), (7, [0.9, 0.1, 0.0]), (40, []), (41, []), (60, None), (80, [None, 1.0, 1.0])]
    rows += [(100, [float("nan"), 1.0, 1.0]), (None, [1.0, 1.0, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    frame.write.parquet(str(tmp_path / "embeddings.parquet"))
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{tmp_path}/embeddings.parquet/*.parquet' where vec_id is not null")
    wanted = sorted(con.execute(f"select query_id, rank, vec_id, score from ({OP3})").fetchall())
    found = op3_exact_topk(spark, str(tmp_path)).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(tuple(r) for r in found) == wanted


def test_scores_beyond_doubles(spark):
    rows = [(1, [2**30, 1], True), (2, [2**30, 3], False), (3, [2**30, 2], True), (4, [2**30, 2], False)]
    assert run(spark, rows, 2) == brute(rows, 2)


def test_no_rows_and_no_queries(spark):
    assert run(spark, [], 5) == []
    assert run(spark, [(1, [1], False), (2, [2], None)], 5) == []
    assert run(spark, [(1, [1], True)], 5) == []
