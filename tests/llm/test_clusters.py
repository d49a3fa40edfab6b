import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from linecheck.llm import clusters

SCHEMA = "vec_id long, embedding array<float>, label int"


def restated(rows, k, rounds):
    """Every vector's row by plain whole numbers."""
    kept = [
        (i, [math.floor(256 * float(np.float32(x))) for x in v])
        for i, v, *_ in rows
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)
    ]
    def first(row):
        return hashlib.sha256(f"2:{row[0]}".encode()).hexdigest() if row[0] is not None else "~"
    start = sorted(kept, key=lambda r: (first(r), -1 if r[0] is None else r[0], r[1]))
    centroids = [list(v) for _, v in start[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), i) for i, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for c, members in groups.items():
            centroids[c] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    found = [(i, *nearest(v)) for i, v in kept]
    total = sum(q for _, q, _ in found)
    own = {}
    for _, q, c in found:
        own[c] = own.get(c, 0) + q
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((-1 if i is None else i), c, q, own[c], total, names[c]) for i, q, c in found)


def found_rows(spark, rows, k, rounds, scale=256):
    table = spark.createDataFrame(rows, SCHEMA).withColumn("cluster", F.lit("x")).withColumn("planes", F.lit("x"))
    first = F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")), 256)
    found = clusters.clustered(clusters.whole_vectors(table, scale), k, rounds, first).collect()
    return sorted(tuple(-1 if x is None else x for x in r) for r in found)


def vectors(seed, n, scale=1.0):
    rnd = random.Random(seed)
    return [(i, [rnd.gauss(0, scale) for _ in range(64)], i % 3) for i in range(n)]


@pytest.mark.parametrize("seed, n, k", [(1, 60, 7), (2, 200, 40), (3, 12, 40), (4, 1, 3)])
def test_random_vectors(spark, seed, n, k):
    rows = vectors(seed, n, 0.3 if seed % 2 else 30.0)
    assert found_rows(spark, rows, k, 5) == restated(rows, k, 5)


def test_ties_repeats_and_missing_values(spark):
    rows = vectors(5, 20)
    zero, one = [0.0] * 64, [1.0] + [0.0] * 63
    rows += [rows[3], rows[3], (3, one, 0), (None, zero, 0), (None, zero, None), (50, zero, 0), (51, one, 0)]
    rows += [(60, None, 0), (61, [], 0), (62, [1.0] * 63, 0), (63, [1.0] * 65, 0), (64, [None] + [0.0] * 63, 0)]
    rows += [(65, [float("nan")] + [0.0] * 63, 0), (66, [float("-inf")] + [0.0] * 63, 0)]
    found = found_rows(spark, rows, 6, 5)
    assert found == restated(rows, 6, 5)
    assert len(found) == 27


def test_equal_vectors_leave_centroids_empty(spark):
    rows = [(i, [0.5] * 64, 0) for i in range(30)]
    found = found_rows(spark, rows, 5, 5)
    assert found == restated(rows, 5, 5)
    assert {r[1] for r in found} == {0}


def test_products_of_planes():
    rnd = np.random.RandomState(3)
    for most in (1, 2, 300, clusters.MOST):
        a = rnd.randint(-most, most, (50, 64), dtype=np.int64)
        b = rnd.randint(-most, most, (9, 64), dtype=np.int64)
        planes = int(max(np.max(np.maximum(x, -1 - x)) for x in (a, b))).bit_length() + 1
        pa, pb = clusters.packed(a, planes), clusters.packed(b, planes)
        assert (clusters.unpacked(pa) == a).all()
        assert (clusters.products(pa, pb) == a @ b.T).all()
        assert (clusters.squares(pa) == (a * a).sum(1)).all()
        cluster, distance = clusters.nearest(pa, pb)
        apart = ((a[:, None] - b[None]) ** 2).sum(2)
        assert (cluster == apart.argmin(1)).all() and (distance == apart.min(1)).all()


def test_no_rows(spark):
    assert found_rows(spark, [], 4, 2) == []
    assert found_rows(spark, [(1, None, 0)], 4, 2) == []


def test_components_that_do_not_fit(spark):
    with pytest.raises(ValueError, match="64 bits"):
        found_rows(spark, [(1, [1e30] * 64, 0)], 4, 2)


def test_a_round_starts_no_job_for_every_partition(spark):
    rows = clusters.whole_vectors(spark.createDataFrame(vectors(6, 50), SCHEMA), 256)
    context = spark.sparkContext
    context.setJobGroup("clusters", "rounds")
    settings = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        clusters.clustered(rows, 4, 5, F.col("vec_id").cast("string"))
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
        context.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < len(context.statusTracker().getJobIdsForGroup("clusters")) < 40
