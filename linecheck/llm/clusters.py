"""Centroid clustering of vectors of 64 whole numbers by the bits of their components.

Bit i of all 64 components makes one 64-bit number, the vector's plane i; the highest plane
is the sign and counts negative. An inner product is the weighted sum of the set bits that two
planes have in common, over all pairs of planes, so distances are exact whole numbers. Planes
are stored once; every round sends the centroids to the tasks and adds up sums per task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linecheck.llm.common import stored

# Fixed value: components of a vector, one for each bit of a plane.
DIMS = 64

# Vectors whose distances are computed at once within a task.
ROWS = 4096

# Squared distances of components below this fit 64 bits.
MOST = 1 << 27

_BITS = np.arange(DIMS, dtype=np.uint64)


def weights(planes: int) -> list[int]:
    """What a set bit of each plane counts; the last is the sign."""
    return [1 << i for i in range(planes - 1)] + [-(1 << (planes - 1))]


def packed(vectors: np.ndarray, planes: int) -> np.ndarray:
    """Bit planes of the rows of 64 whole numbers, as columns of unsigned 64-bit numbers."""
    out = np.empty((len(vectors), planes), np.uint64)
    for i in range(planes):
        bits = (vectors >> i & 1).astype(np.uint64)
        out[:, i] = np.bitwise_or.reduce(bits << _BITS, axis=1)
    return out


def unpacked(planes: np.ndarray) -> np.ndarray:
    """The whole numbers behind bit planes."""
    out = np.zeros((len(planes), DIMS), np.int64)
    for i, weight in enumerate(weights(planes.shape[1])):
        out += (planes[:, i, None] >> _BITS & np.uint64(1)).astype(np.int64) * weight
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all vectors behind planes ``a`` with all behind ``b``."""
    out = np.zeros((len(a), len(b)), np.int64)
    outer, inner = weights(a.shape[1]), weights(b.shape[1])
    for i, weight in enumerate(outer):
        part = np.zeros_like(out)
        for j, other in enumerate(inner):
            part += np.bitwise_count(a[:, i, None] & b[None, :, j]).astype(np.int64) * other
        out += part * weight
    return out


def squares(planes: np.ndarray) -> np.ndarray:
    """The squared length of every vector behind planes."""
    out = np.zeros(len(planes), np.int64)
    weight = weights(planes.shape[1])
    for i, a in enumerate(weight):
        for j, b in enumerate(weight):
            out += np.bitwise_count(planes[:, i] & planes[:, j]).astype(np.int64) * (a * b)
    return out


def nearest(planes: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per vector the number of its nearest centroid, the smaller of equal ones, and the squared distance."""
    own = squares(centroids)
    cluster, distance = np.empty(len(planes), np.int32), np.empty(len(planes), np.int64)
    for i in range(0, len(planes), ROWS):
        part = slice(i, i + ROWS)
        rest = own[None, :] - 2 * products(planes[part], centroids)
        cluster[part] = rest.argmin(1)
        distance[part] = squares(planes[part]) + rest.min(1)
    return cluster, distance


def _opened(column: pa.Array, planes: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u8").reshape(-1, planes)


def _planes(rows: DataFrame, planes: int) -> DataFrame:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                flat = pa.array(batch.column(1)).flatten().to_numpy(zero_copy_only=False)
                made = packed(flat.reshape(-1, DIMS).astype(np.int64), planes)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([row.tobytes() for row in made], pa.binary())], ["vec_id", "planes"]
                )

    return rows.select("vec_id", "vector").mapInArrow(pack, "vec_id long, planes binary")


def _sums(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Per cluster the number of its vectors and the sums of their components."""
    planes = centroids.shape[1]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, counts = np.zeros((len(centroids), DIMS), np.int64), np.zeros(len(centroids), np.int64)
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                data = _opened(batch.column(0)[i : i + ROWS], planes)
                cluster, _ = nearest(data, centroids)
                order = np.argsort(cluster, kind="stable")
                found, first = np.unique(cluster[order], return_index=True)
                totals[found] += np.add.reduceat(unpacked(data)[order], first, axis=0)
                counts += np.bincount(cluster, minlength=len(centroids))
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict(
            {
                "cluster": pa.array(used.astype(np.int32)),
                "n": pa.array(counts[used]),
                "sums": pa.array(list(totals[used]), pa.list_(pa.int64())),
            }
        )

    parts = rows.select("planes").mapInArrow(add, "cluster int, n long, sums array<long>")
    # Sums of all parts could leave 64 bits where one part's do not.
    sums = [F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(DIMS)]
    return parts.groupBy("cluster").agg(F.sum("n").alias("n"), *sums)


def whole_vectors(rows: DataFrame, scale: int, vector: str = "embedding") -> DataFrame:
    """Rows ``vec_id``, ``vector`` of those with 64 finite components x, each as floor(scale * x).

    Vectors that are missing, of another length, or hold a missing or non-finite component
    are left out.
    """
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # The tests of a missing vector are missing, too, and do not hold.
    good = rows.where((F.size(vector) == DIMS) & finite)
    floor = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    return good.select("vec_id", floor.alias("vector"))


def clustered(rows: DataFrame, k: int, rounds: int, first: Column) -> DataFrame:
    """Every vector's cluster after ``rounds`` rounds from ``k`` starting centroids.

    ``rows`` has ``vec_id`` and ``vector`` (64 whole numbers). Centroids 0, 1, ... start as the
    vectors with the smallest ``first``; ties go to the smaller ``vec_id``, then vector. A round
    gives every vector to the nearest centroid (ties: the smaller number) and moves every
    centroid with vectors to the floor of their componentwise mean; the others stay. Returns
    ``vec_id``, ``cluster``, ``distance`` (squared), ``cluster_inertia``, ``inertia`` and
    ``centroid_sha256``.

    Repeated rows and ids are vectors of their own. Rows whose ``first`` is missing (no id) are
    clustered, but start as centroids only if there are too few others. Fewer than ``k`` rows
    are all centroids; no rows give no rows. Other columns are not looked at. Components of
    2**27 or more are an error, as their squared distances do not fit 64 bits.
    """
    rows = rows.select("vec_id", "vector", first.alias("first"))
    most = rows.agg(F.max(F.array_max(F.transform("vector", lambda x: F.greatest(x, -1 - x))))).first()[0]
    if most is None:
        schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        return rows.sparkSession.createDataFrame([], schema)
    if most >= MOST:
        raise ValueError(f"a component of {most} or {-1 - most}: squared distances may not fit 64 bits")
    planes = int(most).bit_length() + 1
    data = stored(_planes(rows, planes), "clusters-planes")

    order = (F.col("first").asc_nulls_last(), F.col("vec_id"), F.col("vector"))
    start = rows.orderBy(*order).limit(k).collect()
    centroids = np.array([row.vector for row in start], np.int64)
    for _ in range(rounds):
        # At most k rows, in one job; an iterator would start one for every partition of the shuffle.
        for row in _sums(data, packed(centroids, planes)).collect():
            centroids[row.cluster] = [int(row[f"s{i}"]) // row.n for i in range(DIMS)]
    last = packed(centroids, planes)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                part = batch.slice(i, ROWS)
                cluster, distance = nearest(_opened(part.column(1), planes), last)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(cluster), pa.array(distance)], ["vec_id", "cluster", "distance"])

    found = stored(data.mapInArrow(assign, "vec_id long, cluster int, distance long"), "clusters-assigned")
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    inertia = {row.cluster: row.inertia for row in found.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    total = sum(inertia.values())
    # One row per centroid.
    facts = [(c, inertia[c], total, names[c]) for c in sorted(inertia)]
    facts = found.sparkSession.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    joined = found.join(F.broadcast(facts), "cluster")
    return joined.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
