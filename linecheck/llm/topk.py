"""Exact top-k by inner product of integer vectors.

Vectors are dealt by descending length into blocks. A rotation by the singular vectors of
all vectors moves most of their length into the first components: the sum over those, plus
the product of the remaining lengths (Cauchy-Schwarz), bounds a score from above. A query's
k-th score among the longest vectors is a threshold; blocks, then vectors, then partial sums
that cannot reach it are left out, and what is left is scored exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linecheck.llm.common import stored

# Vectors per block, and queries per block. A task holds one of each.
BLOCK = 4096
QUERIES = 1024

# Queries scored at once within a task, and the share of components in partial sums.
ROWS = 256
PARTIAL = 0.25

# Doubles hold integers exactly up to here; scores beyond are computed with long integers.
EXACT = 2**53


def _packed(rows: DataFrame, dims: int, kind: str, size: int) -> DataFrame:
    """Rows of (``id``, ``vector``), in their order, as blocks of bytes with the largest length in each."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = 0

        def block(ids: list[int], vectors: list[np.ndarray]) -> pa.RecordBatch:
            nonlocal made
            whole = np.stack(vectors)
            made += 1
            return pa.RecordBatch.from_pydict(
                {
                    "block": pa.array([(TaskContext.get().partitionId() << 32) + made], pa.int64()),
                    "top": pa.array([float(np.sqrt((whole.astype(np.float64) ** 2).sum(1).max()))]),
                    "ids": pa.array([np.array(ids, "<i8").tobytes()]),
                    "data": pa.array([whole.astype(kind).tobytes()]),
                }
            )

        ids: list[int] = []
        vectors: list[np.ndarray] = []
        for batch in batches:
            for name, vector in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                padded = np.zeros(dims, np.int64)
                values = vector.values.to_numpy(zero_copy_only=False)
                padded[: len(values)] = values
                ids.append(name)
                vectors.append(padded)
                if len(ids) == size:
                    yield block(ids, vectors)
                    ids, vectors = [], []
        if ids:
            yield block(ids, vectors)

    return rows.mapInArrow(pack, "block long, top double, ids binary, data binary")


def _opened(ids: bytes, data: bytes, dims: int, kind: str) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(ids, "<i8"), np.frombuffer(data, kind).reshape(-1, dims).astype(np.float64)


def _rotation(blocks: DataFrame, dims: int, kind: str) -> np.ndarray:
    """Right singular vectors of all vectors, as columns, largest first; from sums of squares of fixed size."""

    def squares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            for data in batch.column(0):
                _, block = _opened(b"", data.as_py(), dims, kind)
                total += block.T @ block
        for i in range(dims):
            yield pa.RecordBatch.from_pydict({"row": pa.array([i], pa.int32()), "sums": pa.array([total[i].tobytes()])})

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, sums in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                total[i] = total.get(i, 0) + np.frombuffer(sums.as_py())
        for i, sums in total.items():
            yield pa.RecordBatch.from_pydict({"row": pa.array([i], pa.int32()), "sums": pa.array([sums.tobytes()])})

    schema = "row int, sums binary"
    rows = blocks.select("data").mapInArrow(squares, schema).repartition("row").mapInArrow(added, schema)
    gram = np.zeros((dims, dims))
    for row in rows.toLocalIterator():
        gram[row.row] = np.frombuffer(row.sums)
    _, vectors = np.linalg.eigh(gram)
    return vectors[:, ::-1]


def exact_scores(a: np.ndarray, b: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products of all rows of ``a`` with all of ``b``."""
    if exact:
        return a @ b.T
    return a.astype(np.int64).astype(object) @ b.astype(np.int64).astype(object).T


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= least)
        return some[np.lexsort((ids[some], -scores[some]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def thresholds(ids: np.ndarray, queries: np.ndarray, head_ids: np.ndarray, head: np.ndarray, k: int, exact: bool) -> np.ndarray:
    """Per query its k-th highest score among ``head``, without itself; minus infinity if there are fewer."""
    least = np.full(len(ids), -np.inf)
    for i in range(0, len(ids), ROWS):
        scores = exact_scores(queries[i : i + ROWS], head, exact).astype(np.float64)
        scores[ids[i : i + ROWS, None] == head_ids[None, :]] = -np.inf
        if len(head_ids) >= k:
            least[i : i + ROWS] = np.partition(scores, len(head_ids) - k, axis=1)[:, len(head_ids) - k]
    return least if exact else np.where(np.isfinite(least), least - np.abs(least) * 1e-12, least)


def pruned(
    ids: np.ndarray,
    queries: np.ndarray,
    least: np.ndarray,
    names: np.ndarray,
    block: np.ndarray,
    rotation: np.ndarray,
    k: int,
    exact: bool,
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per query with any: its id, and ids and scores of its best k in the block that reach its threshold.

    The block's vectors are in descending order of length.
    """
    h = max(1, int(rotation.shape[1] * PARTIAL))
    q, c = queries @ rotation, block @ rotation
    q_long, c_long = np.sqrt((queries**2).sum(1)), np.sqrt((block**2).sum(1))
    q_rest, c_rest = np.sqrt((q[:, h:] ** 2).sum(1)), np.sqrt((c[:, h:] ** 2).sum(1))
    slack = 1e-9 * (1 + q_long.max(initial=0) * c_long.max(initial=0))
    for i in range(0, len(ids), ROWS):
        own = slice(i, min(i + ROWS, len(ids)))
        reach = np.searchsorted(-c_long, -(least[own] - slack) / np.maximum(q_long[own], 1e-300), "right")
        reach = np.where(least[own] <= slack, len(names), reach)
        width = int(reach.max(initial=0))
        if not width:
            continue
        bound = q[own, :h] @ c[:width, :h].T + q_rest[own, None] * c_rest[None, :width]
        alive = (bound >= least[own, None] - slack) & (np.arange(width) < reach[:, None])
        alive &= ids[own, None] != names[None, :width]
        if 10 * alive.sum() > alive.size or not exact:
            scores = exact_scores(queries[own], block[:width], exact)
            for j, row in enumerate(alive):
                at = np.flatnonzero(row)
                yield from _chosen(ids[i + j], names[at], scores[j, at], least[i + j], k)
        else:
            which, at = np.nonzero(alive)
            scores = np.einsum("ij,ij->i", queries[own][which], block[at])
            ends = np.searchsorted(which, np.arange(len(alive) + 1))
            for j in range(len(alive)):
                part = slice(ends[j], ends[j + 1])
                yield from _chosen(ids[i + j], names[at[part]], scores[part], least[i + j], k)


def _chosen(query: int, names: np.ndarray, scores: np.ndarray, least: float, k: int) -> Iterator:
    enough = scores >= least
    if enough.any():
        names, scores = names[enough], scores[enough]
        at = best(scores, names, k)
        yield int(query), names[at], scores[at]


def top_k(vectors: DataFrame, is_query: str, k: int, key: str = "id", vector: str = "vector") -> DataFrame:
    """Rows ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: each query's k highest inner products.

    ``vectors`` has an id, an array of whole numbers and a boolean column that marks queries;
    every row is a candidate, for all queries but itself. Ties go to the smaller id. Fewer
    than k other rows: all of them. Rows without id or vector, or with a missing component,
    take no part. Rows that repeat an id are candidates of their own for all queries of other
    ids; queries that repeat an id share one result, the best of all of them. A shorter vector
    counts as padded with zeros, and an empty one scores 0. A missing mark is no query. No rows
    or no queries give no rows. Scores have to fit 64 bits.
    """
    good = F.col(key).isNotNull() & F.col(vector).isNotNull() & ~F.exists(F.coalesce(F.col(vector), F.array().cast("array<long>")), lambda x: x.isNull())
    rows = vectors.where(good).select(
        F.col(key).cast("long").alias("id"),
        F.col(vector).cast("array<long>").alias("vector"),
        F.coalesce(F.col(is_query), F.lit(False)).alias("asks"),
    )
    square = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    rows = stored(rows.withColumn("square", square), "topk-vectors")
    facts = rows.agg(
        F.count("*").alias("n"),
        F.max(F.size("vector")).alias("dims"),
        F.max("square").alias("square"),
        F.max(F.array_max(F.transform("vector", lambda x: F.greatest(x, -1 - x)))).alias("most"),
    ).first()
    schema = "query_id long, vec_id long, score long"
    if not facts.n:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    dims = max(1, facts.dims)
    most = facts.most or 0
    kind = next((t for t, bits in (("<i2", 15), ("<i4", 31)) if most < 1 << bits), "<i8")
    exact = facts.square < EXACT

    count = max(1, -(-facts.n // BLOCK))
    dealt = rows.repartitionByRange(count, F.desc("square"), "id").sortWithinPartitions(F.desc("square"), "id")
    blocks = stored(_packed(dealt.select("id", "vector"), dims, kind, BLOCK), "topk-blocks")
    asking = rows.where("asks").select("id", "vector")
    rotation = _rotation(blocks, dims, kind)
    longest = blocks.orderBy(F.desc("top"), "block").limit(1).first()
    sent = vectors.sparkSession.sparkContext.broadcast((bytes(longest.ids), bytes(longest.data), rotation))

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head_ids, head = _opened(*sent.value[:2], dims, kind)
        for batch in batches:
            for i in range(batch.num_rows):
                ids, queries = _opened(batch.column(2)[i].as_py(), batch.column(3)[i].as_py(), dims, kind)
                least = thresholds(ids, queries, head_ids, head, k, exact)
                row = batch.slice(i, 1)
                low = pa.array([float(least.min())])
                yield pa.RecordBatch.from_arrays(
                    [*row.columns, pa.array([least.tobytes()]), low], ["asks", "q_top", "q_ids", "q_data", "q_least", "low"]
                )

    packed = _packed(asking.repartition(F.pmod(F.hash("id"), F.lit(max(1, count)))), dims, kind, QUERIES)
    asked = packed.mapInArrow(judged, "asks long, q_top double, q_ids binary, q_data binary, q_least binary, low double")
    asked = stored(asked, "topk-queries")

    # Blocks of queries meet blocks of vectors by numbers: every block of vectors has one of
    # a few, and blocks of queries go to each.
    lanes = max(1, count // 4)
    left = asked.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))
    right = blocks.withColumn("lane", F.pmod(F.hash("block"), F.lit(lanes)))
    pairs = left.join(right, "lane").where("low <= 0 or q_top * top * (1 + 1e-9D) + 1e-6D >= low")

    def scored(table: pa.Table) -> pa.Table:
        q_ids, v_ids, totals = [], [], []
        rotation = sent.value[2]
        for i in range(table.num_rows):
            value = {c: table.column(c)[i].as_py() for c in ("q_ids", "q_data", "q_least", "ids", "data")}
            ids, queries = _opened(value["q_ids"], value["q_data"], dims, kind)
            names, block = _opened(value["ids"], value["data"], dims, kind)
            found = pruned(ids, queries, np.frombuffer(value["q_least"]), names, block, rotation, k, exact)
            for query, vecs, scores in found:
                q_ids.append(np.full(len(vecs), query))
                v_ids.append(vecs)
                totals.append(np.array([int(s) for s in scores], np.int64))
        arrays = [pa.array(np.concatenate(x) if x else [], pa.int64()) for x in (q_ids, v_ids, totals)]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), arrays, strict=True)))

    found = pairs.groupBy("asks", "block").applyInArrow(scored, schema)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
