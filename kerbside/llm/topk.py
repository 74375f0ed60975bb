"""Exact top-k by inner product over norm-sorted, SVD-rotated vectors.

Components become integers, floor(scale * x). Queries and vectors are dealt into blocks by a hash of their ids and every
query block meets every vector block once, in a group of bounded size. Inside such a group vectors are processed by
descending length. A query is finished once |q| |v| can't reach its k-th score any more (Cauchy-Schwarz). Before that,
the first rotated coordinates give a partial sum and the lengths of what is left bound the rest; only pairs whose bound
reaches the k-th score are computed exactly, in integers. The rotation is that of the right singular vectors, from the
Gram matrix that the cluster sums up; it only orders coordinates by energy and never touches a score.

Defined results: vectors that are null or empty, or hold null or non-finite components, and rows without an id take no
part. Of several rows with one id the largest vector (compared component by component) stands for it. A query is
compared with vectors of its own dimension; its own id is no candidate. Equal scores: the smaller id comes first. With
fewer than k candidates all are returned. Scores beyond 64 bits are cut to the 64-bit range.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from kerbside.llm.common import ship

BLOCK = 16_384  # queries, or vectors, in a block at most (in the mean of a hash)
PART = 1_024  # queries at a time within a block
STEP = 512  # vectors between two looks at the bounds
LEADING = 0.25  # share of coordinates in the partial sum
_SLACK = 1e-9  # of |q| |v|, far above the rounding of a double sum
_WHOLE = float(1 << 52)  # sums below this are exact in doubles


def integer_vectors(df: DataFrame, id: str, vector: str, scale: int) -> DataFrame:
    """``(id, v)`` with integer components held as doubles, for the rows that take part."""
    values = F.col(f"`{vector}`")
    fine = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    scaled = F.transform(values, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("double"))
    return df.where(values.isNotNull() & (F.size(values) > 0) & fine & F.col(f"`{id}`").isNotNull()).select(
        F.col(f"`{id}`").cast("long").alias("id"), scaled.alias("v")
    )


def _matrix(column) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(flat.flatten()).reshape(len(flat), -1) if len(flat) else np.zeros((0, 0))


def rotations(vectors: DataFrame) -> dict[int, np.ndarray]:
    """For each dimension the right singular vectors of all its vectors, strongest first (dimension squared numbers)."""
    ship(vectors.sparkSession)

    def partial(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            sizes = np.asarray(batch.column(1))
            for d in np.unique(sizes):
                m = _matrix(batch.column(0).filter(pa.array(sizes == d)))
                sums[d] = sums.get(d, 0) + m.T @ m
        rows = [(int(d), i, row.tolist()) for d, m in sums.items() for i, row in enumerate(m)]
        columns = list(zip(*rows)) if rows else [[], [], []]
        kinds = (pa.int32(), pa.int32(), pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["d", "i", "row"])

    def added(group: pa.Table) -> pa.Table:
        return pa.table(
            {"d": group["d"][:1], "i": group["i"][:1], "row": pa.array([_matrix(group["row"]).sum(0).tolist()], pa.list_(pa.float64()))}
        )

    sized = vectors.select("v", F.size("v").alias("d"))
    schema = "d int, i int, row array<double>"
    rows = sized.mapInArrow(partial, schema).groupBy("d", "i").applyInArrow(added, schema).collect()
    grams: dict[int, np.ndarray] = {}
    for r in rows:
        grams.setdefault(r.d, np.zeros((r.d, r.d)))[r.i] = r.row
    return {d: np.linalg.eigh(g / max(np.abs(g).max(), 1.0))[1][:, ::-1].copy() for d, g in grams.items()}


def distinct_ids(ids: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One row for each id, the one with the largest vector."""
    if len(np.unique(ids)) == len(ids):
        return ids, vectors
    order = np.lexsort([*vectors.T[::-1], ids])
    last = np.append(ids[order][1:] != ids[order][:-1], True)
    return ids[order][last], vectors[order][last]


def exact_scores(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products of all rows of q with all rows of v, as 64-bit integers."""
    reach = np.abs(q).max(initial=0.0) * np.abs(v).max(initial=0.0) * q.shape[1]
    if reach < _WHOLE:
        return (q @ v.T).astype(np.int64)
    q, v = ([[int(x) for x in row] for row in m] for m in (q, v))
    cut = lambda s: min(max(s, -(1 << 63)), (1 << 63) - 1)
    return np.array([[cut(sum(map(int.__mul__, x, y))) for y in v] for x in q], np.int64)


def block_top_k(qid, q, vid, v, rotation, k: int):
    """The k best scores and ids of one block of vectors for each query of a block, PART queries at a time."""
    length = lambda m: np.sqrt(np.einsum("ij,ij->i", m, m))
    order = np.argsort(-length(v), kind="stable")
    vid, v = vid[order], v[order]
    lead = max(1, int(q.shape[1] * LEADING))
    vr = v @ rotation
    v_all, v_rest, vr = length(v), length(vr[:, lead:]), vr[:, :lead].copy()
    best = []
    for at in range(0, len(q), PART):
        best += _part_top_k(qid[at : at + PART], q[at : at + PART], rotation, lead, vid, v, v_all, vr, v_rest, k)
    return best


def _part_top_k(qid, q, rotation, lead, vid, v, v_all, vr, v_rest, k):
    qr = q @ rotation
    q_all, q_rest, qr = np.sqrt((q * q).sum(1)), np.sqrt((qr[:, lead:] ** 2).sum(1)), qr[:, :lead]
    best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in range(len(q))]  # scores, ids
    least = np.full(len(q), -np.inf)
    for at in range(0, len(v), STEP):
        part = slice(at, at + STEP)
        slack = _SLACK * q_all * v_all[at] + 1e-6
        active = np.flatnonzero(q_all * v_all[at] + slack >= least)
        if not len(active):
            break
        bound = qr[active] @ vr[part].T + np.outer(q_rest[active], v_rest[part]) + slack[active, None]
        may = (bound >= least[active, None]) & (qid[active, None] != vid[None, part])
        rows, columns = np.flatnonzero(may.any(1)), np.flatnonzero(may.any(0))
        if not len(rows):
            continue
        scores = exact_scores(q[active[rows]], v[at + columns])
        ids = vid[at + columns]
        for r, row in zip(rows, scores):
            i, use = active[r], may[r, columns]
            use &= row >= least[i]
            s, t = np.append(best[i][0], row[use]), np.append(best[i][1], ids[use])
            top = np.lexsort((t, -s))[:k]
            best[i] = (s[top], t[top])
            if len(top) == k:
                least[i] = s[top[-1]]
    return best


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int, id: str = "vec_id", vector: str = "embedding", scale: int = 256, block: int = BLOCK
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``queries`` its k best rows of ``vectors``."""
    spark = vectors.sparkSession
    all_vectors = integer_vectors(vectors, id, vector, scale)
    asked = integer_vectors(queries, id, vector, scale).groupBy("id").agg(F.max("v").alias("v"))
    rotation = rotations(all_vectors)
    n, m = all_vectors.count(), asked.count()
    shards = max(-(-n // block), min(spark.sparkContext.defaultParallelism, -(-n // 2048)), 1)
    blocks = max(-(-m // block), 1)
    number = lambda parts: F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    left = all_vectors.select("id", "v", F.size("v").alias("d"), number(shards).alias("shard"), every(blocks).alias("block"))
    right = asked.select("id", "v", F.size("v").alias("d"), number(blocks).alias("block"), every(shards).alias("shard"))

    def search(own: pa.Table, others: pa.Table) -> pa.Table:
        rows = [[], [], []]
        if own.num_rows and others.num_rows:
            v_ids, v = distinct_ids(np.asarray(own["id"]), _matrix(own["v"]))
            q_ids, q = np.asarray(others["id"]), _matrix(others["v"])
            for i, (scores, ids) in zip(q_ids, block_top_k(q_ids, q, v_ids, v, rotation[q.shape[1]], k)):
                rows[0] += [i] * len(ids)
                rows[1] += ids.tolist()
                rows[2] += scores.tolist()
        names = ["query_id", "vec_id", "score"]
        return pa.table([pa.array(c, pa.int64()) for c in rows], names=names)

    keys = ["d", "block", "shard"]
    found = left.groupBy(keys).cogroup(right.groupBy(keys)).applyInArrow(search, "query_id long, vec_id long, score long")
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
