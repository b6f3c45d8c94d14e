"""Exact top-k search by inner product with multi-resolution segment statistics.

Vectors are cut into a few segments, each described by its mean and its deviation. With segments of length L, the squared
distance of two vectors is at least the sum of L ((mean - mean')^2 + (deviation - deviation')^2), hence their inner product at
most the sum of L (mean mean' + deviation deviation'). The bound is taken with few segments first and more for what is left;
pairs that no bound tells apart from a query's best so far are computed exactly.

Candidates are packed into blocks where they are read; query blocks are copied to every group of candidate blocks, and each
task works through pairs of blocks, keeping each query's k-th best score as the bar for what follows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.session import cut_lineage

#: Vectors in a block, blocks that share one copy of the queries, and numbers of segments from coarse to fine.
BLOCK_VECTORS = 512
GROUP_BLOCKS = 8
LEVELS = (1, 4, 16)
QUERY_EVERY = 100
SCALE = 1024
K = 10

BLOCK = "dim int, uids binary, ids binary, data binary"


def packed(vectors: DataFrame, scale: int = SCALE, size: int = BLOCK_VECTORS) -> DataFrame:
    """Blocks of vectors of one length, components as floor(scale * x) in 64-bit integers.

    uid names a row, also among rows with equal ids. Rows without an id, without a vector, or with a component that is null or
    not finite are left out. A component too large for 62 bits is an error.
    """

    def pack(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[tuple[int, int, np.ndarray]]] = {}
        uid = TaskContext.get().partitionId() << 40

        def block(dim: int) -> pa.RecordBatch:
            uids, ids, data = zip(*waiting.pop(dim), strict=True)
            row = {"dim": dim, "uids": np.array(uids, "<i8").tobytes(), "ids": np.array(ids, "<i8").tobytes(), "data": np.array(data, "<i8").tobytes()}
            return pa.RecordBatch.from_pylist([row], BLOCK_SCHEMA)

        for batch in rows:
            for vec_id, vector in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                uid += 1
                if vec_id is None or not vector.is_valid or vector.values.null_count:
                    continue
                x = np.floor(scale * vector.values.to_numpy(zero_copy_only=False).astype(np.float64))
                if not np.isfinite(x).all():
                    continue
                if len(x) and np.abs(x).max() >= 2.0**62:
                    raise OverflowError(f"a component of vector {vec_id} is too large")
                waiting.setdefault(len(x), []).append((uid, vec_id, x.astype(np.int64)))
                if len(waiting[len(x)]) == size:
                    yield block(len(x))
        for dim in list(waiting):
            yield block(dim)

    return vectors.select(F.col("vec_id").cast("bigint"), "embedding").mapInArrow(pack, BLOCK)


BLOCK_SCHEMA = pa.schema([("dim", pa.int32()), ("uids", pa.binary()), ("ids", pa.binary()), ("data", pa.binary())])


def queries_of(blocks: DataFrame, every: int) -> DataFrame:
    """Blocks cut down to vectors whose id is divisible by every; blocks without any are left out."""

    def pick(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], "<i8")
                chosen = ids % every == 0
                if chosen.any():
                    data = np.frombuffer(row["data"], "<i8").reshape(len(ids), -1)
                    picked = {"dim": row["dim"], "uids": np.frombuffer(row["uids"], "<i8")[chosen].tobytes(), "ids": ids[chosen].tobytes(), "data": data[chosen].tobytes()}
                    yield pa.RecordBatch.from_pylist([picked], BLOCK_SCHEMA)

    return blocks.mapInArrow(pick, BLOCK)


def statistics(vectors: np.ndarray, levels: tuple[int, ...] = LEVELS) -> list[np.ndarray]:
    """For each level, rows of segment means and deviations times the root of the segment's length: a product of two such rows
    bounds the product of the vectors."""
    x = vectors.astype(np.float64)
    found = []
    for n in levels:
        cuts = np.linspace(0, x.shape[1], min(n, x.shape[1]) + 1).astype(int)
        parts = [x[:, a:b] for a, b in zip(cuts, cuts[1:], strict=False) if b > a]
        root = [np.sqrt(p.shape[1]) for p in parts]
        found.append(np.column_stack([p.mean(axis=1) * r for p, r in zip(parts, root, strict=True)] + [p.std(axis=1) * r for p, r in zip(parts, root, strict=True)]) if parts else np.zeros((len(x), 1)))
    return found


def exact(queries: np.ndarray, vectors: np.ndarray, q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products of the pairs (q, v), in integers."""
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * max(1, queries.shape[1])
    if most < 2.0**52:  # every sum is exact as a double
        if 4 * len(q) > len(queries) * len(vectors):
            return (queries.astype(np.float64) @ vectors.astype(np.float64).T)[q, v].astype(np.int64)
        return np.einsum("ij,ij->i", queries[q].astype(np.float64), vectors[v].astype(np.float64)).astype(np.int64)
    sums = (queries[q].astype(object) * vectors[v].astype(object)).sum(axis=1) if queries.shape[1] else np.zeros(len(q), object)
    if any(abs(s) >= 2**63 for s in sums):
        raise OverflowError("a score is too large")
    return sums.astype(np.int64)


def survivors(queries: list[np.ndarray], vectors: list[np.ndarray], bar: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs whose bound reaches the query's bar at every level; queries, vectors: their statistics by level."""
    norm = np.sqrt((queries[-1] ** 2).sum(axis=1)), np.sqrt((vectors[-1] ** 2).sum(axis=1))
    slack = 1e-9 * norm[0][:, None] * norm[1][None, :] + 1e-6  # more than rounding can take from a bound
    q, v = np.nonzero(queries[0] @ vectors[0].T + slack >= bar[:, None])
    for left, right in zip(queries[1:], vectors[1:], strict=True):
        if 4 * len(q) > len(bar) * len(norm[1]):
            bound = (left @ right.T)[q, v]
        else:
            bound = np.einsum("ij,ij->i", left[q], right[v])
        near = bound + slack[q, v] >= bar[q]
        q, v = q[near], v[near]
    return q, v


def search_cells(cells: DataFrame, k: int) -> DataFrame:
    """query (its uid), query_id, vec_id, score: of each pair of blocks, the best k candidates of each query that reach its bar."""

    def search(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bars: dict[int, int] = {}  # each query's k-th best score among the candidates of one earlier block, or better
        last: tuple[bytes, tuple] | None = None
        for batch in rows:
            for i in range(batch.num_rows):
                dim, quids, qids, qdata, uids, ids, data = (c[i].as_py() for c in batch.columns)
                if last is None or last[0] != uids:
                    v = np.frombuffer(data, "<i8").reshape(len(uids) // 8, dim)
                    last = uids, (np.frombuffer(uids, "<i8"), np.frombuffer(ids, "<i8"), v, statistics(v))
                own, names, vectors, stats = last[1]
                quid, qid = np.frombuffer(quids, "<i8"), np.frombuffer(qids, "<i8")
                queries = np.frombuffer(qdata, "<i8").reshape(len(quid), dim)
                bar = np.array([bars.get(x, -np.inf) for x in quid.tolist()])
                q, c = survivors(statistics(queries), stats, bar)
                other = own[c] != quid[q]
                q, c = q[other], c[other]
                score = exact(queries, vectors, q, c)
                good = score >= bar[q]
                q, c, score = q[good], c[good], score[good]
                order = np.lexsort((names[c], -score, q))
                q, c, score = q[order], c[order], score[order]
                first = np.searchsorted(q, q)  # where the query's rows begin
                place = np.arange(len(q)) - first
                for x, s in zip(quid[q[place == k - 1]].tolist(), score[place == k - 1].tolist(), strict=True):
                    bars[x] = max(s, bars.get(x, s))
                best = place < k
                q, c, score = q[best], c[best], score[best]
                yield pa.RecordBatch.from_arrays([pa.array(quid[q]), pa.array(qid[q]), pa.array(names[c]), pa.array(score)], ["query", "query_id", "vec_id", "score"])

    return cells.mapInArrow(search, "query bigint, query_id bigint, vec_id bigint, score bigint")


def top_k(vectors: DataFrame, k: int = K, every: int = QUERY_EVERY, scale: int = SCALE) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best candidates of each query, fewer if there are fewer.

    vectors: vec_id, embedding; other columns are left aside. Queries are rows whose vec_id is divisible by every; candidates
    all rows but the query's own; score the inner product of components floor(scale * x). Ties go to the smaller vec_id. Rows
    that share an id are rows of their own, as queries too. Vectors meet only vectors of their own length. Rows without id or
    vector, or with null or non-finite components, take no part.
    """
    blocks = cut_lineage(packed(vectors, scale), "vector-blocks")
    groups = max(1, -(-blocks.count() // GROUP_BLOCKS))
    grouped = blocks.withColumn("group", F.pmod(F.xxhash64("uids"), F.lit(groups)))
    asked = queries_of(blocks, every).select("dim", *(F.col(c).alias(f"q{c}") for c in ("uids", "ids", "data")))
    copies = asked.withColumn("group", F.explode(F.expr(f"sequence(0L, {groups - 1}L)")))
    cells = grouped.join(copies, ["dim", "group"]).select("dim", "quids", "qids", "qdata", "uids", "ids", "data")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    ranked = search_cells(cells, k).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
