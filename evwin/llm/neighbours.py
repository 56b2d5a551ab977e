"""Nearest neighbours by inner product, with a vantage-point tree in every shard.

Rows are dealt to shards by a hash of id and vector; each shard meets the queries in blocks.
One more component, sqrt(M**2 - |x|**2) with the shard's largest norm M, turns the
largest inner product into the smallest distance.  A tree node holds a vantage point and
the median distance to it; a query leaves out the far side if ``factor`` times its
distance to the border exceeds the distance of its k-th best so far.  Factor 1, which the
query uses, is the triangle inequality, hence exact search whatever the norms; a larger
one prunes more, but loses nearly all once norms differ: queries have 0 as the added
component, so all are some M away from every point, while the points stand close together.
The best are kept by inner product, and borders get the slack that the rounding of
distances needs at that M.  Equal vectors of a shard are one point of the tree.  The k best of each shard are scored again in double
precision on the original vectors, pair by pair, and merged.

Vectors null, empty, zero, or holding null or non-finite components, and rows without id
take no part; vectors are compared with those of the same length only; rows that share
a query's id are the query's own; ties go to the smaller id.  Rows alike in id and vector
travel once and are found as often as they stand; as a query they ask once.  Empty table: empty result.  Extra columns, of any name,
are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evwin.session import materialize

K = 20
QUERY_STEP = 20
#: 1: exact.  The README has recall and work at other factors.
FACTOR = 1.0
SHARD_ROWS = 8192
BLOCK_QUERIES = 4096
LEAF = 64


def _usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """vec_id, dim, v (float64 as bytes) of the vectors that take part."""

    def run(batches):
        for batch in batches:
            lists = batch.column("e")
            flat = lists.flatten().cast(pa.float64())
            values = flat.to_numpy(zero_copy_only=False)  # null: nan
            size = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            end = np.cumsum(size)
            ids, raw, dims = batch.column("vec_id").to_pylist(), [], []
            keep = []
            for i, (a, b) in enumerate(zip((end - size).tolist(), end.tolist())):
                v = values[a:b]
                if ids[i] is not None and b > a and np.isfinite(v).all() and v.any():
                    keep.append(ids[i])
                    raw.append(v.tobytes())
                    dims.append(b - a)
            yield pa.RecordBatch.from_arrays([pa.array(keep, pa.int64()), pa.array(dims, pa.int32()), pa.array(raw, pa.binary())], names=["vec_id", "dim", "v"])

    return vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("e")).mapInArrow(run, "vec_id long, dim int, v binary")


class Tree:
    """Vantage-point tree over the rows of ``x``."""

    def __init__(self, x: np.ndarray):
        self.x, self.norm = x, (x * x).sum(axis=1)
        self.nodes: list[tuple] = []
        self.root = self._build(np.arange(len(x)), np.random.default_rng(0))

    def _build(self, rows: np.ndarray, rng) -> int:
        at = len(self.nodes)
        self.nodes.append(())
        if len(rows) <= LEAF:
            self.nodes[at] = (rows,)
            return at
        vantage = rows[rng.integers(len(rows))]
        d = self.distances(self.x[vantage : vantage + 1], rows)[0]
        order = np.argsort(d, kind="stable")
        half = len(rows) // 2
        border = (d[order[half - 1]], d[order[half]])  # largest inside, smallest outside
        self.nodes[at] = (vantage, *border, self._build(rows[order[:half]], rng), self._build(rows[order[half:]], rng))
        return at

    def distances(self, q: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum((q * q).sum(axis=1)[:, None] + self.norm[rows] - 2 * q @ self.x[rows].T, 0))

    def search(self, q: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """Rows and inner products of the k nearest of each query, any order; -1: fewer.
        All rows of the tree are of one length."""
        self.q, self.factor = q, factor
        self.best, self.found = np.full((len(q), k), -np.inf), np.full((len(q), k), -1)
        self.span = (q * q).sum(axis=1) + self.norm.max()
        # squares are off by their size times the rounding of a sum; near 0 the root of that
        self.slack = 4 * np.sqrt(np.finfo(float).eps * (q.shape[1] + 8) * self.span)
        self.compared = 0
        self._visit(self.root, np.arange(len(q)))
        return self.found, self.best

    def _visit(self, at: int, active: np.ndarray) -> None:
        node, k = self.nodes[at], self.best.shape[1]
        if len(node) == 1:
            self.compared += len(active) * len(node[0])
            d = np.hstack([self.best[active], self.q[active] @ self.x[node[0]].T])
            rows = np.hstack([self.found[active], np.broadcast_to(node[0], (len(active), len(node[0])))])
            pick = np.argpartition(-d, k - 1, axis=1)[:, :k]
            self.best[active], self.found[active] = np.take_along_axis(d, pick, 1), np.take_along_axis(rows, pick, 1)
            return
        vantage, inside, outside, near, far = node
        self.compared += len(active)
        d = self.distances(self.q[active], np.array([vantage]))[:, 0]
        within = d < (inside + outside) / 2
        for side, first, then, gap in ((within, near, far, outside - d), (~within, far, near, d - inside)):
            if side.any():
                own = active[side]
                self._visit(first, own)
                radius = np.sqrt(np.maximum(self.span[own] - 2 * self.best[own].min(axis=1), 0))
                rest = self.factor * (gap[side] - self.slack[own]) <= radius + self.slack[own]
                if rest.any():
                    self._visit(then, own[rest])


def shard_nearest(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """query, row and score of the k best rows of a shard for each query, its own left out."""
    x = x + 0.0  # -0.0 becomes 0.0: equal vectors have equal bytes
    order = np.argsort(ids, kind="stable")
    given, ids, x = order, ids[order], x[order]
    _, first, point = np.unique(x.view(f"V{x.shape[1] * 8}").ravel(), return_index=True, return_inverse=True)
    points = x[first]
    square = (points * points).sum(axis=1)
    tree = Tree(np.column_stack([points, np.sqrt(np.maximum(square.max() - square, 0))]))
    found, _ = tree.search(np.column_stack([q, np.zeros(len(q))]), min(k + 1, len(points)), factor)
    by_point = np.argsort(point, kind="stable")  # each point's ids in order
    begin = np.searchsorted(point[by_point], np.arange(len(points) + 1))
    hit = found.ravel() >= 0
    query, found = np.repeat(np.arange(len(q)), found.shape[1])[hit], found.ravel()[hit]
    n = np.minimum(begin[found + 1] - begin[found], k + 1)  # the k smallest ids and the query's own
    row = by_point[np.repeat(begin[found] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
    query = np.repeat(query, n)
    other = ids[row] != query_ids[query]
    query, row = query[other], row[other]
    score = np.einsum("ij,ij->i", q[query], x[row])
    order = np.lexsort((ids[row], -score, query))
    query, row, score = query[order], row[order], score[order]
    rank = np.arange(len(query)) - np.searchsorted(query, query)
    keep = rank < k
    return query_ids[query[keep]], given[row[keep]], score[keep]


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K, factor: float = FACTOR, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k rows of ``vectors`` nearest to each of ``queries``."""
    rows = materialize(_usable(vectors, vec_id, embedding).groupBy("vec_id", "dim", "v").agg(F.count("*").alias("copies")), "vectors")
    asked = materialize(_usable(queries, vec_id, embedding).distinct(), "queries")
    shards, blocks = (max(1, -(-df.count() // size)) for df, size in ((rows, SHARD_ROWS), (asked, BLOCK_QUERIES)))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards))).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    posed = asked.withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)).cast("int")).withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = ([], [], [], [])
        if left.num_rows and right.num_rows:
            ids, query_ids = (t.column("vec_id").to_numpy() for t in (left, right))
            x, q = (np.frombuffer(b"".join(t.column("v").to_pylist()), np.float64).reshape(t.num_rows, -1) for t in (left, right))
            query, row, score = shard_nearest(ids, x, query_ids, q, k, factor)
            out = (query, ids[row], score, left.column("copies").to_numpy()[row])
        return pa.table([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.float64(), pa.int64()))], names=["query_id", "vec_id", "score", "copies"])

    key = ["dim", "shard", "block"]
    best = dealt.groupBy(*key).cogroup(posed.groupBy(*key)).applyInArrow(run, "query_id long, vec_id long, score double, copies long")
    best = best.select("query_id", "vec_id", "score", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(k)))))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def search_table(vectors: DataFrame, step: int = QUERY_STEP, k: int = K, factor: float = FACTOR) -> DataFrame:
    """Queries: the rows whose id is divisible by ``step``."""
    return nearest(vectors, vectors.filter(F.col("vec_id") % step == 0), k, factor)
