"""Exact top-k inner-product search by ball-tree branch and bound.

Vectors become integers, floor(scale * x) per component, and the score is the
integer inner product. Candidates are dealt to shards of about ``shard_rows``
rows by the hash of their id. Every shard builds a ball tree (each node a
centre and a radius; a node is split at the median of its widest direction).
Queries go through a shard in blocks. A heap orders the nodes by their largest
upper bound of the inner product, q.c + |q| r, over the queries still open
there; a query leaves a node when the bound is below its current k-th score.

The k-th score is shared: a first round searches every query's own shard only,
and its k-th score bounds the search of all other shards from the start. The
shards' answers are merged per query.

Equal scores go to the smaller id, so a node is left only when its bound is
strictly below the k-th score. A vector that is null or holds a null or
non-finite component takes no part, as candidate or query. A shorter vector
counts as padded with zeros. A query's own row (same id) is no candidate;
rows that repeat an id are candidates each. Sums of products run in floating
point while they are exact there (below 2**53), else in Python integers, and a
score outside 64 bits saturates. Without candidates a query has no rows.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, ship

K, SCALE, SHARD_ROWS, BLOCK_ROWS, LEAF = 20, 64, 8192, 4096, 64
OUT = "query_id long, vec_id long, score long"


def as_integers(vectors: pd.Series, scale: int) -> np.ndarray:
    """(rows, dimension) of floor(scale * x), in floats while these are exact, else Python integers."""
    width = max((len(v) for v in vectors), default=0)
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    out = np.floor(out * scale)
    if width and np.square(out).sum(1).max(initial=0) >= 2.0**52:
        out = np.array([[int(x) for x in row] for row in out], object)
    return out


def _dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    w = min(a.shape[1], b.shape[1])
    return a[:, :w] @ b[:, :w].T


def _as_floats(scores: np.ndarray) -> np.ndarray:
    """Scores as floats, those beyond a float's range as what is surely below them."""
    if scores.dtype != object:
        return scores
    return np.array([1e300 if v > 1e300 else -np.inf if v < -1e300 else float(v) for v in scores])


class BallTree:
    """Nodes in arrays; ``rows`` orders the vectors so that a node is a slice."""

    def __init__(self, x: np.ndarray, leaf: int = LEAF):
        f = x.astype(float)
        self.rows = np.arange(len(x))
        self.centre, self.radius, self.span, self.children = [], [], [], []
        todo = [(0, len(x), -1)]
        while todo:
            lo, hi, parent = todo.pop()
            me, part = len(self.span), f[self.rows[lo:hi]]
            c = part.mean(0)
            self.centre.append(c)
            self.radius.append(np.sqrt(np.square(part - c).sum(1).max()))
            self.span.append((lo, hi))
            self.children.append([])
            if parent >= 0:
                self.children[parent].append(me)
            if hi - lo > leaf:
                axis = int(np.argmax(part.var(0)))
                self.rows[lo:hi] = self.rows[lo:hi][np.argsort(part[:, axis], kind="stable")]
                mid = (lo + hi) // 2
                todo += [(lo, mid, me), (mid, hi, me)]
        self.centre, self.radius = np.array(self.centre), np.array(self.radius)


def _keep_best(best: np.ndarray, ids: np.ndarray, scores: np.ndarray, cand: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Merge candidates (the same for all rows) into the rows' k best (score, id)."""
    s = np.concatenate([best, scores], 1)
    i = np.concatenate([ids, np.broadcast_to(cand, scores.shape)], 1)
    if s.dtype == object:
        o = np.array([sorted(range(s.shape[1]), key=lambda c: (-a[c], b[c]))[:k] for a, b in zip(s, i)])
    else:
        o = np.lexsort((i, -s), axis=1)[:, :k]
    return np.take_along_axis(s, o, 1), np.take_along_axis(i, o, 1)


def search(x: np.ndarray, x_ids: np.ndarray, q: np.ndarray, q_ids: np.ndarray, floor: np.ndarray, k: int, leaf: int = LEAF) -> pd.DataFrame:
    """The k best of ``x`` for every row of ``q``, none below its ``floor`` (the shared k-th score)."""
    exact = x.dtype != object and q.dtype != object
    width = min(x.shape[1], q.shape[1])
    with np.errstate(all="ignore"):  # beyond a float's range a bound is infinite
        tree, qf = BallTree(x, leaf), q.astype(float)
        bound = qf[:, :width] @ tree.centre[:, :width].T + np.sqrt(np.square(qf).sum(1))[:, None] * tree.radius
        # A margin above rounding keeps the bound an upper bound.
        bound = np.nan_to_num(bound + 1e-9 * (np.abs(bound) + 1), nan=np.inf, posinf=np.inf, neginf=-np.inf)
    low = -np.inf
    best = np.full((len(q), k), low, float if exact else object)
    ids = np.full((len(q), k), np.iinfo(np.int64).max)
    floor = floor.astype(float)
    heap = [(-float(bound[:, 0].max(initial=-np.inf)), 0, np.arange(len(q)))]
    while heap:
        _, node, open_ = heapq.heappop(heap)
        kth = np.maximum(floor[open_], _as_floats(best[open_, k - 1]))
        open_ = open_[bound[open_, node] >= kth]
        if not len(open_):
            continue
        if tree.children[node]:
            for c in tree.children[node]:
                heapq.heappush(heap, (-float(bound[open_, c].max()), c, open_))
            continue
        rows = tree.rows[slice(*tree.span[node])]
        scores = _dots(q[open_], x[rows])
        same = q_ids[open_][:, None] == x_ids[rows][None, :]
        if same.any():
            scores = np.where(same, low, scores)
        best[open_], ids[open_] = _keep_best(best[open_], ids[open_], scores, x_ids[rows], k)
    found = best > low
    r, c = np.nonzero(found)
    s = best[r, c]
    s = s.astype(np.int64) if exact else np.array([min(max(int(v), -(2**63)), 2**63 - 1) for v in s], np.int64)
    return pd.DataFrame({"query_id": q_ids[r], "vec_id": ids[r, c], "score": s})


def top_k(vectors: DataFrame, queries, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, scale: int = SCALE,
          shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows for each row that the
    condition ``queries`` (on the id) picks. Needs long ids; null ids take no part."""
    ship(vectors.sparkSession)
    v = F.col(f"`{vector_col}`")
    fine = v.isNotNull() & ~F.coalesce(F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(False))
    rows = vectors.where(fine & F.col(f"`{id_col}`").isNotNull()).select(F.col(f"`{id_col}`").cast("long").alias("id"), v.cast("array<double>").alias("v"), queries.alias("asks"))
    rows = materialize(rows)
    n, asking = rows.agg(F.count("*"), F.count_if("asks")).first()
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-asking // block_rows))
    # Repeated ids would meet in one shard: a second hash, of the vector too, deals them out.
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("id", "v"), F.lit(shards)).cast("int")).withColumn("block", F.pmod(F.hash("id", "v"), F.lit(blocks)).cast("int"))
    asks = rows.where("asks")

    def run(group):
        ask = group["floor"].notna().to_numpy()
        left, right = group[~ask], group[ask]
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        x, q = as_integers(left["v"], scale), as_integers(right["v"], scale)
        return search(x, left["id"].to_numpy(np.int64), q, right["id"].to_numpy(np.int64), right["floor"].to_numpy(float), k)

    def through(cand, ask):  # a candidate has no floor
        both = cand.select("id", "v", "shard", "block", F.lit(None).cast("double").alias("floor")).unionByName(ask.select("id", "v", "shard", "block", "floor"))
        return both.groupBy("shard", "block").applyInPandas(run, OUT)

    every = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    home = materialize(through(every, asks.withColumn("floor", F.lit(float("-inf")))))
    kth = home.groupBy("query_id").agg(F.count("*").alias("m"), F.min("score").alias("kth"))
    kth = kth.select("query_id", F.when(F.col("m") >= k, F.col("kth").cast("double")).alias("kth"))
    away = asks.join(kth.withColumnRenamed("query_id", "id"), "id", "left").withColumn("own", F.col("shard")).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).where("shard != own")
    away = through(every, away.withColumn("floor", F.coalesce("kth", F.lit(float("-inf")))))
    both = home.unionByName(away).groupBy("query_id").agg(F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("minus"), "vec_id", "score"))), 1, k).alias("best"))
    return both.select("query_id", F.posexplode("best").alias("at", "b")).select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"), F.col("b.score").alias("score"))


SQL = """
WITH e AS (SELECT vec_id, [floor(64 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20"""
