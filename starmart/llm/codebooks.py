"""Vector code compression: product-quantisation codebooks by dual-tree Lloyd rounds.

Each component x becomes the integer floor(scale * x). Vectors are cut into
``parts`` equal consecutive parts, and every part position has a codebook that
starts as that part of the ``entries`` smallest vec_ids. A round assigns every
part to the nearest entry (squared Euclidean distance, equal distances to the
lower index) and replaces each entry by the componentwise floor(sum / count) of
its parts; an entry without parts stays. After the rounds, parts are assigned
once more.

Dual tree. An Arrow batch of vectors is a shard. For every part position a
shard has a tree over its parts: nodes are halves at the median of the widest
side of the node's bounding box, and hold that box and the *cached sum* of
their parts. Trees are built once, written, and reread by every round. A round
broadcasts the codebooks (``parts * entries`` integer vectors, a size set by
parameters) and builds a tree of the same kind over each codebook's entries.
The two trees are descended together: of a pair (node of parts, node of
entries) the boxes give the least and the largest squared distance, and a pair
whose least distance is beyond another pair's largest, for the same node of
parts, is pruned. A node of parts with one entry left is assigned whole, by its
cached sum. Leaves with several are settled by integer distances to the entries
left. All bounds are integers and pruning is strict, so the result is that of
comparing everything, ties included, and does not depend on how the vectors are
dealt to shards.

A task sends one sum per entry and component; Spark adds them up, and only the
new codebooks reach the driver.

A vector that is null or holds a null or non-finite component is dropped.
Vectors shorter than the longest, or whose length ``parts`` does not divide,
count as padded with zeros. Integers beyond 2**25 in size count as 2**25, so
that sums stay within 64 bits. Null vec_ids come after all others in the choice
of first entries, and rows that repeat a vec_id are rows each, in the order of
their vectors. With fewer rows than ``entries`` the codebooks are that much
smaller; an empty table gives an empty result. Columns other than id, vector
and label are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import batch_of, lean, materialize, ship

PARTS, ENTRIES, SCALE, ROUNDS, LEAF = 4, 256, 1024, 4, 32
LARGEST = 1 << 25
COUNT = -1  # place of an entry's count among its sums


def integers(column: pa.Array, width: int, scale: int) -> np.ndarray:
    """(rows, width) of floor(scale * x), zeros after the end of a shorter vector."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    flat = np.clip(np.floor(flat * scale), -LARGEST, LARGEST).astype(np.int32)
    sizes = np.diff(column.offsets.to_numpy()) if len(column) else np.empty(0, np.int64)
    out = np.zeros((len(sizes), width), np.int32)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


# -------------------------------------------------------------------- trees
class Tree:
    """A complete binary tree over the rows of an integer matrix. Node k's
    children are 2k+1 and 2k+2; ``order`` lists rows so that every node has
    the consecutive ones from ``lo`` to ``hi``."""

    def __init__(self, x: np.ndarray, leaf: int, order: np.ndarray | None = None):
        n = len(x)
        self.depth = max(0, int(np.log2(n / leaf))) if n >= leaf else 0
        level, bounds = np.array([0, n]), []
        for d in range(self.depth + 1):
            bounds.append(level)
            if d < self.depth:
                level = np.sort(np.concatenate([level, (level[:-1] + level[1:]) // 2]))
        if order is None:
            order = np.arange(n)
            for level in bounds[:-1]:
                for lo, hi in zip(level[:-1], level[1:]):
                    rows = x[order[lo:hi]]
                    widest = int(np.argmax(rows.max(0) - rows.min(0))) if x.shape[1] else 0
                    if x.shape[1]:
                        order[lo:hi] = order[lo:hi][np.argpartition(rows[:, widest], (lo + hi) // 2 - lo)]
        self.order = order
        self.lo = np.concatenate([b[:-1] for b in bounds])
        self.hi = np.concatenate([b[1:] for b in bounds])
        sorted_ = x[order].astype(np.int64)
        self.x = sorted_
        self.low, self.high, self.sum = (np.concatenate([f.reduceat(sorted_, b[:-1], 0) for b in bounds]) for f in (np.minimum, np.maximum, np.add))

    def last(self, nodes: np.ndarray) -> np.ndarray:
        return nodes >= (1 << self.depth) - 1


def _box_distances(a: Tree, b: Tree, p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest squared distance of the boxes of paired nodes."""
    least, largest = np.zeros(len(p), np.int64), np.zeros(len(p), np.int64)
    for j in range(a.low.shape[1]):
        below, above = b.low[q, j] - a.high[p, j], a.low[p, j] - b.high[q, j]
        gap = np.maximum(0, np.maximum(below, above))
        span = np.maximum(b.high[q, j] - a.low[p, j], a.high[p, j] - b.low[q, j])
        least += gap * gap
        largest += span * span
    return least, largest


def assign(tree: Tree, entries: np.ndarray, over: Tree | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest entry of each row (in the rows' own order), and per entry the
    sum of its rows and their number."""
    over = over or Tree(entries, 1)
    label = np.empty(len(tree.order), np.int64)
    sums, counts = np.zeros(entries.shape, np.int64), np.zeros(len(entries), np.int64)
    wide = entries.astype(np.int64)
    square = (wide * wide).sum(1)
    p, q = np.zeros(1, np.int64), np.zeros(1, np.int64)
    while len(p):
        # pairs stand in order of p
        least, largest = _box_distances(tree, over, p, q)
        first = np.flatnonzero(np.diff(p, prepend=-1))
        bound = np.repeat(np.minimum.reduceat(largest, first), np.diff(np.append(first, len(p))))
        keep = least <= bound
        p, q = p[keep], q[keep]
        first = np.flatnonzero(np.diff(p, prepend=-1))
        size = np.diff(np.append(first, len(p)))
        # one entry left: the whole node is its own
        whole = first[(size == 1) & (over.hi[q[first]] - over.lo[q[first]] == 1)]
        for k in whole:
            node, e = p[k], over.order[over.lo[q[k]]]
            label[tree.lo[node] : tree.hi[node]] = e
            sums[e] += tree.sum[node]
            counts[e] += tree.hi[node] - tree.lo[node]
        open_ = np.ones(len(p), bool)
        open_[whole] = False
        p, q = p[open_], q[open_]
        done = tree.last(p) & over.last(q)
        if done.all():  # all nodes of a step are of one level
            break
        if not over.last(q).all():
            p, q = np.repeat(p, 2), (2 * q[:, None] + (1, 2)).ravel()
        if not tree.last(p).all():
            q = np.tile(q, 2)
            p = np.concatenate([2 * p + 1, 2 * p + 2])
            o = np.argsort(p, kind="stable")
            p, q = p[o], q[o]
    first = np.flatnonzero(np.diff(p, prepend=-1))
    for a, b in zip(first, np.append(first[1:], len(p))):
        lo, hi = tree.lo[p[a]], tree.hi[p[a]]
        near = np.sort(np.concatenate([over.order[over.lo[k] : over.hi[k]] for k in q[a:b]]))
        rows = tree.x[lo:hi]
        e = near[np.argmin(square[near] - 2 * (rows @ wide[near].T), 1)]
        label[lo:hi] = e
        np.add.at(sums, e, rows)
        counts += np.bincount(e, minlength=len(counts))
    out = np.empty_like(label)
    out[tree.order] = label
    return out, sums, counts


# ----------------------------------------------------------------- operator
def _packed(x: np.ndarray, parts: int, leaf: int) -> bytes:
    """The integers of a shard and the order of its trees; boxes and sums follow from these."""
    held = io.BytesIO()
    cuts = np.split(x, parts, 1)
    np.savez(held, x=x, **{f"order{j}": Tree(c, leaf).order.astype(np.int32) for j, c in enumerate(cuts)})
    return held.getvalue()


def _unpacked(raw: bytes, parts: int, leaf: int) -> tuple[np.ndarray, list[Tree]]:
    held = np.load(io.BytesIO(raw))
    x = held["x"]
    return x, [Tree(c, leaf, held[f"order{j}"]) for j, c in enumerate(np.split(x, parts, 1))]


class Codebooks:
    """Codebooks of one table. ``shards`` are the trees; ``fit`` runs the rounds."""

    def __init__(self, vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 parts: int = PARTS, entries: int = ENTRIES, scale: int = SCALE, leaf: int = LEAF):
        ship(vectors.sparkSession)
        self.spark, self.parts, self.leaf = vectors.sparkSession, parts, leaf
        kind = {c: vectors.schema[c].dataType for c in (id_col, label_col)}
        rows = vectors.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{label_col}`").alias("label"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
        rows = rows.where("v is not null and forall(v, x -> x is not null and abs(x) < double('inf'))")  # NaN is above infinity
        longest = rows.agg(F.max(F.size("v"))).first()[0] or 0
        width = -(-longest // parts) * parts
        first = [r["v"] for r in rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()]
        start = integers(pa.array(first, pa.list_(pa.float64())), width, scale).astype(np.int64)
        self.books = np.split(start, parts, 1)

        held = T.StructType([T.StructField("ids", T.ArrayType(kind[id_col])), T.StructField("labels", T.ArrayType(kind[label_col])), T.StructField("trees", T.BinaryType())])
        self.kind = T.StructType([T.StructField("vec_id", kind[id_col]), T.StructField("label", kind[label_col]), T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
        arrow = _arrow(held)

        def one(values, f):
            return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values).cast(f.type)

        def shards(batches):
            for b in batches:
                if b.num_rows:
                    yield batch_of(arrow, [one(b.column(0), arrow[0]), one(b.column(1), arrow[1]), [_packed(integers(b.column(2), width, scale), parts, leaf)]])

        self.shards = materialize(rows.mapInArrow(lean(shards), held))

    def round(self) -> None:
        """Every entry becomes the floor of the mean of the parts nearest to it."""
        sent, parts, leaf = self.spark.sparkContext.broadcast(self.books), self.parts, self.leaf

        def sums(batches):
            trees = [Tree(b, 1) for b in sent.value]
            total = [(np.zeros(b.shape, np.int64), np.zeros(len(b), np.int64)) for b in sent.value]
            for b in batches:
                for raw in b.column(0):
                    for j, tree in enumerate(_unpacked(raw.as_py(), parts, leaf)[1]):
                        _, s, n = assign(tree, sent.value[j], trees[j])
                        total[j][0][:] += s
                        total[j][1][:] += n
            for j, (s, n) in enumerate(total):
                for e in np.flatnonzero(n):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([j] * (len(s[e]) + 1), pa.int32()), pa.array([e] * (len(s[e]) + 1), pa.int32()), pa.array([COUNT, *range(len(s[e]))], pa.int32()), pa.array([n[e], *s[e]], pa.int64())],
                        names=["part", "entry", "at", "value"])

        # a start of no rows at all gives no trees
        if len(self.books[0]) == 0:
            return
        got = self.shards.select("trees").mapInArrow(lean(sums), "part int, entry int, at int, value long").groupBy("part", "entry", "at").agg(F.sum("value").alias("value")).collect()
        count = {(r["part"], r["entry"]): r["value"] for r in got if r["at"] == COUNT}
        books = [b.copy() for b in self.books]
        for r in got:
            if r["at"] != COUNT:
                books[r["part"]][r["entry"], r["at"]] = r["value"] // count[r["part"], r["entry"]]
        self.books = books
        sent.unpersist()

    def fit(self, rounds: int = ROUNDS) -> Codebooks:
        for _ in range(rounds):
            self.round()
        return self

    def digest(self) -> str:
        """SHA-256 of all entries' integers by part, entry and place within the part."""
        return hashlib.sha256(",".join(str(v) for b in self.books for v in b.ravel()).encode()).hexdigest()

    def encode(self) -> DataFrame:
        """One row per kept row: vec_id, label, code (two hex digits per part), error."""
        sent, parts, leaf, arrow = self.spark.sparkContext.broadcast(self.books), self.parts, self.leaf, _arrow(self.kind)

        def codes(batches):
            trees = [Tree(b, 1) for b in sent.value if len(b)]
            for b in batches:
                for ids, labels, raw in zip(b.column("ids"), b.column("labels"), b.column("trees")):
                    x, own = _unpacked(raw.as_py(), parts, leaf)
                    error, text = np.zeros(len(x), np.int64), np.full(len(x), "")
                    for j, part in enumerate(np.split(x, parts, 1)):
                        e = assign(own[j], sent.value[j], trees[j])[0]
                        off = part - sent.value[j][e]
                        error += (off * off).sum(1)
                        text = np.char.add(text, np.array([f"{k:02x}" for k in range(len(sent.value[j]))])[e])
                    yield batch_of(arrow, [ids.values, labels.values, pa.array(text.tolist()), error])

        return self.shards.mapInArrow(lean(codes), self.kind)


def _arrow(schema):
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def compress(vectors: DataFrame, rounds: int = ROUNDS, **options) -> DataFrame:
    """One row per kept row: vec_id, label, code, error, label_error (the errors of
    all rows of the label, nulls together) and codebooks_sha256."""
    books = Codebooks(vectors, **options).fit(rounds)
    codes = materialize(books.encode())
    of_label = codes.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    both = codes.join(of_label, F.col("label").eqNullSafe(F.col("of")))
    return both.select("vec_id", "label", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


def brute_force(rows: list[tuple], parts: int = PARTS, entries: int = ENTRIES, scale: int = SCALE, rounds: int = ROUNDS) -> tuple[list, str]:
    """([(vec_id, code, error)], codebooks_sha256) of rows (vec_id, vector) by comparing everything in plain integers; for tests."""
    import math

    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max((len(v) for _, v in kept), default=0) // parts)
    kept = [(i, [(v + [0] * (width * parts))[j * width : (j + 1) * width] for j in range(parts)]) for i, v in kept]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[list(v[j]) for _, v in first] for j in range(parts)]

    def nearest(j, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, c)), e) for e, c in enumerate(books[j]))

    for _ in range(rounds):
        for j in range(parts):
            own: dict = {}
            for _, v in kept:
                own.setdefault(nearest(j, v[j])[1], []).append(v[j])
            books[j] = [[sum(c) // len(own[e]) for c in zip(*own[e])] if e in own else b for e, b in enumerate(books[j])]
    out = [(i, *zip(*(nearest(j, v[j]) for j in range(parts)))) for i, v in kept]
    text = ",".join(str(x) for b in books for c in b for x in c)
    return [(i, "".join(f"{e:02x}" for e in es), sum(ds)) for i, ds, es in out], hashlib.sha256(text.encode()).hexdigest()


def _sql(parts: int = PARTS, entries: int = ENTRIES, scale: int = SCALE, rounds: int = ROUNDS) -> str:
    nearest = """a{k} AS MATERIALIZED (SELECT r, part, min({{'d': x2 + c2 - 2 * list_inner_product(x, c), 'e': entry}}) AS best
  FROM cut JOIN c{k} USING (part) GROUP BY r, part)"""
    update = """c{n} AS MATERIALIZED (SELECT part, entry, c, list_inner_product(c, c) AS c2 FROM (
  SELECT o.part, o.entry, coalesce(m.c, o.c) AS c FROM c{k} o LEFT JOIN (
    SELECT part, entry, list(m ORDER BY pos) AS c FROM (
      SELECT part, entry, pos, floor(sum(v) / count(*)) AS m FROM (
        SELECT cut.part, best.e AS entry, unnest(x) AS v, generate_subscripts(x, 1) AS pos FROM a{k} JOIN cut USING (r, part))
      GROUP BY part, entry, pos) GROUP BY part, entry) m USING (part, entry)))"""
    steps = [s.format(k=k, n=k + 1) for k in range(rounds) for s in (nearest, update)] + [nearest.format(k=rounds)]
    return f"""WITH kept AS MATERIALIZED (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS r,
    list_transform(embedding, lambda x: greatest(-{LARGEST}.0, least({LARGEST}.0, floor(CAST(x AS DOUBLE) * {scale})))) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
wide AS (SELECT CAST(ceil(max(len(v)) / {parts}) AS BIGINT) AS w FROM kept),
cut AS MATERIALIZED (SELECT r, part, x, list_inner_product(x, x) AS x2 FROM (
  SELECT r, part, list_transform(range(part * w + 1, part * w + w + 1), lambda i: coalesce(v[i], 0.0)) AS x FROM kept, wide, range({parts}) t(part))),
c0 AS MATERIALIZED (SELECT part, r AS entry, x AS c, x2 AS c2 FROM cut WHERE r < {entries}),
{(","+chr(10)).join(steps)},
whole AS (SELECT r, string_agg(format('{{:02x}}', best.e), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM a{rounds} GROUP BY r),
book AS (SELECT sha256(string_agg(CAST(CAST(v AS BIGINT) AS VARCHAR), ',' ORDER BY part, entry, pos)) AS h
  FROM (SELECT part, entry, unnest(c) AS v, generate_subscripts(c, 1) AS pos FROM c{rounds}))
SELECT vec_id, label, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM kept JOIN whole USING (r), book"""


SQL = _sql()
