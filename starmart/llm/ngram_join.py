"""Similarity self-join of documents on the Jaccard coefficient of their word n-grams.

Two documents link when ``den * |A and B| >= num * |A or B|`` for their sets of
distinct n-word shingles (A-Z lower-cased; words end at white space). The
result is exact: every document with its component under the links.

Global order. The n-grams have one order everywhere: by frequency level, then
by hash. The level is the logarithm of a count over all documents, in a sketch
of 2**log2_cells cells that n-grams share by hash: rare ones come first, what
many documents share comes last. The order does not affect the result, only the
work.

1. Documents with equal sets become one class (a set of 128 hashed bits and its
   size), so exact copies cost one row each from there on.
2. Candidates: linked sets share an n-gram among the first
   ``n - ceil(n * num / den) + 1`` of each, the prefix. Classes meet in the
   lists of the n-grams of their prefixes. First every class of a list is
   paired with the list's leader only; then, once components are known, classes
   of *different* components in a list, where sizes and the n-grams left from
   there on allow a link. So a large group of near copies costs
   one pair per member, not all pairs, and no link is lost: what is never
   compared is already connected.
   A pair whose sizes, or whose parity bitmaps, rule the link out is dropped:
   each n-gram flips one bit of a class's bitmap (as many bits as n-grams, to
   the next power of two), so the bits in which two bitmaps differ are at most
   the n-grams in which the sets differ.
3. Vertical partitioning: the global order is cut into fragments (ranges of
   levels, each cut again by hash), a candidate's set into one segment each. The overlap of a pair is counted in every
   fragment separately, and summed per pair. Only classes in some candidate
   pair take part; they are picked in the scan by a filter of fixed size and
   confirmed by the join.

A text with fewer than n words has one shingle, the whole sequence. Null text
and text without words have none, link with nothing and stay alone: their
component is their own id. Copies in rows that repeat an id link like any
others. A null id takes part; a component's id is its least id that is not
null. An empty table gives an empty result. Columns other than id and text are
ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_of, discard, gram_sets, hash_filter, id_and_text, id_filter, id_position, in_filter, in_hash_filter, lean, materialize, mix, with_id

# Cells of the frequency sketch; cells sent at a time; cuts by hash of each range of levels.
LOG2_CELLS, CHUNK, FRAGMENTS = 23, 1 << 16, 4
LOG2_BITS = 26  # bits of the filter of n-grams that several classes hold


# -------------------------------------------------------------- the order
def _counts(n: int, log2_cells: int):
    """One task's count of n-grams per cell, in compressed chunks."""
    def run(batches):
        cells, shift = np.zeros(1 << log2_cells, np.uint16), np.uint64(64 - log2_cells)

        def add(held):
            u, c = np.unique(np.concatenate(held) >> shift, return_counts=True)
            cells[u] = np.minimum(cells[u] + c, 65535)

        for b in batches:
            held, size = [], 0
            for g in gram_sets(b.column(0), n):
                held.append(g)
                size += len(g)
                if size >= 1 << 18:
                    add(held)
                    held, size = [], 0
            if held:
                add(held)
        if cells.any():
            parts = cells.reshape(-1, min(CHUNK, len(cells)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(parts)), pa.int32()), pa.array([zlib.compress(p.tobytes(), 1) for p in parts], pa.binary())], names=["chunk", "cells"])
    return run


def _levels(batches):
    """Summed over all tasks, on a logarithmic scale."""
    held: dict[int, np.ndarray] = {}
    for b in batches:
        for chunk, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            c = np.frombuffer(zlib.decompress(raw), np.uint16).astype(np.int64)
            held[chunk] = held[chunk] + c if chunk in held else c
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(held), pa.int32()), pa.array([np.minimum(4 * np.log2(1 + c), 255).astype(np.uint8).tobytes() for c in held.values()], pa.binary())], names=["chunk", "levels"])


def frequency_levels(text: DataFrame, n: int, log2_cells: int = LOG2_CELLS) -> np.ndarray:
    """Level of every cell of a sketch that counts the n-grams of all documents
    by their hash's first bits; 2**log2_cells bytes, whatever the input."""
    parts = text.select("text").mapInArrow(lean(_counts(n, log2_cells)), "chunk int, cells binary").repartition(F.col("chunk"))
    levels = np.zeros(1 << log2_cells, np.uint8)
    for r in parts.mapInArrow(lean(_levels), "chunk int, levels binary").collect():
        part = np.frombuffer(r["levels"], np.uint8)
        levels[r["chunk"] * len(part) : (r["chunk"] + 1) * len(part)] = part
    return levels


def _level(levels: np.ndarray, g: np.ndarray) -> np.ndarray:
    return levels[g >> np.uint64(64 - (len(levels) - 1).bit_length())]


# ------------------------------------------------------------- signatures
def _parity(g: np.ndarray) -> np.ndarray:
    """Parity bitmap of a set, in 64-bit words; folding it by exclusive or gives a smaller one."""
    bits = max(64, 1 << (len(g) - 1).bit_length()) if len(g) else 64
    odd = np.bincount((g & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _differing_bits(a: str, b: str):
    """SQL for the number of bits in which two bitmaps differ, folded to the smaller one's size."""
    words = f"least(size({a}), size({b}))"
    fold = lambda x: f"aggregate(sequence(i, size({x}) - 1, {words}), 0L, (w, j) -> w ^ {x}[j])"
    return F.expr(f"aggregate(sequence(0, {words} - 1), 0, (n, i) -> n + bit_count({fold(a)} ^ {fold(b)}))")


def _lists(arrays: list) -> pa.ListArray:
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, arrays)]), pa.int32()), pa.array(flat, pa.int64()))


def _signatures(schema, sent, n: int, num: int, den: int):
    """Size, hash, bitmap and prefix of every document's set."""
    def run(batches):
        for b in batches:
            sizes, h1, h2, bits, prefixes = [], [], [], [], []
            for g in gram_sets(b.column(1), n):
                sizes.append(len(g))
                h1.append(int(mix(g ^ np.uint64(0x5851F42D4C957F2D)).sum().view(np.int64)) if len(g) else 0)
                h2.append(int(mix(g + np.uint64(0x14057B7EF767814F)).sum().view(np.int64)) if len(g) else 0)
                p = len(g) - -(-len(g) * num // den) + 1 if len(g) else 0
                # Sets are in order of hash; a stable sort by level gives the global order.
                first = np.argsort(_level(sent.value, g), kind="stable")[:p]
                prefixes.append(g[first].view(np.int64))
                bits.append(_parity(g))
            yield batch_of(schema, [b.column(0), sizes, h1, h2, _lists(bits), _lists(prefixes)])
    return run


def _segments(sent, filt, n: int, fragments: int):
    """The segments, per fragment of the global order, of the documents in the filter."""
    def run(batches):
        for b in batches:
            b = b.filter(pa.array(in_filter(filt.value, b.column("p").to_numpy())))
            out = []
            for g in gram_sets(b.column("text"), n):
                if not len(g):
                    continue
                key = (len(g), int(mix(g ^ np.uint64(0x5851F42D4C957F2D)).sum().view(np.int64)), int(mix(g + np.uint64(0x14057B7EF767814F)).sum().view(np.int64)))
                frag = (_level(sent.value, g) >> 2).astype(np.int64) * fragments + ((g >> np.uint64(32)).astype(np.int64) * fragments >> 32)
                for f in np.unique(frag):
                    out.append((*key, int(f), g[frag == f].view(np.int64)))
            cols = list(zip(*out)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int32()), pa.array(cols[4], pa.list_(pa.int64()))],
                names=["n", "h1", "h2", "fragment", "grams"])
    return run


# ------------------------------------------------------------- components
def components(links: DataFrame) -> DataFrame:
    """(node, component): the least node reachable, for every node with a link.
    Alternating large-star and small-star steps over the edges; each step's
    edges are written, and the loop ends when they stay the same."""
    edges = materialize(links.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).where("u < v").distinct())

    def mark(e):
        return e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    was = mark(edges)
    while True:
        both = edges.select(F.col("u").alias("x"), F.col("v").alias("y")).unionByName(edges.select(F.col("v").alias("x"), F.col("u").alias("y")))
        least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = both.join(least, "x").where("y > x").select(F.col("m").alias("u"), F.col("y").alias("v")).distinct()
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(least, "v").select(F.col("m").alias("u"), F.when(F.col("u") == F.col("m"), F.col("v")).otherwise(F.col("u")).alias("v"))
        hooked = least.select(F.col("m").alias("u"), "v")
        edges = materialize(small.unionByName(hooked).distinct())
        now = mark(edges)
        if now == was:
            return edges.select(F.col("v").alias("node"), F.col("u").alias("component")).unionByName(edges.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct())
        was = now


# -------------------------------------------------------------------- join
class JaccardJoin:
    """The join of one table; ``classes`` and ``links`` are its parts, ``result`` puts them together."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 3, num: int = 90, den: int = 100,
                 log2_cells: int = LOG2_CELLS, fragments: int = FRAGMENTS):
        from pyspark.sql.pandas.types import to_arrow_schema

        self.n, self.num, self.den, self.fragments = n, num, den, fragments
        self.text = id_and_text(docs, id_col, text_col)
        sc = docs.sparkSession.sparkContext
        self.levels = sc.broadcast(frequency_levels(self.text, n, log2_cells))
        schema = with_id(docs, id_col, ("n", "long"), ("h1", "long"), ("h2", "long"), ("bits", "array<long>"), ("prefix", "array<long>"))
        wide = materialize(self.text.mapInArrow(lean(_signatures(to_arrow_schema(schema), self.levels, n, num, den)), schema).withColumn("row", F.monotonically_increasing_id()))
        # A class is named by its first row. Arrays take no part in the aggregate; those of the first rows join back.
        self.sets = materialize(wide.select("doc_id", "n", "h1", "h2", "row"))
        heads = self.sets.where("n > 0").groupBy("n", "h1", "h2").agg(F.min("doc_id").alias("first_id"), F.min("row").alias("class"))
        self.classes = materialize(wide.select(F.col("row").alias("class"), "bits", "prefix").join(heads, "class"))
        discard(wide)

    def _meet(self, n1: str, rest1: str, n2: str, rest2: str, high1: str | None = None, high2: str | None = None):
        """Whether two sets can link whose first common n-gram is the one they
        meet at: by their sizes, and because what they share is at most what
        either has from there on. With ``high``, n and high are a range."""
        sizes = F.least(high1 or n1, high2 or n2) * self.den >= F.greatest(n1, n2) * self.num
        return sizes & (F.least(rest1, rest2) * (self.den + self.num) >= (F.col(n1) + F.col(n2)) * self.num)

    @staticmethod
    def _ordered(pairs: DataFrame) -> DataFrame:
        """(a, b, na, nb) with a < b of structs x and y of class and n."""
        low, high = F.least("x", "y"), F.greatest("x", "y")
        return pairs.select(low["class"].alias("a"), high["class"].alias("b"), low["n"].alias("na"), high["n"].alias("nb"))

    def possible(self, pairs: DataFrame) -> DataFrame:
        """The pairs that their bitmaps do not rule out."""
        bits = self.classes.select("class", "bits")
        both = pairs.join(bits.select(F.col("class").alias("a"), F.col("bits").alias("x")), "a").join(bits.select(F.col("class").alias("b"), F.col("bits").alias("y")), "b")
        size = F.col("na") + F.col("nb")
        return both.where((size - _differing_bits("x", "y")) * (self.den + self.num) >= size * (2 * self.num)).select("a", "b", "na", "nb")

    def verify(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b, na, nb) of classes that link: overlaps per fragment, summed; written."""
        sc = pairs.sparkSession.sparkContext
        pairs = materialize(pairs)
        wanted = pairs.select(F.col("a").alias("class")).unionByName(pairs.select(F.col("b").alias("class"))).distinct()
        wanted = materialize(self.classes.join(wanted, "class", "left_semi").select("class", "first_id", "n", "h1", "h2"))
        chosen = sc.broadcast(id_filter(wanted, "first_id"))
        rows = self.text.withColumn("p", id_position(F.col("doc_id")))
        segments = rows.mapInArrow(lean(_segments(self.levels, chosen, self.n, self.fragments)), "n long, h1 long, h2 long, fragment int, grams array<long>")
        segments = segments.join(wanted, ["n", "h1", "h2"]).groupBy("class", "fragment").agg(F.first("grams").alias("grams"))
        segments = materialize(segments)
        left = segments.select(F.col("class").alias("a"), "fragment", F.col("grams").alias("left"))
        right = segments.select(F.col("class").alias("b"), "fragment", F.col("grams").alias("right"))
        partial = pairs.join(left, "a").join(right, ["b", "fragment"]).select("a", "b", "na", "nb", F.size(F.array_intersect("left", "right")).alias("common"))
        total = partial.groupBy("a", "b", "na", "nb").agg(F.sum("common").alias("common"))
        links = materialize(total.where(F.col("common") * (self.den + self.num) >= (F.col("na") + F.col("nb")) * self.num).select("a", "b"))
        discard(pairs, wanted, segments)
        chosen.unpersist()
        return links

    def _shared(self) -> DataFrame:
        """The postings (gram, class, n, rest) of n-grams in the prefixes of
        several classes; rest: n-grams of the set from this one on, in the global order."""
        sc = self.text.sparkSession.sparkContext
        grams = self.classes.select(F.explode("prefix").alias("gram")).groupBy("gram").agg(F.count("*").alias("m")).where("m > 1").select("gram")
        grams = materialize(grams)
        bits = sc.broadcast(hash_filter(grams, "gram", LOG2_BITS))

        def some(batches):
            for b in batches:
                prefix = b.column(2)
                gram = prefix.flatten().to_numpy().view(np.uint64)
                owner = np.repeat(np.arange(b.num_rows), np.diff(prefix.offsets.to_numpy()))
                at = np.arange(len(gram)) - (prefix.offsets.to_numpy()[:-1] - prefix.offsets.to_numpy()[0])[owner]
                keep = in_hash_filter(bits.value, gram)
                owner, n = owner[keep], b.column(1).to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gram[keep].view(np.int64)), pa.array(b.column(0).to_numpy()[owner]), pa.array(n[owner]), pa.array(n[owner] - at[keep])], names=["gram", "class", "n", "rest"])

        postings = self.classes.select("class", "n", "prefix").mapInArrow(lean(some), "gram long, class long, n long, rest long")
        shared = materialize(postings.join(grams, "gram", "left_semi"))
        bits.unpersist()
        discard(grams)
        return shared

    def links(self) -> DataFrame:
        """Links (a, b) of classes that connect all that the similarity connects."""
        shared = self._shared()
        # The member with the fewest rarer n-grams leads: it is closest to the others.
        leaders = shared.groupBy("gram").agg(F.min(F.struct(F.col("n") - F.col("rest"), "class", "n", "rest")).alias("leader"))
        first = shared.join(leaders, "gram").where(F.col("class") != F.col("leader.class")).where(self._meet("n", "rest", "leader.n", "leader.rest"))
        first = first.select(F.struct("class", "n").alias("x"), F.struct("leader.class", "leader.n").alias("y"))
        first = materialize(self._ordered(first).distinct())
        links = self.verify(self.possible(first))
        known = components(links)

        member = shared.join(known, shared["class"] == known["node"], "left").select("gram", "class", "n", "rest", F.coalesce("component", "class").alias("component"))
        member = materialize(member)
        discard(shared)
        mixed = member.groupBy("gram").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("gram")
        every, member = member, materialize(member.join(mixed, "gram"))
        discard(every)
        parts = materialize(member.groupBy("gram", "component").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.max("rest").alias("rest")))
        p, q = (parts.select("gram", *[F.col(c).alias(c + i) for c in ("component", "low", "high", "rest")]) for i in "12")
        # Two components can hold a link only if the best of each could.
        across = p.join(q, "gram").where("component1 < component2").where(self._meet("low1", "rest1", "low2", "rest2", "high1", "high2"))
        a, b = (member.select("gram", *[F.col(c).alias(c + i) for c in ("component", "class", "n", "rest")]) for i in "12")
        second = across.select("gram", "component1", "component2").join(a, ["gram", "component1"]).join(b, ["gram", "component2"]).where(self._meet("n1", "rest1", "n2", "rest2"))
        second = self._ordered(second.select(F.struct(F.col("class1").alias("class"), F.col("n1").alias("n")).alias("x"), F.struct(F.col("class2").alias("class"), F.col("n2").alias("n")).alias("y")))
        second = second.distinct().join(first.select("a", "b"), ["a", "b"], "left_anti")
        more = self.verify(self.possible(second))
        discard(first, member, parts)
        self.levels.unpersist()
        return links.unionByName(more)

    def result(self) -> DataFrame:
        """One row per document: doc_id, n_shingles, component_id."""
        known = components(materialize(self.links()))
        named = self.classes.join(known, self.classes["class"] == known["node"], "left").select("n", "h1", "h2", "first_id", F.coalesce("component", "class").alias("component"))
        named = materialize(named)
        discard(self.classes)
        least = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
        named = named.join(least, "component").select("n", "h1", "h2", "component_id")
        linked = self.sets.where("n > 0").join(named, ["n", "h1", "h2"]).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
        return linked.unionByName(self.sets.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def jaccard_components(docs: DataFrame, **options) -> DataFrame:
    return JaccardJoin(docs, **options).result()


def brute_force(rows: list[tuple], n: int = 3, num: int = 90, den: int = 100) -> dict:
    """{doc_id: (n_shingles, component_id)} by comparing all pairs; for tests."""
    sets = {}
    for doc_id, text in rows:
        w = (text or "").encode().lower().split()
        sets[doc_id] = {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()
    parent = {d: d for d in sets}

    def find(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                ra, rb = find(a), find(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {d: (len(sets[d]), find(d)) for d in ids}


SQL = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS row, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS MATERIALIZED (SELECT row, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
  ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS g FROM d),
e AS MATERIALIZED (SELECT row, unnest(g) AS gram FROM s),
pairs AS (SELECT a.row AS a, b.row AS b, count(*) AS common FROM e a JOIN e b ON a.gram = b.gram AND a.row < b.row GROUP BY a.row, b.row),
links AS MATERIALIZED (SELECT a, b FROM pairs JOIN s x ON x.row = a JOIN s y ON y.row = b WHERE 100 * common >= 90 * (len(x.g) + len(y.g) - common)),
near AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(row, other) AS (SELECT row, row FROM s UNION SELECT reached.row, near.b FROM reached JOIN near ON near.a = reached.other)
SELECT x.doc_id, CAST(len(any_value(x.g)) AS BIGINT) AS n_shingles, min(y.doc_id) AS component_id
FROM reached JOIN s x ON x.row = reached.row JOIN s y ON y.row = reached.other GROUP BY x.row, x.doc_id"""
