"""SentencePiece encoding and decoding over a lattice.

The text gets one leading blank, and a blank is written as U+2581. Where a run
of blanks begins a new unit begins; no piece holds a blank after another
character, so units are encoded on their own. Within a unit:

1. explode: all substrings of at most the longest piece's length,
2. equi-join with the piece table: the edges of the lattice; a character that
   is no piece gets an edge of the unknown score (the least score less 10),
   which stands for its UTF-8 bytes as byte pieces,
3. group the edges by unit and end,
4. fold: the best score of every end, from its edges; the path of the last end
   is the encoding. Of equal scores the edge that starts first wins.

The score of a path is the sum of its pieces' scores. In a model trained by
merging (its scores count the merges) a path counts only if merging would leave
each pair of neighbours as they are. Merges across a border depend on the two
pieces at the border alone, so exactly one path passes, and it is the model's
own encoding. Which pairs pass is worked out once per pair met.

``encode`` runs these steps inside the tasks, over arrays that hold all the
distinct units of some neighbouring texts at once, and remembers units it has
seen. ``encode_words`` is the same lattice in DataFrame functions, with the
fold as a higher-order ``aggregate``, for a table of words: joining its result
back to the texts would shuffle every word of the corpus (see the README).

Null text and empty text have no tokens, and decode to the empty text. Every
other text decodes to itself, byte for byte, but for U+2581, which comes back
as a blank. Bytes that are not UTF-8 become byte pieces. Very long texts and
units only take longer: work goes in groups of a few MB, a longer text alone.
Repeated rows each give a row. Columns other than id and text are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_of, id_and_text, lean, mix, spans_hash, texts, with_id

BLANK = "▁"
GROUP_BYTES, UNIT_BYTES, REMEMBERED, PAIRS = 1 << 20, 50_000, 1 << 19, 1 << 20
_R = np.random.Generator(np.random.PCG64(404)).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@dataclass
class Pieces:
    """The piece table; its size is that of the vocabulary file."""
    rows: list  # (piece, id, score) of ordinary pieces
    byte_ids: list  # id of each byte's piece
    spelled: list  # bytes of every id
    unknown: float
    merging: bool = False

    def __post_init__(self):
        if self.merging:
            self.rank = {p: s for p, _, s in self.rows}
            self.rows = [r for r in self.rows if self.merge(r[0]) == [r[0]]]  # no other piece can be left by merging
        self.longest = max(len(p) for p, _, _ in self.rows)
        keys = np.array([_spell_hash(p) for p, _, _ in self.rows], np.uint64)
        o = np.argsort(keys)
        self.keys, self.ids = keys[o], np.array([r[1] for r in self.rows], np.int32)[o]
        self.scores = np.array([r[2] for r in self.rows])[o]
        self.maybe = np.zeros(1 << 22, bool)  # cheap test before the search
        self.maybe[(self.keys >> np.uint64(42)).astype(np.int64)] = True
        self.bytes_of = np.frombuffer(b"".join(self.spelled), np.uint8)
        self.at = np.cumsum([0, *map(len, self.spelled)])
        self.byte_id = np.array(self.byte_ids, np.int32)
        self.spelling = {i: p for p, i, _ in self.rows}
        self.pairs, self.passing = np.empty(0, np.int64), np.empty(0, bool)
        self.runs: dict = {}

    def __getstate__(self):
        # rows and spelled are for the driver; a worker needs what is derived from them
        return {k: v for k, v in self.__dict__.items() if k not in ("_encoder", "rows", "spelled")} | {"runs": {}}

    def run(self, piece: str) -> list[tuple[float, str, str]]:
        """The merges that make a piece: the score of each, and the first and
        the last part before it; at the end no score and the piece itself."""
        if piece not in self.runs:
            parts, out = list(piece), []
            while len(parts) > 1:
                best, at = max(((self.rank.get(a + b, -np.inf), -i) for i, (a, b) in enumerate(zip(parts, parts[1:]))))
                out.append((best, parts[0], parts[-1]))
                parts[-at : 2 - at] = [parts[-at] + parts[1 - at]]
            self.runs[piece] = [*out, (-np.inf, piece, piece)]
        return self.runs[piece]

    def apart(self, left: str, right: str) -> bool:
        """Whether merging never joins a part of one piece with one of the
        other: the runs of both go on, best score first, and at no time may the
        parts at the border make a better piece (of equals, the leftmost goes first)."""
        a, b, i, j, rank = self.run(left), self.run(right), 0, 0, self.rank
        while True:
            here, there = a[i][0], b[j][0]
            across = rank.get(a[i][2] + b[j][1])
            if across is not None and across > here and across >= there:
                return False
            if here == there == -np.inf:
                return True
            if here >= there:
                i += 1
            else:
                j += 1

    def merge(self, text: str) -> list[str]:
        """Merge the best neighbours, leftmost first among equals, until none make a piece."""
        parts = list(text)
        while len(parts) > 1:
            best, at = max(((self.rank.get(a + b, -np.inf), -i) for i, (a, b) in enumerate(zip(parts, parts[1:]))))
            if best == -np.inf:
                break
            parts[-at : 2 - at] = [parts[-at] + parts[1 - at]]
        return parts

    def stay_apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether merging leaves each pair of piece ids as it is; unknown characters (-1) never merge."""
        keys = (left.astype(np.int64) + 1 << 32) + right + 1
        u, inverse = np.unique(keys, return_inverse=True)
        pos = np.searchsorted(self.pairs, u)
        known = np.zeros(len(u), bool)
        if len(self.pairs):
            known = self.pairs[np.minimum(pos, len(self.pairs) - 1)] == u
        new = u[~known]
        if len(new):
            passes = np.ones(len(new), bool)
            for i, k in enumerate(new.tolist()):
                a, b = (k >> 32) - 1, (k & 0xFFFFFFFF) - 1
                if a >= 0 and b >= 0:
                    passes[i] = self.apart(self.spelling[a], self.spelling[b])
            if len(self.pairs) + len(new) > PAIRS:  # a bound on memory
                self.pairs, self.passing = np.empty(0, np.int64), np.empty(0, bool)
                return self.stay_apart(left, right) if len(u) < PAIRS else np.array([self.stay_apart(left[i : i + 1], right[i : i + 1])[0] for i in range(len(left))])
            self.pairs, self.passing = np.insert(self.pairs, pos[~known], new), np.insert(self.passing, pos[~known], passes)
            pos = np.searchsorted(self.pairs, u)
        return self.passing[pos][inverse]


def load_pieces(path: str | None = None) -> Pieces:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path or default_path())
    rows, byte_ids, spelled = [], [0] * 256, []
    for i in range(sp.get_piece_size()):
        p = sp.id_to_piece(i)
        if sp.is_byte(i):
            byte_ids[int(p[3:5], 16)] = i
            spelled.append(bytes([int(p[3:5], 16)]))
        elif sp.is_control(i) or sp.is_unused(i):
            spelled.append(b"")
        elif sp.is_unknown(i):
            spelled.append(b" \xe2\x81\x87 ")
        else:
            rows.append((p, i, sp.get_score(i)))
            spelled.append(p.replace(BLANK, " ").encode())
    scores = [r[2] for r in rows]
    merging = all(s == int(s) for s in scores)  # ranks, not log-probabilities
    return Pieces(rows, byte_ids, spelled, min(scores) - 10, merging)


def _spell_hash(piece: str) -> int:
    h = np.uint64(0)
    with np.errstate(over="ignore"):
        for j, c in enumerate(piece):
            h += np.uint64(ord(c) + 1) * _R[j]
        return mix(np.array([h]))[0]


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[i], starts[i] + 1, ... counts[i] of them, for every i, end to end."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - counts), counts) + np.arange(total)


# -------------------------------------------------------- lattice in arrays
def lattice(units: list[str], table: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Best paths of some units: ids end to end, and how many each unit has."""
    lengths = np.array([len(u) for u in units], np.int32)
    points = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32)
    points = np.where(points == 32, ord(BLANK), points)
    base = np.cumsum(lengths, dtype=np.int32) - lengths  # of a unit's characters
    unit = np.repeat(np.arange(len(units), dtype=np.int32), lengths)
    last = (base + lengths)[unit]  # one past the unit's end
    # 1, 2: explode substrings by length and join them with the pieces
    found, h, start = [], np.zeros(len(points), np.uint64), np.arange(len(points), dtype=np.int32)
    for size in range(1, table.longest + 1):
        start = start[start + size <= last[start]]
        if not len(start):
            break
        h[start] += (points[start + size - 1].astype(np.uint64) + np.uint64(1)) * _R[size - 1]
        key = mix(h[start])
        near = np.flatnonzero(table.maybe[(key >> np.uint64(42)).astype(np.int64)])
        pos = np.minimum(np.searchsorted(table.keys, key[near]), len(table.keys) - 1)
        hit = table.keys[pos] == key[near]
        s = start[near[hit]]
        found.append((s, s + size, table.ids[pos[hit]], table.scores[pos[hit]]))
        if size == 1:
            none = np.setdiff1d(np.arange(len(points), dtype=np.int32), s, assume_unique=True)
            found.append((none, none + 1, np.full(len(none), -1, np.int32), np.full(len(none), table.unknown)))
    s, e, piece, score = (np.concatenate(x) for x in zip(*found))
    del found, h, last
    # 3: group by end within the unit; 4: fold
    owner = unit[s]
    depth = e - base[owner]
    o = np.lexsort((s, owner, depth))
    s, e, piece, score, owner, depth = s[o], e[o], piece[o], score[o], owner[o], depth[o]
    node = lambda p, u: p + u  # noqa: E731  a unit of n characters has n + 1 nodes
    best, back = np.zeros(len(points) + len(units)), np.zeros(len(points) + len(units), np.int64)
    into, out = node(e, owner), node(s, owner)
    cuts = np.flatnonzero(np.diff(depth, prepend=-1))
    for lo, hi in zip(cuts, np.append(cuts[1:], len(s))):
        total = best[out[lo:hi]] + score[lo:hi]
        if table.merging:
            inner = np.flatnonzero(s[lo:hi] > base[owner[lo:hi]])
            before = piece[back[out[lo:hi][inner]]]
            total[inner[~table.stay_apart(before, piece[lo:hi][inner])]] = -np.inf
        group = np.flatnonzero(np.diff(into[lo:hi], prepend=-1))
        top = np.maximum.reduceat(total, group)
        is_top = np.flatnonzero(total == np.repeat(top, np.diff(np.append(group, hi - lo))))
        first = is_top[np.flatnonzero(np.diff(into[lo:hi][is_top], prepend=-1))]
        best[into[lo:hi][first]], back[into[lo:hi][first]] = top, lo + first
    path, at, who = [], node(base + lengths, np.arange(len(units))), np.arange(len(units))
    while len(who):
        edge = back[at]
        path.append(edge)
        at = out[edge]
        more = s[edge] > base[who]
        at, who = at[more], who[more]
    path = np.concatenate(path)
    path = path[np.argsort(s[path], kind="stable")]  # units lie in order, so by start
    ids, times, owner = piece[path], np.ones(len(path), np.int64), owner[path]
    unknown = np.flatnonzero(ids < 0)
    if len(unknown):
        raw = [chr(c).encode("utf-8", "surrogateescape" if 0xDC80 <= c <= 0xDCFF else "surrogatepass") for c in points[s[path[unknown]]].tolist()]
        times[unknown] = [len(r) for r in raw]
        ids = np.repeat(ids, times)
        ids[ids < 0] = table.byte_id[np.frombuffer(b"".join(raw), np.uint8)]
    return ids, np.bincount(owner, times, len(units)).astype(np.int64)


class Encoder:
    """Encodes groups of texts; keeps the encodings of up to ``limit`` units."""

    def __init__(self, table: Pieces, limit: int = REMEMBERED):
        self.table, self.limit = table, limit
        self.keys = np.empty(0, np.uint64)
        self.at, self.n, self.flat = np.empty(0, np.int32), np.empty(0, np.int32), np.empty(0, np.int32)

    def group(self, rows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """ids of the texts end to end, and each text's number."""
        marked = [b" " + t.replace(BLANK.encode(), b" ") if t else b"" for t in rows]
        data = np.frombuffer(b"".join(marked), np.uint8)
        if not len(data):
            return np.empty(0, np.int32), np.zeros(len(rows), np.int64)
        lengths = np.array([len(t) for t in marked])
        first = np.cumsum(lengths) - lengths
        blank = data == 32
        begins = blank.copy()
        begins[1:] &= ~blank[:-1]
        begins[first[lengths > 0]] = True
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], len(data))
        u, where, inverse = np.unique(spans_hash(data, starts, ends, fold=False), return_index=True, return_inverse=True)
        pos = np.searchsorted(self.keys, u)
        hit = np.zeros(len(u), bool)
        if len(self.keys):
            hit = self.keys[np.minimum(pos, len(self.keys) - 1)] == u
        new = np.flatnonzero(~hit)
        flat, at, n = self.flat, np.empty(len(u), np.int64), np.empty(len(u), np.int64)
        at[hit], n[hit] = self.at[pos[hit]], self.n[pos[hit]]
        if len(new):
            raw = data.tobytes()
            a, z = starts[where[new]], ends[where[new]]
            ids, counts = [], []
            size, lo = np.cumsum(z - a), 0
            while lo < len(new):  # a lattice takes some 160 bytes for each of its units' bytes
                hi = max(lo + 1, int(np.searchsorted(size, (size[lo - 1] if lo else 0) + UNIT_BYTES, "right")))
                i, c = lattice([raw[x:y].decode("utf-8", "surrogateescape") for x, y in zip(a[lo:hi].tolist(), z[lo:hi].tolist())], self.table)
                ids.append(i)
                counts.append(c)
                lo = hi
            counts = np.concatenate(counts)
            at[new], n[new] = len(flat) + np.cumsum(counts) - counts, counts
            flat = np.concatenate([flat, *ids])
            if len(self.keys) + len(new) <= self.limit:
                # both are in order: put the new ones between
                self.keys, self.flat = np.insert(self.keys, pos[new], u[new]), flat
                self.at, self.n = np.insert(self.at, pos[new], at[new]), np.insert(self.n, pos[new], n[new])
        per_unit = n[inverse]
        owner = np.searchsorted(first, starts, "right") - 1
        return flat[_ranges(at[inverse], per_unit)], np.bincount(owner, per_unit, len(rows)).astype(np.int64)


def _encoded(batches, table: Pieces):
    """Row ids, piece ids end to end and their number per row, of groups of rows."""
    encoder = table.__dict__.setdefault("_encoder", Encoder(table))  # a worker's tasks share what it remembers
    for b in batches:
        i, text = b.columns
        for lo, hi in _cuts(pc.binary_length(text).fill_null(0).to_numpy(), GROUP_BYTES):
            yield i.slice(lo, hi - lo), *encoder.group(texts(text.slice(lo, hi - lo)))


def encode(docs: DataFrame, table: Pieces, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, ids (array of int)."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = with_id(docs, id_col, ("ids", "array<int>"))
    arrow, sent = to_arrow_schema(schema), docs.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        for i, ids, n in _encoded(batches, sent.value):
            yield batch_of(arrow, [i, pa.ListArray.from_arrays(pa.array(np.cumsum([0, *n]), pa.int32()), pa.array(ids, pa.int32()))])

    return id_and_text(docs, id_col, text_col).mapInArrow(lean(run), schema)


def spell(table: Pieces, ids: np.ndarray, n: np.ndarray) -> list[bytes]:
    """Texts of encodings that lie end to end."""
    size = table.at[ids + 1] - table.at[ids]
    raw = table.bytes_of[_ranges(table.at[ids], size)].tobytes()
    upto = np.concatenate(([0], np.cumsum(size)))[np.cumsum([0, *n])].tolist()
    return [raw[a + 1 if raw[a : a + 1] == b" " else a : z] for a, z in zip(upto[:-1], upto[1:])]


def decode(tokens: DataFrame, table: Pieces) -> DataFrame:
    """doc_id, ids and text (binary, UTF-8) of a table of doc_id and ids."""
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    tokens = tokens.select("doc_id", "ids")
    schema = T.StructType([*tokens.schema.fields, T.StructField("text", T.BinaryType())])
    arrow, sent = to_arrow_schema(schema), tokens.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        for b in batches:
            lists = b.column(1)
            n = np.array([len(x) if x is not None else 0 for x in lists]) if lists.null_count else np.diff(lists.offsets.to_numpy())
            flat, at = lists.flatten().to_numpy(), np.cumsum([0, *n])
            out = []
            for lo, hi in _cuts(n, 1 << 20):
                out += spell(sent.value, flat[at[lo] : at[hi]], n[lo:hi])
            yield batch_of(arrow, [b.column(0), lists, out])

    return tokens.mapInArrow(lean(run), schema)


def round_trip(docs: DataFrame, table: Pieces, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids, and text (binary, UTF-8) decoded from the ids, of every row
    of ``docs``: ``decode(encode(docs))`` in one pass, so that a task needs one worker."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = with_id(docs, id_col, ("ids", "array<int>"), ("text", "binary"))
    arrow, sent = to_arrow_schema(schema), docs.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        for i, ids, n in _encoded(batches, sent.value):
            out, at = [], np.cumsum([0, *n])
            for lo, hi in _cuts(n, 1 << 18):
                out += spell(sent.value, ids[at[lo] : at[hi]], n[lo:hi])
            yield batch_of(arrow, [i, pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32())), out])

    return id_and_text(docs, id_col, text_col).mapInArrow(lean(run), schema)


def _cuts(n: np.ndarray, size: int):
    lo, held = 0, 0
    for i, k in enumerate(n):
        held += k
        if held >= size or i == len(n) - 1:
            yield lo, i + 1
            lo, held = i + 1, 0


# --------------------------------------------- lattice in DataFrame functions
def piece_table(spark, table: Pieces) -> DataFrame:
    return spark.createDataFrame(table.rows, "piece string, id int, score double")


def encode_words(words: DataFrame, table: Pieces) -> DataFrame:
    """word, path (array of piece ids, -1 for an unknown character) of a table
    of distinct words (column ``word``, blanks written as U+2581)."""
    pieces, longest, unknown = piece_table(words.sparkSession, table), table.longest, table.unknown
    cut = "flatten(transform(sequence(1, length(word)), s -> transform(sequence(1, least({0}, length(word) - s + 1)), n -> struct(s - 1 AS s, s - 1 + n AS e, substring(word, s, n) AS piece))))"
    edges = words.where("length(word) > 0").select("word", F.explode(F.expr(cut.format(longest))).alias("x")).select("word", "x.*")
    edges = edges.join(pieces, "piece", "left").where("id IS NOT NULL OR e = s + 1")
    edges = edges.select("word", "e", "s", F.coalesce("score", F.lit(unknown)).alias("score"), F.coalesce("id", F.lit(-1)).alias("id"))
    if table.merging:  # the edges that may come before each
        sent = words.sparkSession.sparkContext.broadcast(table)

        @F.pandas_udf("boolean")
        def apart(left: pd.Series, right: pd.Series) -> pd.Series:
            return pd.Series(sent.value.stay_apart(left.to_numpy(), right.to_numpy()))

        before = edges.select("word", F.col("e").alias("s"), F.col("id").alias("left"))
        pairs = before.join(edges.select("word", "s", "id"), ["word", "s"]).select("left", "id").distinct().where(apart("left", "id"))
        allowed = before.join(edges, ["word", "s"]).join(pairs, ["left", "id"]).groupBy("word", "s", "e", "id").agg(F.collect_set("left").alias("after"))
        edges = edges.join(allowed, ["word", "s", "e", "id"], "left")
    else:
        edges = edges.withColumn("after", F.lit(None).cast("array<int>"))
    grouped = edges.groupBy("word").agg(F.sort_array(F.collect_list(F.struct("e", "s", "score", "id", "after"))).alias("edges"))
    kind = "struct<score:double,path:array<int>>"
    start = F.expr(f"transform(sequence(0, length(word)), i -> if(i = 0, cast(struct(0D, cast(array() AS array<int>)) AS {kind}), cast(null AS {kind})))")

    def better(nodes, edge):
        total = nodes[edge["s"]]["score"] + edge["score"]
        old = nodes[edge["e"]]["score"]
        new = F.struct(total.alias("score"), F.concat(nodes[edge["s"]]["path"], F.array(edge["id"])).alias("path"))
        passes = (edge["s"] == 0) | F.array_contains(edge["after"], F.element_at(nodes[edge["s"]]["path"], -1)) if table.merging else F.lit(True)
        return F.when(passes & total.isNotNull() & (old.isNull() | (total > old)), F.transform(nodes, lambda x, i: F.when(i == edge["e"], new).otherwise(x))).otherwise(nodes)

    return grouped.select("word", F.aggregate("edges", start, better, lambda nodes: F.element_at(nodes, -1)["path"]).alias("path"))
