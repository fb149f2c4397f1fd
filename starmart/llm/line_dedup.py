"""Line de-duplication behind two Bloom filters.

A line's key is the line stripped of white space and lower-cased (A-Z). Keys of
at least ``min_chars`` code points found in at least ``min_docs`` documents lose
all their lines, except in the document with the largest id that holds them.

1. Every task hashes the keys of its documents to filter positions. Folding
   the tasks' positions gives two Bloom filters: once-seen, and twice-seen (a
   position that was already set). Only the second is kept; its size is fixed
   (2**log2_bits bits), whatever the number of lines, so it may be broadcast.
2. Only keys whose positions were all seen twice can repeat. These suspects are
   shuffled, as SHA-256 digests, and counted exactly; the confirmed keys and
   their last document give the lines to drop.
3. Rows that lose lines are found again by a filter of fixed size over the
   hash of their id and text; only they are joined with their dropped keys. All
   others are written straight from the scan. Dropped keys are gathered per id and
   text, so a list is never longer than its own text has lines, however many
   rows share an id or have none.

A full filter costs time, not correctness: every suspect is confirmed.

Null or empty text is one empty line. A null id is smaller than any other and
counts as one document. Rows that repeat an id are one document when documents
are counted, and each gives a row. White space is x20 and x09-x0D. Columns
other than id and text are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_of, id_and_text, id_filter, id_position, in_filter, lean, materialize, texts, with_id

MIN_CHARS, MIN_DOCS = 40, 5
LOG2_BITS, LOG2_CHUNK = 26, 18


def keys_of(text: bytes, min_chars: int) -> set[bytes]:
    """The distinct keys of a text that are long enough."""
    found = set()
    for line in text.split(b"\n"):
        if len(line) >= min_chars:
            key = line.strip()
            if len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode("utf-8", "replace")) >= min_chars):
                found.add(key.lower())
    return found


def _positions(key: bytes, log2_bits: int) -> tuple[int, int]:
    h = xxhash.xxh3_64_intdigest(key)
    return h >> (64 - log2_bits), h & ((1 << log2_bits) - 1)


def _emit_positions(min_chars: int, log2_bits: int, log2_chunk: int):
    def run(batches):
        for b in batches:
            found = [p for t in texts(b.column(1)) for k in keys_of(t, min_chars) for p in set(_positions(k, log2_bits))]
            pos = np.sort(np.array(found, np.int64))
            chunk = pos >> log2_chunk
            cuts = np.flatnonzero(np.diff(chunk, prepend=-1, append=-1))
            inside = (pos & ((1 << log2_chunk) - 1)).astype(np.uint32)
            at = list(zip(cuts[:-1], cuts[1:]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(chunk[i]) for i, _ in at], pa.int32()), pa.array([inside[i:j].tobytes() for i, j in at], pa.binary())], names=["chunk", "positions"])
    return run


def _fold(log2_chunk: int):
    """Both filters of each chunk, updated by one task's positions at a time."""
    def run(batches):
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for b in batches:
            for chunk, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                once, twice = held.setdefault(chunk, (np.zeros(1 << log2_chunk, bool), np.zeros(1 << log2_chunk, bool)))
                pos = np.frombuffer(raw, np.uint32)
                twice[pos[1:][pos[1:] == pos[:-1]]] = True
                twice[pos[once[pos]]] = True
                once[pos] = True
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.int32()), pa.array([np.packbits(t, bitorder="little").tobytes() for _, t in held.values()], pa.binary())], names=["chunk", "bits"])
    return run


def twice_seen(rows: DataFrame, min_chars: int, log2_bits: int = LOG2_BITS, log2_chunk: int = LOG2_CHUNK) -> np.ndarray:
    """The twice-seen filter, 2**(log2_bits - 3) bytes."""
    parts = rows.mapInArrow(lean(_emit_positions(min_chars, log2_bits, log2_chunk)), "chunk int, positions binary").repartition(F.col("chunk"))
    bits = np.zeros(1 << (log2_bits - 3), np.uint8)
    step = 1 << (log2_chunk - 3)
    for r in parts.mapInArrow(lean(_fold(log2_chunk)), "chunk int, bits binary").collect():
        bits[r["chunk"] * step : (r["chunk"] + 1) * step] = np.frombuffer(r["bits"], np.uint8)
    return bits


def _suspects(schema, filt, min_chars: int, log2_bits: int):
    """Columns of the batches: doc_id, text, mark."""
    def run(batches):
        bits = filt.value
        for b in batches:
            rows, digests = [], []
            for i, t in enumerate(texts(b.column(1))):
                for k in keys_of(t, min_chars):
                    if all(bits[p >> 3] >> (p & 7) & 1 for p in _positions(k, log2_bits)):
                        rows.append(i)
                        digests.append(hashlib.sha256(k).digest())
            at = pa.array(rows, pa.int64())
            yield batch_of(schema, [b.column(0).take(at), b.column(2).take(at), digests])
    return run


def split_kept(text: bytes, drop: set[bytes], min_chars: int) -> tuple[int, int, bytes]:
    """Lines, dropped lines and what stays of a text."""
    lines = text.split(b"\n")
    if not drop:
        return len(lines), 0, text
    kept = [x for x in lines if len(x) < min_chars or hashlib.sha256(x.strip().lower()).digest() not in drop]
    return len(lines), len(lines) - len(kept), b"\n".join(kept)


def _flagged(filt):
    def run(batches):
        for b in batches:
            yield b.filter(pa.array(in_filter(filt.value, b.column("p").to_numpy())))
    return run


def _results(schema, min_chars: int, filt=None):
    """Columns of the batches: p, text, the dropped keys, and what is passed on.
    With a filter, of the rows that it does not flag, which lose nothing."""
    def run(batches):
        for b in batches:
            if filt is not None:
                b = b.filter(pa.array(~in_filter(filt.value, b.column("p").to_numpy())))
            out = [split_kept(t, set(d or ()), min_chars) for t, d in zip(texts(b.column("text")), b.column("drop").to_pylist())]
            yield batch_of(schema, [b.column("passed"), [o[0] for o in out], [o[1] for o in out], [o[2] for o in out]])
    return run


def _dedup(rows: DataFrame, min_chars: int, min_docs: int, log2_bits: int, log2_chunk: int) -> DataFrame:
    """passed, n_lines, n_dropped, kept_text of rows of doc_id, text, passed."""
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    sc = rows.sparkSession.sparkContext
    mark = F.xxhash64("doc_id", "text")
    plain, key = rows.select("doc_id", "text", mark.alias("mark")), rows.schema["doc_id"]
    log2_chunk = min(log2_chunk, log2_bits)
    repeats = sc.broadcast(twice_seen(plain.select("doc_id", "text"), min_chars, log2_bits, log2_chunk))
    pair = T.StructType([key, T.StructField("mark", T.LongType()), T.StructField("digest", T.BinaryType())])
    suspects = materialize(plain.mapInArrow(lean(_suspects(to_arrow_schema(pair), repeats, min_chars, log2_bits)), pair))
    confirmed = suspects.groupBy("digest").agg(F.count_distinct(F.struct("doc_id")).alias("n"), F.max("doc_id").alias("last")).where(F.col("n") >= min_docs)
    # Written first, so that the join deals out both sides anew and a hot key can be split.
    drops = suspects.join(materialize(confirmed), "digest").where(F.col("doc_id").isNull() | (F.col("doc_id") < F.col("last")))
    # Two texts of one mark have one id, and what an id loses does not depend on the text.
    drops = materialize(drops.groupBy("mark").agg(F.collect_set("digest").alias("drop")))
    repeats.unpersist()

    losing = sc.broadcast(id_filter(drops, "mark"))
    rows = rows.select("text", mark.alias("mark"), id_position(mark).alias("p"), "passed")
    out = T.StructType([rows.schema["passed"], T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()), T.StructField("kept_text", T.BinaryType())])
    arrow = to_arrow_schema(out)
    nothing = F.lit(None).cast("array<binary>").alias("drop")
    whole = rows.select("p", "text", nothing, "passed").mapInArrow(lean(_results(arrow, min_chars, losing)), out)
    # Sorted and merged at every size: a plan that broadcasts a small side says little about a large one.
    cut = rows.mapInArrow(lean(_flagged(losing)), rows.schema).join(drops.hint("merge"), "mark", "left")
    return whole.unionByName(cut.select("p", "text", "drop", "passed").mapInArrow(lean(_results(arrow, min_chars)), out))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
               log2_bits: int = LOG2_BITS, log2_chunk: int = LOG2_CHUNK) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_dropped, kept_text (binary, UTF-8)."""
    rows = id_and_text(docs, id_col, text_col, F.col(f"`{id_col}`").alias("passed"))
    return _dedup(rows, min_chars, min_docs, log2_bits, log2_chunk).withColumnRenamed("passed", "doc_id")


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars", min_chars: int = MIN_CHARS,
                        min_docs: int = MIN_DOCS, log2_bits: int = LOG2_BITS, log2_chunk: int = LOG2_CHUNK) -> DataFrame:
    """``docs``, all columns, with the text that stays (and its length in
    ``chars_col``, where there is one). A text without dropped lines is untouched, also a null."""
    rows = id_and_text(docs, id_col, text_col, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("passed"))
    out = _dedup(rows, min_chars, min_docs, log2_bits, log2_chunk)
    text = F.when(F.col("n_dropped") > 0, F.col("kept_text").cast("string")).otherwise(F.col("passed")[text_col])
    now = {text_col: text}
    if chars_col in docs.columns:
        now[chars_col] = F.when(F.col("n_dropped") > 0, F.length(text).cast(docs.schema[chars_col].dataType)).otherwise(F.col("passed")[chars_col])
    return out.select(*[now.get(c, F.col("passed")[c]).alias(c) for c in docs.columns])


SQL = r"""
WITH r AS (SELECT row_number() OVER () AS row, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT row, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM r),
k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) + max(CASE WHEN doc_id IS NULL THEN 1 ELSE 0 END) >= 5),
m AS (SELECT k.*, c.key IS NOT NULL AND (k.doc_id IS NULL OR k.doc_id < c.last) AS dropped FROM k LEFT JOIN c USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM m GROUP BY row, doc_id"""
