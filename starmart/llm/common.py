"""Helpers shared by the corpus operators.

Text crosses into Python as UTF-8 bytes (a binary Arrow column), so a string
that is not valid UTF-8 never fails to decode, and A-Z lower-casing and the
splitting on white space are single C calls (``bytes.lower`` and
``bytes.split`` know ASCII only).
"""

from __future__ import annotations

import ctypes
import os
import shutil
import tempfile
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.session import discard, ensure_checkpoint_dir, materialize  # noqa: F401

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
WORD = r"[^\x20\x09-\x0D]+"
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


_SHIPPED: set = set()


def ship(spark) -> None:
    """Send this package to the executors, once per application, as
    ``--py-files`` would; needless where it is installed on them. Arrow batches
    are held to 1 MB, so that memory does not follow the texts' length: a batch is
    held several times over, by the worker and by the executor outside its heap."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(1 << 20))
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        name = __name__.split(".")[0]
        if os.path.isdir(os.path.join(root, name)):  # not when it already runs from an archive
            sc.addPyFile(shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix=f"{name}-"), name), "zip", root, name))
        _SHIPPED.add(sc.applicationId)


def documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_and_text(docs: DataFrame, id_col: str, text_col: str, *more) -> DataFrame:
    """``doc_id`` and ``text`` (binary) of ``docs`` under fixed names, so that
    other columns of the input, whatever their names, take no part."""
    ship(docs.sparkSession)
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").cast("binary").alias("text"), *more)


def with_id(docs: DataFrame, id_col: str, *fields: tuple) -> T.StructType:
    """Schema of a result: the id in its own type, then (name, type) pairs."""
    return T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), *(T.StructField(n, T._parse_datatype_string(t)) for n, t in fields)])


def lean(run):
    """A function for ``mapInArrow`` whose worker gives its free memory back at
    the end of a task: an idle worker keeps what malloc keeps."""
    def whole(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):  # not glibc
            pass
    return whole


def batch_of(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def texts(column: pa.Array) -> list[bytes]:
    """The column's values as bytes; null as the empty text."""
    return [t or b"" for t in column.to_pylist()]


# ------------------------------------------------------------ word hashing
_MUL = 0x9E3779B97F4A7C15  # odd, hence invertible modulo 2**64
_INV = pow(_MUL, -1, 2**64)
_BLOCK = 1 << 18


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """A random 64-bit value per byte, and which bytes are white space."""
    value = np.random.Generator(np.random.PCG64(20260101)).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    space = np.zeros(256, bool)
    space[[9, 10, 11, 12, 13, 32]] = True
    return value, space


@lru_cache(maxsize=1)
def _folded() -> np.ndarray:
    value = _tables()[0].copy()
    value[65:91] = value[97:123]
    return value


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _MUL, np.uint64), np.full(n, _INV, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def mix(h: np.ndarray) -> np.ndarray:
    """Finalising bit mixer of 64-bit hashes."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


def spans_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = True) -> np.ndarray:
    """64-bit hash of each span of bytes, with ``fold`` A-Z counting as a-z. Spans
    are in order and do not overlap; work goes in blocks, so memory follows the block."""
    value = _folded() if fold else _tables()[0]
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        lo = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, lo + _BLOCK, "right")))
        hi = ends[j - 1]
        up, down = _powers(_BLOCK if hi - lo <= _BLOCK else 1 << int(hi - lo).bit_length())
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(value[data[lo:hi]] * up[: hi - lo], out=sums[1:])
        out[i:j] = mix((sums[ends[i:j] - lo] - sums[starts[i:j] - lo]) * down[starts[i:j] - lo])
        i = j
    return out


def word_hashes(text: bytes) -> np.ndarray:
    """Hash of every word of a text, in order."""
    data = np.frombuffer(text, np.uint8)
    space = np.empty(len(data) + 2, bool)
    space[0] = space[-1] = True
    space[1:-1] = _tables()[1][data]
    edge = np.flatnonzero(space[1:] != space[:-1])
    return spans_hash(data, edge[0::2], edge[1::2])


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` words; of a shorter text, of the whole; none without words."""
    m = min(n, len(words))
    if m == 0:
        return np.empty(0, np.uint64)
    h = np.full(len(words) - m + 1, m, np.uint64)
    for j in range(m):
        h = h * np.uint64(0xD6E8FEB86659FD93) + words[j : len(words) - m + 1 + j]
    return mix(h)


def gram_sets(column: pa.Array, n: int, group_bytes: int = 1 << 18):
    """For each text of a binary column, the sorted distinct hashes of its
    n-word shingles. Neighbouring texts are hashed together, about
    ``group_bytes`` at a time (a longer text alone)."""
    rows, group, size = column.to_pylist(), [], 0
    for k, t in enumerate(rows):
        group.append(t or b"")
        size += len(group[-1])
        if size >= group_bytes or k == len(rows) - 1:
            data = np.frombuffer(b"\n".join(group), np.uint8)
            space = np.empty(len(data) + 2, bool)
            space[0] = space[-1] = True
            space[1:-1] = _tables()[1][data]
            edge = np.flatnonzero(space[1:] != space[:-1])
            words = spans_hash(data, edge[0::2], edge[1::2])
            cuts = np.searchsorted(edge[0::2], np.cumsum([len(t) + 1 for t in group]))
            at = 0
            for cut in cuts:
                g = np.sort(grams(words[at:cut], n))
                yield g[np.concatenate(([True], g[1:] != g[:-1]))] if len(g) > 1 else g
                at = cut
            group, size = [], 0


# ------------------------------------------------- filters of a fixed size
def id_filter(ids: DataFrame, column: str, log2_bits: int = 23) -> np.ndarray:
    """Bit set of the hashed values of ``column``: 2**log2_bits bits whatever
    the number of rows, so it may be broadcast. It holds every value and, the
    fuller it is, some others by chance: a later join has to confirm."""
    pos = id_position(F.col(column), log2_bits)
    rows = ids.select(pos.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits")).collect()
    bits = np.zeros(max(1 << (log2_bits - 3), 4096), np.uint8)
    for r in rows:
        at = (r["b"] - 1) * 4096
        bits[at : at + 4096] = np.frombuffer(r["bits"], np.uint8)
    return bits


def id_position(column, log2_bits: int = 23):
    """Position of a value in ``id_filter``, from 1."""
    return F.pmod(F.xxhash64(column), F.lit(1 << log2_bits)) + 1


def in_filter(bits: np.ndarray, position: np.ndarray) -> np.ndarray:
    p = position.astype(np.int64) - 1
    return (bits[p >> 3] >> (p & 7).astype(np.uint8)) & 1 == 1


def hash_filter(hashes: DataFrame, column: str, log2_bits: int) -> np.ndarray:
    """Bit set of the last ``log2_bits`` bits of a column of 64-bit hashes: of
    one size whatever their number, so it may be broadcast; the fuller it is, the
    more other hashes pass by chance."""
    pos = F.col(column).bitwiseAND(F.lit((1 << log2_bits) - 1)) + 1
    rows = hashes.select(pos.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits")).collect()
    bits = np.zeros(1 << (log2_bits - 3), np.uint8)
    for r in rows:
        bits[(r["b"] - 1) * 4096 : r["b"] * 4096] = np.frombuffer(r["bits"], np.uint8)
    return bits


def in_hash_filter(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    return in_filter(bits, (hashes & np.uint64(8 * len(bits) - 1)) + np.uint64(1))


def without(docs: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """The rows of ``docs`` whose id is not in ``ids`` (column ``doc_id``).
    Only rows that a filter of fixed size flags are shuffled to the anti-join."""
    ship(docs.sparkSession)
    filt = docs.sparkSession.sparkContext.broadcast(id_filter(ids, "doc_id"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("passed"), F.col(f"`{id_col}`").alias("doc_id"), id_position(F.col(f"`{id_col}`")).alias("p"))

    def flagged(wanted):
        def run(batches):
            for b in batches:
                yield b.filter(pa.array(in_filter(filt.value, b.column("p").to_numpy()) == wanted))
        return rows.mapInArrow(lean(run), rows.schema)

    near, gone = flagged(True).alias("n"), ids.select("doc_id").hint("merge").alias("g")
    left = flagged(False).unionByName(near.join(gone, F.col("n.doc_id").eqNullSafe(F.col("g.doc_id")), "left_anti"))
    return left.select(*[F.col("passed")[c].alias(c) for c in docs.columns])
