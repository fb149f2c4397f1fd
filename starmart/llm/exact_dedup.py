"""Exact de-duplication with a heavy-hitter split.

Texts are equal when identical after lower-casing A-Z. One pass writes each
row's SHA-256 digest. A Misra-Gries summary of ``k`` counters per task finds
every digest that may hold more than 1/(k+1) of a task's rows; the merged
summary is verified by an exact count. The winners (at most ``k`` rows, which
bounds the broadcast) settle their groups in a map-side join, so a group that
holds a third of all rows is never shuffled. Every other digest holds few rows
and takes an ordinary shuffle.

Null text counts as empty. Of equal texts the row with the largest id stays; a
null id is smaller than any other; of repeated rows (same text and id) exactly
one stays. An empty table gives an empty result. Columns other than id and
text are ignored, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batch_of, id_and_text, lean, materialize, texts, with_id

COUNTERS = 1024


def _digests(schema):
    def run(batches):
        for b in batches:
            yield batch_of(schema, [b.column(0), [hashlib.sha256(t.lower()).digest() for t in texts(b.column(1))]])
    return run


def misra_gries(counts: Counter, k: int) -> Counter:
    """Keep at most ``k`` counters: subtract the (k+1)-th largest from all.
    Applied to a sum of summaries it is their merge."""
    if len(counts) <= k:
        return counts
    cut = sorted(counts.values(), reverse=True)[k]
    return Counter({key: n - cut for key, n in counts.items() if n > cut})


def _summaries(k: int):
    def run(batches):
        held: Counter = Counter()
        for b in batches:
            held.update(b.column(0).to_pylist())
            held = misra_gries(held, k)
        rows = [(d, n) for d, n in held.items() if n > 1]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int64())], names=["digest", "n"])
    return run


def heavy_digests(digests: DataFrame, k: int = COUNTERS) -> DataFrame:
    """At most ``k`` digests: the merge of the tasks' summaries."""
    parts = digests.select("digest").mapInArrow(lean(_summaries(k)), "digest binary, n long")
    return parts.groupBy("digest").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "digest").limit(k).select("digest")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = COUNTERS) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = with_id(docs, id_col, ("digest", "binary"))
    digests = id_and_text(docs, id_col, text_col).mapInArrow(lean(_digests(to_arrow_schema(schema))), schema)
    digests = materialize(digests.withColumn("row", F.monotonically_increasing_id()))
    last = F.max(F.struct("doc_id", "row")).alias("last")
    heavy = digests.join(F.broadcast(heavy_digests(digests, k)), "digest", "left_semi").groupBy("digest").agg(last, F.count("*").alias("group_size"))
    heavy = materialize(heavy)  # at most k rows, counted exactly
    settled = digests.join(F.broadcast(heavy), "digest")
    rest = digests.join(F.broadcast(heavy.select("digest")), "digest", "left_anti")
    w = Window.partitionBy("digest")
    rest = rest.withColumns({"last": F.max(F.struct("doc_id", "row")).over(w), "group_size": F.count("*").over(w)})
    return settled.unionByName(rest).select(
        "doc_id", F.col("last.doc_id").alias("keep_id"), "group_size", (F.col("last.row") == F.col("row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


SQL = """
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)"""
