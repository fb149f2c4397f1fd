"""Q1 kept up to date: uniqueness of a batch's keys against all that is loaded.

Recounting a key over the whole fact per batch reads everything. A
``KeyFilter`` keeps a Bloom filter of the loaded keys as a table of bitmaps,
one row of 4 KB per cell block, cut by the key's hash: it grows with ``keys``
and is never gathered. A batch joins its keys to the blocks they fall in and
tests one bit each; only keys whose bit is set are suspects. Suspects are
confirmed against the loaded table itself, whose scan gets the intervals of
their first key column as pushed filters and is left out when there are none.
Keys that occur twice within the batch are found by its own aggregate. No
duplicate is lost: a filter has no false negatives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.operators.extract import key_intervals, within
from starmart.session import materialize

BLOCK_BITS = 32768       # of one bitmap of Spark's bitmap functions
BITS_PER_KEY = 16        # cells per expected key: about 6 % of new keys are suspects when full


def _cell(keys: list[str], blocks: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(blocks * BLOCK_BITS))


class KeyFilter:
    """``blocks`` = bitmaps of the filter; ``bitmaps`` is the table (block, bits)."""

    def __init__(self, keys: list[str], expected_keys: int, bitmaps: DataFrame | None = None):
        self.keys, self.expected = list(keys), expected_keys
        self.blocks = max(1, -(-expected_keys * BITS_PER_KEY // BLOCK_BITS))
        self.bitmaps = bitmaps

    def add(self, rows: DataFrame) -> KeyFilter:
        """The filter with the keys of ``rows`` as well; its bitmaps are written."""
        cell = _cell(self.keys, self.blocks)
        new = rows.select(F.floor(cell / BLOCK_BITS).alias("block"), F.pmod(cell, F.lit(BLOCK_BITS)).alias("at"))
        new = new.groupBy("block").agg(F.bitmap_construct_agg("at").alias("bits"))
        if self.bitmaps is not None:
            new = self.bitmaps.unionByName(new).groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits"))
        return KeyFilter(self.keys, self.expected, materialize(new))

    def suspects(self, rows: DataFrame) -> DataFrame:
        """Distinct keys of ``rows`` whose bit is set."""
        cell = _cell(self.keys, self.blocks)
        asked = rows.select(*self.keys).distinct().select(*self.keys, F.floor(cell / BLOCK_BITS).alias("block"), F.pmod(cell, F.lit(BLOCK_BITS)).alias("at"))
        byte = F.conv(F.hex(F.substring("bits", (F.floor(F.col("at") / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        hit = F.getbit(byte, F.pmod("at", F.lit(8)).cast("int")) == 1
        return asked.join(self.bitmaps, "block").where(hit).select(*self.keys)

    def duplicates(self, batch: DataFrame, loaded: DataFrame) -> DataFrame:
        """Keys of the batch that more than one row holds, in the batch or with
        ``loaded`` together, and the number ``n`` of those rows. ``loaded`` is read for suspects only."""
        batch = batch.dropna(subset=self.keys)  # as with a UNIQUE constraint, NULLs are no duplicates
        suspects = materialize(self.suspects(batch))
        ids = key_intervals(suspects, self.keys[0])
        held = batch.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("n"))
        if ids:
            before = loaded.where(within(self.keys[0], ids)).join(suspects, self.keys, "left_semi").groupBy(*self.keys).agg(F.count(F.lit(1)).alias("before"))
            held = held.join(before, self.keys, "left").select(*self.keys, (F.col("n") + F.coalesce("before", F.lit(0))).alias("n"))
        return held.where("n > 1")
