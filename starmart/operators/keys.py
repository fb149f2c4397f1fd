"""K1: surrogate key assignment (AUTO_INCREMENT semantics).

New rows get ``base + 1, base + 2, ...`` in natural-key order, where
``base`` is the largest key already handed out; existing keys never change.

A global ``row_number() OVER (ORDER BY nk)`` would pull every row into one
task. Instead one range partitioning of the whole key deals the rows to ordered
partitions, each sorts its own, and the rows are written with their partition
and their place in it. The written table is then read twice: for the size of
every partition, whose running sum is its offset, and for the rows. Only that
running sum runs in a single task, over one row per partition, however the keys
are spread: dense, far apart, or with a first column that a third of the rows share.
The offsets, one row per partition too, are broadcast: the rows are shuffled once.
The numbers are fixed once written; task retries and lost executors cannot
change them. The plan is the same for every key and number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_GROUP, _PLACE, _OF, _BEFORE = "_k1_group", "_k1_place", "_k1_of", "_k1_before"
# monotonically_increasing_id: the partition above these bits, the row's place in it below.
_PLACE_BITS = 33


def max_key(df: DataFrame, key_col: str) -> Column:
    """Largest key in ``df`` (0 when empty) as a scalar-subquery column."""
    return df.agg(F.coalesce(F.max(key_col), F.lit(0)).cast("long")).scalar()


def assign_surrogate_keys(df: DataFrame, natural_key: list[str], key_col: str,
                          base: Column | int = 0, num_partitions: int | None = None, keep: list | None = None) -> DataFrame:
    """Add ``key_col`` = ``base`` + dense 1-based rank of ``natural_key``.

    ``natural_key`` must be unique in ``df`` (staging is validated for it);
    ``base`` is an int or a scalar column such as ``max_key(existing, key)``.
    ``keep`` lists the columns (or expressions) to return beside the key, when
    not all are wanted: the others are not written.
    """
    from starmart.session import materialize

    base_col = F.lit(base) if isinstance(base, int) else base
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = df.repartitionByRange(n, *natural_key).sortWithinPartitions(*natural_key)
    at = F.monotonically_increasing_id()
    rows = materialize(ordered.select(*(df.columns if keep is None else keep), F.shiftright(at, _PLACE_BITS).alias(_GROUP),
                                      at.bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).alias(_PLACE)), compression="zstd")
    sizes = rows.groupBy(_GROUP).agg(F.max(_PLACE).alias(_PLACE))
    before = Window.orderBy(_GROUP).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col(_GROUP).alias(_OF), F.coalesce(F.sum(F.col(_PLACE) + 1).over(before), F.lit(0)).alias(_BEFORE))
    keyed = rows.join(F.broadcast(offsets), F.col(_GROUP) == F.col(_OF))
    return keyed.withColumn(key_col, (base_col + F.col(_BEFORE) + F.col(_PLACE) + 1).cast("long")).drop(_GROUP, _PLACE, _OF, _BEFORE)
