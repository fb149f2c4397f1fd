"""Compaction of the append-only tables.

Hourly batches leave one partition per batch in ``fact_sales``,
``dim_customer_versions``, ``dim_customer_closed``, ``dim_date`` and
``dim_product``: many
small files, and a growing
list of directories every read must enumerate. ``compact`` rewrites the
dimensions' current content, and the facts and closed versions added since the
last compaction, into one new partition, as a committed
batch of its own; readers then skip every batch it covers. The log, which has a
partition per batch as the commit marker, is folded into one table of all rows so
far, so a reader opens that and the partitions since. Nothing is
overwritten, so a reader of the previous state is unaffected, and the
superseded partitions can be removed by storage retention afterwards
(``superseded_paths``). Run it while no batch is running (single writer).
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from starmart import schemas
from starmart.operators.extract import high_watermark
from starmart.plans.batch import BatchResult, _log_rows, _max_id, parallel
from starmart.plans.warehouse import COMPACTION, KEY_STATE, PART, RUN, SUCCESS, Warehouse

APPEND_ONLY = ("fact_sales", "dim_customer_versions", "dim_customer_closed", "dim_date", "dim_product")
ROWS_PER_FILE = 5_000_000


def _files(rows: int, rows_per_file: int) -> int:
    return max(1, -(-rows // rows_per_file))


def compact(spark: SparkSession, root: str, rows_per_file: int = ROWS_PER_FILE,
            batch_id: str | None = None) -> BatchResult | None:
    wh = Warehouse(spark, root)
    snap = wh.snapshot()
    if not snap.committed:
        return None
    seq, through = wh.next_seq(), snap.seq
    # The log rows of a compaction keep the current watermark: compaction
    # extracts nothing and must not move it.
    watermark = high_watermark(snap.etl_log).first()[0]
    comps = wh.compactions(snap.committed)

    def recent(table, schema, partition_cols=(PART,)):
        return wh.read(table, schema, wh.since_compaction(table, snap.committed, comps), partition_cols).drop(PART)

    # Facts and closed versions are only ever added to: fold what came since
    # the last compaction, and leave what it wrote.
    new_facts = recent("fact_sales", schemas.FACT_SALES, (PART, "sales_year"))
    new_closed = recent("dim_customer_closed", schemas.DIM_CUSTOMER)
    n_fact, n_closed, n_active, n_products = parallel(
        new_facts.count, new_closed.count, snap.dim_customer_active.count, snap.dim_product.count)

    # Range keys end in a unique id, so even a day holding a third of all
    # facts is spread over many output files.
    fact = (new_facts.repartitionByRange(_files(n_fact, rows_per_file), "sales_year", "date_key", "sale_id")
            .sortWithinPartitions("sales_year", "date_key", "sale_id"))
    closed = (new_closed.repartitionByRange(_files(n_closed, rows_per_file), "customer_key")
              .sortWithinPartitions("customer_key"))
    # The active set becomes the new base of the opened versions.
    active = (snap.dim_customer_active.repartitionByRange(_files(n_active, rows_per_file), "customer_key")
              .sortWithinPartitions("customer_key"))
    parallel(
        lambda: wh.write(fact, "fact_sales", seq, partition_by=["sales_year"]),
        lambda: wh.write(closed, "dim_customer_closed", seq),
        lambda: wh.write(active, "dim_customer_versions", seq),
        lambda: wh.write(snap.dim_product.repartitionByRange(_files(n_products, rows_per_file), "product_id"),
                         "dim_product", seq),
        lambda: wh.write(snap.dim_date, "dim_date", seq, files=1),
    )
    folded = wh.log().where(F.col(PART) < seq).withColumnRenamed(PART, "of_batch")
    wh.write(folded, "etl_log_fold", seq, files=_files(len(snap.committed) * 5, rows_per_file))
    entries = spark.createDataFrame([(t, through) for t in APPEND_ONLY], COMPACTION)
    keys = spark.createDataFrame(list(snap.max_keys.items()), KEY_STATE)
    parallel(lambda: wh.write(entries, "compaction", seq, files=1),
             lambda: wh.write(keys, "key_state", seq, files=1))
    batch_id = batch_id or str(uuid.uuid4())
    rows = [("COMPACT", n_fact, SUCCESS, f"Compacted batches up to {through}"),
            (RUN, 1, SUCCESS, "Compaction completed")]
    base_etl = _max_id(snap.etl_log, "etl_id")
    wh.write(_log_rows(spark, wh, seq, batch_id, rows, watermark, base_etl), "etl_log", seq, files=1)
    return BatchResult(seq, batch_id, SUCCESS, {"COMPACT": n_fact, RUN: 1})


def superseded_paths(spark: SparkSession, root: str) -> list[str]:
    """Partitions of append-only tables that the latest compactions cover
    (no reader of the current state opens them)."""
    wh = Warehouse(spark, root)
    committed = wh.committed_batches()
    comps = wh.compactions(committed)
    out = []
    for table in comps:
        live = set(wh.live(table, committed, comps))
        out += [wh.path(table, b) for b in wh._batches(table) if b <= comps[table][-1][1] and b not in live]
    folds = [b for b in wh._batches("etl_log_fold") if b in committed]
    if folds:
        out += [wh.path("etl_log", b) for b in wh._batches("etl_log") if b < folds[-1]] + [wh.path("etl_log_fold", b) for b in folds[:-1]]
    return sorted(out)

