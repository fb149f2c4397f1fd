"""The hourly batch as a Structured Streaming query.

The order feed (new orders with their items, e.g. purchase events landing
as files) is the stream; ``foreachBatch`` hands every micro-batch to
``run_staged``, which reads the warehouse's dimensions and commits the batch.
Users and products are not read: they reach the warehouse through the hourly
``run_batch``, so a micro-batch keeps the watermark as it is.

Delivery is at-least-once: after a crash the last micro-batch may be
replayed. A replay is harmless twice over - the batch id is derived from
the query id and the micro-batch id, so a replay of a committed micro-batch
is skipped, and the fact load itself only inserts rows whose key is not in
the fact table yet.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.plans.batch import BatchResult, run_staged
from starmart.plans.warehouse import Warehouse, run_succeeded
from starmart.sources.testdata import purchases_as_orders

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])


def split_feed(feed: DataFrame) -> dict[str, DataFrame]:
    """One feed row = one order line: stage the orders and their items."""
    orders = feed.select(
        "order_id", "user_id", "order_date",
        (F.col("quantity") * F.col("price")).cast("decimal(12,2)").alias("total_amount"),
        "status", "last_updated",
    )
    items = feed.select("order_item_id", "order_id", "product_id", "quantity", "price")
    return {"orders": orders, "order_items": items}


def already_committed(wh: Warehouse, batch_id: str) -> bool:
    return not wh.log().where((F.col("batch_id") == batch_id) & run_succeeded()).isEmpty()


def load_micro_batch(spark: SparkSession, root: str, feed: DataFrame, batch_id: str,
                     run_ts: dt.datetime | None = None) -> BatchResult | None:
    """Commit one micro-batch of the feed (``None`` when it was committed
    before, i.e. this is a replay)."""
    wh = Warehouse(spark, root)
    if already_committed(wh, batch_id):
        return None
    return run_staged(spark, wh, split_feed(feed), run_ts=run_ts, batch_id=batch_id, keep_watermark=True)


def start_feed_stream(spark: SparkSession, landing_dir: str, root: str, checkpoint_dir: str,
                      query_name: str = "orders_feed", every: str = "1 hour", available_now: bool = False,
                      max_files_per_trigger: int | None = None, run_ts=None, after_commit=None):
    """Start the hourly load over raw event files landing in
    ``landing_dir``. ``available_now=True`` processes what is there and
    stops (for catch-up runs and tests); otherwise it triggers ``every``.
    ``after_commit(epoch, result)`` is called once the warehouse holds a
    micro-batch and before the checkpoint knows; ``result`` is ``None`` for a replay."""
    reader = spark.readStream.schema(EVENTS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    feed = purchases_as_orders(reader.parquet(landing_dir))

    def each(batch: DataFrame, epoch_id: int) -> None:
        result = load_micro_batch(batch.sparkSession, root, batch, f"{query_name}:{epoch_id}", run_ts=run_ts)
        if after_commit:
            after_commit(epoch_id, result)

    writer = feed.writeStream.queryName(query_name).option("checkpointLocation", checkpoint_dir).foreachBatch(each)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)
    return writer.start()

