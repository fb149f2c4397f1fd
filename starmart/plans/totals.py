"""D8 kept up to date: order totals as a table of upserts, merged on read.

``refresh_order_totals`` recomputes every order. Here the first batch writes
the total of every order that has items, and a later batch those of its staged
orders only (an order whose items are all gone gets a NULL total); per order
the latest batch wins. Items reach a batch with their whole order
(``extract.children_of``), so an order's total is always that of all its items.
``fold`` writes the current totals as a new base, after which earlier batches
are no longer read.

Layout: ``order_totals/batch_seq=N``, and ``order_totals_base/batch_seq=N`` of
every fold, written last; batches before the latest fold are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.functions import money
from starmart.operators.dims import latest_rows
from starmart.operators.maintain import order_totals
from starmart.plans.warehouse import PART, Warehouse
from starmart.schemas import empty

TOTALS = T.StructType([T.StructField("order_id", T.LongType()), T.StructField("amt", T.DecimalType(38, 2))])


class OrderTotals:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.wh = spark, Warehouse(spark, root)

    def write(self, seq: int, items: DataFrame, orders: DataFrame | None = None) -> int:
        """Totals of batch ``seq``: of all items for the first (``orders`` is
        None), else of the staged ``orders`` with their staged ``items``.
        Returns the number of rows written."""
        totals = order_totals(items)
        if orders is not None:
            totals = orders.select("order_id").join(totals, "order_id", "left")
        return self.wh.write(totals.select("order_id", F.col("amt").cast("decimal(38,2)").alias("amt")), "order_totals", seq)["rows"]

    def fold(self, seq: int) -> None:
        """Current totals as batch ``seq``, which stands for all before it."""
        self.wh.write(self.current().where("amt IS NOT NULL"), "order_totals", seq)
        base = self.spark.createDataFrame([(seq,)], "base int")
        self.wh.write(base, "order_totals_base", seq, files=1)

    def current(self) -> DataFrame:
        """(order_id, amt) of every order that ever had items."""
        folds = self.wh._batches("order_totals_base")
        live = [b for b in self.wh._batches("order_totals") if not folds or b >= folds[-1]]
        if not live:
            return empty(self.spark, TOTALS)
        base = self.wh.read("order_totals", TOTALS, live[:1]).drop(PART)
        return latest_rows(base, self.wh.read("order_totals", TOTALS, live[1:]), "order_id") if live[1:] else base

    def apply(self, orders: DataFrame) -> DataFrame:
        """``UPDATE orders JOIN totals SET total_amount = amt``; orders without items keep theirs."""
        j = orders.join(self.current(), "order_id", "left")
        return j.withColumn("total_amount", F.coalesce(money("amt"), F.col("total_amount"))).select(*orders.columns)
