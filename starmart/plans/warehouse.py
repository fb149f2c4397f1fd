"""The on-disk warehouse and its commit protocol.

Layout under ``root`` (every table is parquet, partitioned by ``batch_seq``):

    staging/<source>/batch_seq=N          staged rows of batch N (lineage cut)
    dim_date/batch_seq=N                  dates first seen by batch N (append-only)
    dim_product/batch_seq=N               products upserted by batch N (merge-on-read)
    dim_customer_versions/batch_seq=N     customer versions opened by batch N (append-only)
    dim_customer_closed/batch_seq=N       versions closed by batch N (append-only)
    fact_sales/batch_seq=N/sales_year=Y   facts inserted by batch N
    key_state/batch_seq=N                 (table_name, max_key) after batch N
    etl_error_log/batch_seq=N             error rows of a failed batch N
    etl_log/batch_seq=N                   log rows of batch N, written last
    etl_log_fold/batch_seq=N              log rows of all batches before compaction N
    compaction/batch_seq=N                (table_name, covers_through) of a compaction

A batch is committed when its ``etl_log`` partition holds the RUN/SUCCESS
row; that single small write is the commit point. Readers see, of each
snapshot table, the partition of the latest committed batch that wrote one,
and of each append-only table the partitions of all committed batches; a
failed or half-written batch is invisible and a retry never overwrites a
path a reader may be using. A batch with no staged users or products does
not rewrite those dimensions. The product dimension is merge-on-read: a
batch appends the rows it upserts; the oldest live partition is the base,
and per product the latest upsert wins. The customer dimension is
merge-on-read too:
a batch appends only the versions it opens and the rows it closes, and the
active set is read as the opened versions minus the closed keys - an hourly
batch writes what changed, never the whole dimension. A compaction
(``plans.compaction``) rewrites the append-only tables of all committed
batches into one partition of its own (the active set becomes the new base
of ``dim_customer_versions``); readers then skip the batches it covers.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart import schemas

SUCCESS, FAILED = "SUCCESS", "FAILED"
RUN = "RUN"
PART = "batch_seq"


class Snapshot(NamedTuple):
    seq: int                   # latest committed batch (0 = empty warehouse)
    committed: list[int]       # all committed batch numbers
    dim_date: DataFrame
    dim_product: DataFrame
    dim_customer_active: DataFrame
    dim_customer: DataFrame    # all versions
    fact_sales: DataFrame      # with sales_year
    etl_log: DataFrame
    etl_error_log: DataFrame
    max_keys: dict             # table_name -> max key handed out
    dim_customer_closed: DataFrame | None = None  # closed versions only


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # ------------------------------------------------------------ paths / io
    def path(self, table: str, seq: int | None = None) -> str:
        p = f"{self.root}/{table}"
        return p if seq is None else f"{p}/{PART}={seq}"

    def _exists(self, table: str) -> bool:
        jvm = self.spark.sparkContext._jvm
        jpath = jvm.org.apache.hadoop.fs.Path(self.path(table))
        fs = jpath.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return fs.exists(jpath)

    def _batches(self, table: str) -> list[int]:
        """Batch numbers that have a partition directory for ``table``."""
        if not self._exists(table):
            return []
        jvm = self.spark.sparkContext._jvm
        jpath = jvm.org.apache.hadoop.fs.Path(self.path(table))
        fs = jpath.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        out = []
        for st in fs.listStatus(jpath):
            name = st.getPath().getName()
            if st.isDirectory() and name.startswith(f"{PART}="):
                out.append(int(name.split("=", 1)[1]))
        return sorted(out)

    def read(self, table: str, schema, seqs: list[int] | None = None,
             partition_cols: tuple = (PART,)) -> DataFrame:
        """Partitions ``seqs`` of ``table`` (all when None) with the declared
        schema plus the partition columns. One listing of the table finds
        those that exist; only their directories are opened."""
        full = T.StructType(schema.fields + [T.StructField(c, T.IntegerType()) for c in partition_cols])
        have = self._batches(table)
        live = have if seqs is None else sorted(set(seqs) & set(have))
        if not live:
            return schemas.empty(self.spark, full)
        return self.spark.read.schema(full).option("basePath", self.path(table)).parquet(*[self.path(table, b) for b in live])

    def write(self, df: DataFrame, table: str, seq: int, partition_by: list[str] | None = None,
              files: int | None = None, counting: dict | None = None) -> dict:
        """Write batch ``seq`` of ``table`` (overwrites only that batch's own
        partition, so a retry of the batch is harmless). Returns what the write
        itself observed: the number of ``rows``, and of those that meet the
        conditions in ``counting`` (name -> column)."""
        if files:
            # A shuffle: only the rows of the result reach the writing task.
            df = df.repartition(files)
        seen = Observation()
        counts = [F.count(F.lit(1)).alias("rows"), *(F.count_if(c).alias(n) for n, c in (counting or {}).items())]
        w = df.observe(seen, *counts).write.mode("overwrite").option("compression", "zstd")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(self.path(table, seq))
        return seen.get

    # -------------------------------------------------------------- snapshot
    def log(self) -> DataFrame:
        """All rows of ``etl_log``, with ``batch_seq``: those of the latest
        committed fold (a compaction's single table of all earlier rows) and
        the partitions since."""
        names, parts = schemas.ETL_LOG.fieldNames(), self._batches("etl_log")
        for fold in reversed(self._batches("etl_log_fold")):
            recent = self.read("etl_log", schemas.ETL_LOG, [b for b in parts if b >= fold]).select(*names, PART)
            if not recent.where((F.col(PART) == fold) & run_succeeded()).isEmpty():
                folded = self.read("etl_log_fold", ETL_LOG_FOLD, [fold])
                return folded.select(*names, F.col("of_batch").alias(PART)).unionByName(recent)
        return self.read("etl_log", schemas.ETL_LOG, parts).select(*names, PART)

    def committed_batches(self) -> list[int]:
        rows = self.log().where(run_succeeded()).select(PART).distinct().collect()
        return sorted(r[0] for r in rows)

    def next_seq(self) -> int:
        """A number no table has a partition of, whatever a crash left behind."""
        return max((b for t in TABLES for b in self._batches(t)), default=0) + 1

    def compactions(self, committed: list[int]) -> dict[str, list[tuple[int, int]]]:
        """table -> (compaction batch, last batch it covers) of every compaction, in order."""
        out: dict[str, list[tuple[int, int]]] = {}
        if not committed:
            return out
        for r in self.read("compaction", COMPACTION, committed).collect():
            out.setdefault(r["table_name"], []).append((r[PART], r["covers_through"]))
        return {t: sorted(c) for t, c in out.items()}

    def live(self, table: str, committed: list[int], comps: dict) -> list[int]:
        """Committed batches whose partition of an append-only table is
        current: those after the latest compaction, and the compaction; of a
        table that is folded piece by piece, all its compactions."""
        if table not in comps:
            return committed
        through = comps[table][-1][1]
        folds = {seq for seq, _ in comps[table]} if table in FOLDED else set()
        return [b for b in committed if b > through or b in folds]

    def since_compaction(self, table: str, committed: list[int], comps: dict) -> list[int]:
        """Committed batches after the latest compaction of ``table``,
        excluding the compaction itself."""
        if table not in comps:
            return committed
        seq_c, through = comps[table][-1]
        return [b for b in committed if b > through and b != seq_c]

    def products(self, committed: list[int], comps: dict) -> DataFrame:
        """Current SCD-1 product rows (see ``dims.latest_products``)."""
        from starmart.operators.dims import latest_products

        have = set(self._batches("dim_product"))
        live = [b for b in self.live("dim_product", committed, comps) if b in have]
        if not live:
            return schemas.empty(self.spark, schemas.DIM_PRODUCT)
        base = self.read("dim_product", schemas.DIM_PRODUCT, live[:1]).drop(PART)
        if not live[1:]:
            return base
        return latest_products(base, self.read("dim_product", schemas.DIM_PRODUCT, live[1:]))

    def latest(self, table: str, committed: list[int]) -> list[int]:
        """The latest committed batch that wrote ``table`` (as a 0/1 list)."""
        have = set(self._batches(table)) & set(committed)
        return [max(have)] if have else []

    def snapshot(self) -> Snapshot:
        committed = self.committed_batches()
        seq = committed[-1] if committed else 0
        last = [seq] if seq else []
        comps = self.compactions(committed)
        dim_date = self.read("dim_date", schemas.DIM_DATE, self.live("dim_date", committed, comps)
                             ).select(*schemas.DIM_DATE.fieldNames())
        dim_product = self.products(committed, comps)
        cols = schemas.DIM_CUSTOMER.fieldNames()
        versions = self.read("dim_customer_versions", schemas.DIM_CUSTOMER,
                             self.live("dim_customer_versions", committed, comps)).select(*cols)
        closed = self.read("dim_customer_closed", schemas.DIM_CUSTOMER,
                           self.live("dim_customer_closed", committed, comps)).select(*cols)
        # Versions closed since the last compaction (the compacted base holds
        # active versions only).
        recent = self.read("dim_customer_closed", schemas.DIM_CUSTOMER,
                           self.since_compaction("dim_customer_closed", committed, comps))
        active = close_versions(versions, recent)
        fact = self.read("fact_sales", schemas.FACT_SALES, self.live("fact_sales", committed, comps),
                         (PART, "sales_year"))
        fact = fact.select(*schemas.FACT_SALES.fieldNames(), "sales_year")
        log = self.log().select(*schemas.ETL_LOG.fieldNames())
        errors = self.read("etl_error_log", schemas.ETL_ERROR_LOG).select(*schemas.ETL_ERROR_LOG.fieldNames())
        keys = {}
        if seq:
            keys = {r["table_name"]: r["max_key"] for r in self.read(
                "key_state", KEY_STATE, self.latest("key_state", committed)).collect()}
        return Snapshot(seq, committed, dim_date, dim_product, active, closed.unionByName(active),
                        fact, log, errors, keys, closed)


# Log rows of earlier batches in one table, each with its batch.
ETL_LOG_FOLD = T.StructType([*schemas.ETL_LOG.fields, T.StructField("of_batch", T.IntegerType(), False)])

COMPACTION = T.StructType([
    T.StructField("table_name", T.StringType(), False),
    T.StructField("covers_through", T.IntegerType(), False),
])

# Tables of which a compaction folds the batches since the last one only.
FOLDED = ("fact_sales", "dim_customer_closed")

# Every table with batch partitions.
TABLES = (*(f"staging/{t}" for t in (*schemas.SOURCES, "users_clean", "fact_candidates")), "dim_date", "dim_product",
          "dim_customer_versions", "dim_customer_closed", "fact_sales", "key_state", "etl_error_log", "etl_log", "etl_log_fold", "compaction")


def run_succeeded():
    """The log row that commits a batch."""
    return (F.col("phase") == RUN) & (F.col("status") == SUCCESS)


def close_versions(versions: DataFrame, closed: DataFrame) -> DataFrame:
    """Active set = opened versions whose key was not closed since. The closed
    keys are few after a compaction; Spark broadcasts them where their size
    allows, and the versions are then only scanned."""
    return versions.join(closed.select("customer_key"), "customer_key", "left_anti").select(*versions.columns)


KEY_STATE = T.StructType([
    T.StructField("table_name", T.StringType(), False),
    T.StructField("max_key", T.LongType(), False),
])


def star_tables(wh: Warehouse) -> dict[str, DataFrame]:
    """Committed star schema for the analytical queries."""
    s = wh.snapshot()
    return {
        "dim_customer": s.dim_customer,
        "dim_product": s.dim_product,
        "dim_date": s.dim_date,
        "fact_sales": s.fact_sales,
        "etl_log": s.etl_log,
        "etl_error_log": s.etl_error_log,
    }
