"""One ETL batch against the on-disk warehouse.

``run_batch`` is the whole job: read the watermark, extract, clean, load the
dimensions, load the facts, and commit by writing the batch's log rows.
Every intermediate result is written under the batch's own partition and
read back, which cuts the lineage (an executor lost late in the batch does
not send Spark back to the sources) and gives each later step a stable
snapshot even if the sources keep changing.
"""

from __future__ import annotations

import datetime as dt
import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart import schemas
from starmart.functions import sales_year
from starmart.operators.clean import transform_users
from starmart.operators.dims import latest_products, new_dates, scd1_changes, scd2_split
from starmart.operators.extract import extract, high_watermark
from starmart.operators.facts import fact_candidates, load_facts
from starmart.operators.quality import duplicate_keys, null_counts
from starmart.plans.warehouse import FAILED, KEY_STATE, PART, RUN, SUCCESS, Warehouse, close_versions
from starmart.session import scratch_tables

# Phases logged per successful batch, by variant.
PHASES = {
    "split": ["EXTRACT", "TRANSFORM", "SCD_LOAD", "FACT_INCREMENTAL", RUN],
    "combined": ["EXTRACT", "TRANSFORM", "LOAD", RUN],
}
# The log's messages.
MESSAGES = {
    "EXTRACT": "Incremental extract completed",
    "TRANSFORM": "Data cleansing and dedup completed",
    "SCD_LOAD": "SCD Type 1 and Type 2 completed",
    "FACT_INCREMENTAL": "Incremental fact load completed",
    "LOAD": "Dimensions and fact load completed",
    RUN: "ETL pipeline completed successfully",
}
FAILED_MESSAGE = "ETL failed and rolled back"

ERROR_MESSAGE = "SQL exception occurred, transaction rolled back"


class BatchError(RuntimeError):
    pass


class BatchResult(NamedTuple):
    seq: int
    batch_id: str
    status: str
    rows: dict
    error: str | None = None
    seconds: dict | None = None  # wall time per step


class _Clock:
    def __init__(self):
        import time

        self._now = time.perf_counter
        self.t = self._now()
        self.steps: dict[str, float] = {}

    def lap(self, name: str) -> None:
        now = self._now()
        self.steps[name] = round(now - self.t, 3)
        self.t = now


def now_ts(spark: SparkSession) -> dt.datetime:
    """The run stamp: Spark's local timestamp in the session's time zone (UTC
    in ``session.BASE_CONF``), to the second. The sources' stamps have to be
    in the same zone."""
    return spark.sql("SELECT localtimestamp() AS t").first()["t"].replace(microsecond=0)


def _lit_ts(ts: dt.datetime):
    return F.lit(ts.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def check_staging(staged: dict[str, DataFrame]) -> None:
    """Staged frames must be unique on their keys before they are joined
    (parquet enforces no primary key; a duplicate would fan out the joins)
    and must hold no NULL in a NOT NULL column (the source database refused
    such rows at insert). All tables are checked in one job."""
    parts = [
        duplicate_keys(staged[name], keys).limit(1).select(F.lit(f"{name}: duplicate {keys}").alias("problem"))
        for name, keys in schemas.PRIMARY_KEYS.items() if name in staged
    ]
    for name, schema in schemas.SOURCES.items():
        required = [f.name for f in schema.fields if not f.nullable]
        if name in staged and required:
            counts = null_counts(staged[name], required).where(F.col("null_count") > 0)
            parts.append(counts.select(F.concat(F.lit(f"{name}: NULL in "), F.col("column_name")).alias("problem")))
    problems = [r[0] for r in reduce(DataFrame.unionByName, parts).collect()]
    if problems:
        raise BatchError("staging validation failed: " + "; ".join(sorted(problems)))


def parallel(*jobs):
    """Run independent Spark actions (writes) from concurrent driver threads,
    so small jobs share the cluster instead of queueing; re-raise the first
    failure."""
    with ThreadPoolExecutor(max_workers=max(1, len(jobs))) as pool:
        futures = [pool.submit(j) for j in jobs]
        return [f.result() for f in futures]


def _log_rows(spark, wh: Warehouse, seq, batch_id, entries, loaded_until, base_id: int, created=None) -> DataFrame:
    rows = [(batch_id, phase, n, status, msg, i) for i, (phase, n, status, msg) in enumerate(entries)]
    df = spark.createDataFrame(rows, "batch_id string, phase string, rows_affected long, status string, "
                                     "message string, _pos int")
    ts = _lit_ts(loaded_until)
    out = df.select(
        (F.lit(base_id) + F.col("_pos") + 1).cast("long").alias("etl_id"), "batch_id", "phase",
        ts.alias("last_loaded_time"), "rows_affected", "status", "message", _lit_ts(created or loaded_until).alias("created_at"),
    )
    return schemas.conform(out, schemas.ETL_LOG)


def _max_id(df: DataFrame, col: str) -> int:
    return df.agg(F.coalesce(F.max(col), F.lit(0))).first()[0]


def run_staged(spark: SparkSession, wh: Warehouse, staged, *, run_ts=None,
               batch_id: str | None = None, variant: str = "split", match_on: str | None = None,
               swallow: bool = False, fail_at: str | None = None, validate: bool = True,
               case_insensitive_dedup: bool = False, collation: str | None = None,
               snapshot=None, keep_watermark: bool = False) -> BatchResult:
    """Load already-staged frames (any of the five sources; missing ones are
    empty) as one batch. ``staged`` is the frames, or a function of the
    snapshot that returns them (it runs inside the failure handler).
    ``keep_watermark`` logs the batch under the current watermark instead of
    ``run_ts``, for a feed that does not read all sources. ``fail_at``
    ("transform", "dims", "fact") raises at that point, for failure tests.
    ``collation`` (e.g. ``"UNICODE_CI_AI"``) makes the e-mail de-duplication
    and the SCD-2 change test compare strings case- and accent-insensitively;
    the default is binary comparison."""
    with scratch_tables():  # what the batch materialized on the way goes when it has ended
        return _run_staged(spark, wh, staged, run_ts or now_ts(spark), batch_id or str(uuid.uuid4()), variant, match_on, swallow, fail_at, validate,
                           case_insensitive_dedup, collation, snapshot, keep_watermark)


def _run_staged(spark, wh, staged, run_ts, batch_id, variant, match_on, swallow, fail_at, validate,
                case_insensitive_dedup, collation, snapshot, keep_watermark) -> BatchResult:
    seq = wh.next_seq()
    match_on = match_on or ("split" if variant == "split" else "combined")
    clock = _Clock()
    try:
        snap = snapshot or wh.snapshot()
        staged = staged(snap) if callable(staged) else staged
        base_etl = _max_id(snap.etl_log, "etl_id")
        loaded_until = high_watermark(snap.etl_log).first()[0] if keep_watermark else run_ts
        # --- stage: write and read back (the staging tables)
        def stage(name, schema):
            df = staged.get(name)
            df = schemas.empty(spark, schema) if df is None else schemas.conform(df, schema)
            return lambda: wh.write(df, f"staging/{name}", seq)

        observed = dict(zip(schemas.SOURCES, parallel(*[stage(n, s) for n, s in schemas.SOURCES.items()])))
        st = {n: wh.read(f"staging/{n}", s, [seq]).drop(PART) for n, s in schemas.SOURCES.items()}
        if validate:
            check_staging(st)
        # Row counts are what the writes observed.
        n_orders, n_products = observed["orders"]["rows"], observed["products"]["rows"]
        clock.lap("stage")

        # --- transform
        n_users = wh.write(transform_users(st["users"], case_insensitive_dedup, collation), "staging/users_clean", seq)["rows"]
        users = wh.read("staging/users_clean", schemas.USERS, [seq]).drop(PART)
        clock.lap("transform")
        if fail_at == "transform":
            raise BatchError("injected failure after transform")

        # --- dimensions (D1, D2, D3+D4)
        base_c = int(snap.max_keys.get("dim_customer", 0))
        base_p = int(snap.max_keys.get("dim_product", 0))
        base_s = int(snap.max_keys.get("fact_sales", 0))
        jobs = {"dim_date": lambda: wh.write(new_dates(st["orders"], snap.dim_date), "dim_date", seq, files=1)}
        if n_products:
            upsert = scd1_changes(snap.dim_product, st["products"], F.lit(base_p))
            jobs["dim_product"] = lambda: wh.write(upsert, "dim_product", seq, counting={"new": F.col("product_key") > base_p})
        if n_users:
            scd2 = scd2_split(snap.dim_customer_active, users, _lit_ts(run_ts), F.lit(base_c), collation=collation)
            jobs["opened"] = lambda: wh.write(scd2.inserted, "dim_customer_versions", seq)
            jobs["closed"] = lambda: wh.write(scd2.closed, "dim_customer_closed", seq)
        observed |= dict(zip(jobs, parallel(*jobs.values())))
        if n_products:
            changed = wh.read("dim_product", schemas.DIM_PRODUCT, [seq])
            products = latest_products(snap.dim_product, changed)
            n_new_products = observed["dim_product"]["new"]
        else:
            products, n_new_products = snap.dim_product, 0
        if n_users:
            opened = wh.read("dim_customer_versions", schemas.DIM_CUSTOMER, [seq]).drop(PART)
            closed_now = wh.read("dim_customer_closed", schemas.DIM_CUSTOMER, [seq]).drop(PART)
            active = close_versions(snap.dim_customer_active, closed_now).unionByName(opened)
        else:
            active = snap.dim_customer_active
        n_versions = observed["opened"]["rows"] if n_users else 0
        clock.lap("dimensions")
        if fail_at == "dims":
            raise BatchError("injected failure after dimension load")

        # --- fact (D5)
        # Candidates are written once: the idempotency check reads them three
        # times and must not re-scan the dimensions each time.
        wh.write(fact_candidates(st["order_items"], st["orders"], active, products), "staging/fact_candidates", seq)
        cands = wh.read("staging/fact_candidates", schemas.FACT_CANDIDATES, [seq]).drop(PART)
        clock.lap("fact_candidates")
        facts = load_facts(cands, snap.fact_sales, _lit_ts(run_ts), match_on, base_sale_id=F.lit(base_s))
        # Sorted within each task by year and day: one open file per task at a
        # time, and files whose date_key ranges let row groups be skipped.
        n_facts = wh.write(facts.withColumn("sales_year", sales_year("date_key")).sortWithinPartitions("sales_year", "date_key"),
                           "fact_sales", seq, partition_by=["sales_year"])["rows"]
        clock.lap("fact_load")
        if fail_at == "fact":
            raise BatchError("injected failure after fact load")

        # --- key state and commit
        # Keys are dense: a batch that added n rows moved the maximum by n.
        keys = spark.createDataFrame([
            ("dim_customer", base_c + n_versions),
            ("dim_product", base_p + n_new_products),
            ("fact_sales", base_s + n_facts),
        ], KEY_STATE)
        wh.write(keys, "key_state", seq, files=1)
        counts = {"EXTRACT": n_orders, "TRANSFORM": n_users, "SCD_LOAD": n_versions,
                  "FACT_INCREMENTAL": n_facts, "LOAD": n_facts, RUN: 1}
        entries = [(p, counts[p], SUCCESS, MESSAGES[p]) for p in PHASES[variant]]
        wh.write(_log_rows(spark, wh, seq, batch_id, entries, loaded_until, base_etl, run_ts), "etl_log", seq, files=1)
        clock.lap("commit")
        return BatchResult(seq, batch_id, SUCCESS, {p: counts[p] for p in PHASES[variant]}, None, clock.steps)
    except Exception as exc:  # C7: record the failure, publish nothing
        base_err = _max_id(wh.read("etl_error_log", schemas.ETL_ERROR_LOG), "error_id")
        base_etl = _max_id(wh.log(), "etl_id")
        err = spark.createDataFrame(
            [(base_err + 1, batch_id, "run_etl", f"{ERROR_MESSAGE}: {exc}")],
            "error_id long, batch_id string, procedure_name string, error_message string",
        ).withColumn("created_at", _lit_ts(run_ts))
        wh.write(schemas.conform(err, schemas.ETL_ERROR_LOG), "etl_error_log", seq, files=1)
        wh.write(_log_rows(spark, wh, seq, batch_id, [(RUN, 0, FAILED, FAILED_MESSAGE)], run_ts, base_etl),
                 "etl_log", seq, files=1)
        if not swallow:
            raise
        return BatchResult(seq, batch_id, FAILED, {}, str(exc))


def run_batch(spark: SparkSession, sources, root: str,
              overlap: dt.timedelta | None = None, **kwargs) -> BatchResult:
    """One incremental batch from the source tables (``CALL run_etl()``).

    The watermark is the latest SUCCESS stamp of a committed batch; every
    log row of a batch carries its ``run_ts``, fixed before the extract, so
    a row changed while the batch runs is picked up by the next one.
    ``sources`` is a function that opens the source tables, called after the
    run stamp is taken: a file that lands later than the listing is stamped
    later than the watermark and belongs to the next batch. Frames that are
    open already may be passed instead when no file lands meanwhile.
    A failure anywhere, the extract included, is recorded and publishes nothing.
    ``overlap`` re-reads a window before the watermark (for sources whose
    stamps can lag); the loads are idempotent, so re-staged rows add nothing.
    """
    def staged(snap):
        watermark = high_watermark(snap.etl_log).first()[0]
        tables = sources() if callable(sources) else sources
        return extract(tables, watermark - overlap if overlap else watermark)

    return run_staged(spark, Warehouse(spark, root), staged, **kwargs)

