"""First load of an empty warehouse, as one lazy Spark plan.

This is what ``run_batch`` computes on its first call (watermark 1900, every
row staged, nothing to match against), without the writes: the registered
queries and the benchmark use it to derive the star schema straight from the
source tables.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart import schemas
from starmart.operators.clean import dedup_by_email, fill_unknown
from starmart.operators.dims import date_rows, initial_customers, initial_products
from starmart.operators.facts import fact_candidates
from starmart.operators.keys import assign_surrogate_keys


class Star(NamedTuple):
    dim_customer: DataFrame
    dim_product: DataFrame
    dim_date: DataFrame
    fact_sales: DataFrame
    users: DataFrame  # staged users after cleaning


def first_load(sources: dict[str, DataFrame], run_ts, dedup: bool = False, with_ids: bool = True) -> Star:
    """Dimensions and facts of a first batch.

    ``dedup`` runs the e-mail de-duplication (it drops users, whose orders
    then produce no facts). ``with_ids=False`` leaves out the per-row ids of
    the fact (``sale_id``, ``source_order_item_id``) for consumers that only
    aggregate; with an empty fact table there is nothing to match them
    against, so the rows are the same.
    """
    users = fill_unknown(sources["users"])
    if dedup:
        users = dedup_by_email(users)
    dim_customer = initial_customers(users, run_ts)
    dim_product = initial_products(sources["products"])
    dates = sources["orders"].select(F.to_date("order_date").alias("full_date")).where("full_date IS NOT NULL").distinct()
    dim_date = date_rows(dates)
    cands = fact_candidates(sources["order_items"], sources["orders"], dim_customer, dim_product, with_item_id=with_ids)
    ts = F.lit(run_ts).cast("timestamp_ntz")
    if with_ids:
        fact = assign_surrogate_keys(cands, ["source_order_item_id", "date_key"], "sale_id").withColumn("load_dts", ts)
        fact = schemas.conform(fact, schemas.FACT_SALES)
    else:
        fact = cands.withColumn("load_dts", ts)
    return Star(dim_customer, dim_product, dim_date, fact, users)


def batch_log(counts: dict[str, DataFrame], batch_id: str, run_ts, variant: str = "split") -> DataFrame:
    """``etl_log`` rows of one successful batch from lazily computed counts
    (each a one-row DataFrame with column ``n``): one row per phase, ids in
    phase order, every stamp = ``run_ts``. Nothing is collected."""
    from functools import reduce

    from starmart.plans.batch import MESSAGES, PHASES

    ts = F.lit(run_ts).cast("timestamp_ntz")
    parts = []
    for pos, phase in enumerate(PHASES[variant]):
        n = counts[phase] if phase in counts else None
        base = n.select(F.col("n").cast("long").alias("rows_affected")) if n is not None else \
            n_one(counts)
        parts.append(base.select(
            F.lit(pos + 1).cast("long").alias("etl_id"), F.lit(batch_id).alias("batch_id"),
            F.lit(phase).alias("phase"), ts.alias("last_loaded_time"), "rows_affected",
            F.lit("SUCCESS").alias("status"), F.lit(MESSAGES[phase]).alias("message"), ts.alias("created_at"),
        ))
    return schemas.conform(reduce(DataFrame.unionByName, parts), schemas.ETL_LOG)


def n_one(counts: dict[str, DataFrame]) -> DataFrame:
    """The RUN row's constant 1, shaped like a count frame."""
    any_frame = next(iter(counts.values()))
    return any_frame.select(F.lit(1).cast("long").alias("rows_affected"))


def _count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def first_batch_log(sources: dict[str, DataFrame], run_ts, batch_id: str = "first-load",
                    variant: str = "split") -> DataFrame:
    """Log of a first batch with e-mail de-duplication, as the batch runner
    would write it: EXTRACT = staged orders, TRANSFORM = users after
    cleaning, SCD_LOAD = new customer versions, FACT_INCREMENTAL / LOAD =
    facts inserted, RUN = 1."""
    star = first_load(sources, run_ts, dedup=True, with_ids=False)
    facts = _count(star.fact_sales)
    counts = {
        "EXTRACT": _count(sources["orders"]),
        "TRANSFORM": _count(star.users),
        "SCD_LOAD": _count(star.users),
        "FACT_INCREMENTAL": facts,
        "LOAD": facts,
    }
    return batch_log(counts, batch_id, run_ts, variant)
