"""Cleaning of staged users."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions import folded, is_blank

UNKNOWN = "Unknown"


def fill_unknown(df: DataFrame, columns=("country", "city"), value: str = UNKNOWN) -> DataFrame:
    """``SET c = 'Unknown' WHERE c IS NULL OR TRIM(c) = ''`` for each column."""
    return df.withColumns({c: F.when(is_blank(c), F.lit(value)).otherwise(F.col(c)) for c in columns})


def dedup_by_email(df: DataFrame, email: str = "email", user_id: str = "user_id",
                   case_insensitive: bool = False, collation: str | None = None, fold: bool = False) -> DataFrame:
    """Delete every row for which another row has the same e-mail and a
    smaller user id: the survivors of each e-mail are its minimum-id rows.

    Written as aggregate + join instead of the quadratic self-join: the
    per-e-mail minimum is a map-side-combined aggregate, and the join back
    is an equi join on e-mail (AQE splits a hot e-mail). Rows with a NULL
    e-mail or NULL id never match anything and are kept, as in SQL.
    ``case_insensitive=True`` compares lower-cased e-mails, ``fold=True`` ones
    without case and accents (``functions.folded``), both by hash. ``collation``
    (e.g. ``"UNICODE_CI_AI"``) compares under a Spark collation instead, whose
    grouping plans a sort aggregate.
    """
    key = F.col(email)
    if fold:
        key = folded(key)
    elif collation:
        key = F.collate(key, collation)
    elif case_insensitive:
        key = F.lower(key)
    keyed = df.withColumn("_dedup_key", key)
    # Rows that match nothing stay out of the join: their NULL would be one hot key.
    alone = F.col("_dedup_key").isNull() | F.col(user_id).isNull()
    paired = keyed.where(~alone)
    firsts = paired.groupBy("_dedup_key").agg(F.min(user_id).alias("_dedup_min"))
    kept = paired.join(firsts, "_dedup_key").where(F.col(user_id) <= F.col("_dedup_min"))
    return kept.select(*df.columns).unionByName(keyed.where(alone).select(*df.columns))


def dropped_by_dedup(df: DataFrame, cleaned: DataFrame, user_id: str = "user_id") -> DataFrame:
    """Users removed by ``dedup_by_email`` (their orders will not reach the
    fact table, so they are reported)."""
    return df.join(cleaned.select(user_id), user_id, "left_anti")


def transform_users(staged_users: DataFrame, case_insensitive: bool = False,
                    collation: str | None = None, fold: bool = False) -> DataFrame:
    """Fill blanks first, then de-duplicate (the reference order)."""
    return dedup_by_email(fill_unknown(staged_users), case_insensitive=case_insensitive, collation=collation, fold=fold)
