"""Q1-Q6: declared constraints re-aimed as table checks, and audits.

Every check is one distributed pass (aggregate or anti join) and returns a
DataFrame of violations or counts; nothing is collected."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Q1: key values held by more than one row, with their row count ``n``
    (map-side combined count, so a hot key costs one row per task)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def unique_summary(tables: dict[str, DataFrame], keys: list[tuple[str, list[str]]]) -> DataFrame:
    """Q1 over several keys: one row per (table, key) with the number of key
    values that more than one row holds. As with a UNIQUE constraint, rows
    with a NULL in the key do not count."""
    parts = []
    for name, cols in keys:
        held = duplicate_keys(tables[name].dropna(subset=cols), cols)
        parts.append(held.agg(F.count(F.lit(1)).alias("duplicated")).select(
            F.lit(name).alias("table_name"), F.lit(", ".join(cols)).alias("key_columns"), "duplicated"))
    return reduce(DataFrame.unionByName, parts)


def orphans(child: DataFrame, parent: DataFrame, child_col: str, parent_col: str | None = None) -> DataFrame:
    """Q2: child rows whose foreign key has no parent row (NULL keys are not
    orphans, as with SQL foreign keys)."""
    parent_col = parent_col or child_col
    keys = parent.select(F.col(parent_col).alias(child_col))
    return child.where(F.col(child_col).isNotNull()).join(keys, child_col, "left_anti")


def orphan_count(child: DataFrame, parent: DataFrame, child_col: str, parent_col: str | None = None) -> DataFrame:
    """Q2 as a count: the child is first reduced to (key, rows) - map-side
    combined, so a key held by a third of the rows costs one row per task -
    and only those distinct keys meet the parent."""
    parent_col = parent_col or child_col
    per_key = child.where(F.col(child_col).isNotNull()).groupBy(child_col).agg(F.count(F.lit(1)).alias("_n"))
    keys = parent.select(F.col(parent_col).alias(child_col))
    missing = per_key.join(keys, child_col, "left_anti")
    return missing.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("orphan_rows"))


def orphan_summary(tables: dict[str, DataFrame], relations) -> DataFrame:
    """Q2 over several relations: one row per (child.col -> parent.col) with
    its orphan count."""
    parts = [
        orphan_count(tables[c], tables[p], cc, pc)
        .select(F.lit(f"{c}.{cc} -> {p}.{pc}").alias("relation"), "orphan_rows")
        for c, cc, p, pc in relations
    ]
    return reduce(DataFrame.unionByName, parts)


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Q3: NULL count per column in a single scan, as (column_name,
    null_count) rows."""
    columns = columns or df.columns
    wide = df.agg(*[F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).cast("long").alias(c) for c in columns])
    return wide.unpivot([], columns, "column_name", "null_count")


def length_violations(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Q4: rows with a string longer than its declared VARCHAR length, as
    (column_name, violations) counts from one scan."""
    cols = list(limits)
    wide = df.agg(*[
        F.sum(F.when(F.length(F.col(c)) > n, 1).otherwise(0)).cast("long").alias(c) for c, n in limits.items()
    ])
    return wide.unpivot([], cols, "column_name", "violations")


def per_table(tables: dict[str, DataFrame], check) -> DataFrame:
    """One check over several tables: ``check(name, df)`` with the table's
    name in front."""
    parts = [check(name, df).select(F.lit(name).alias("table_name"), "*") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def decimal_summary(df: DataFrame, limits: dict[str, tuple[int, int]]) -> DataFrame:
    """Q4: (column_name, violations) of values that do not fit their declared
    DECIMAL(precision, scale), from one scan."""
    wide = df.agg(*[
        F.sum(F.when(F.col(c).isNotNull() & F.col(c).try_cast(f"decimal({p},{s})").isNull(), 1).otherwise(0))
        .cast("long").alias(c) for c, (p, s) in limits.items()
    ])
    return wide.unpivot([], list(limits), "column_name", "violations")


def decimal_violations(df: DataFrame, column: str, precision: int, scale: int) -> DataFrame:
    """Q4: rows whose value does not fit DECIMAL(precision, scale)."""
    c = F.col(column)
    return df.where(c.isNotNull() & c.try_cast(f"decimal({precision},{scale})").isNull())


def row_count_audit(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for each table, unioned."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def log_tail(log: DataFrame, n: int = 20, id_col: str = "etl_id",
             columns: list[str] | None = None) -> DataFrame:
    """Newest ``n`` log rows (top-k, not a full sort)."""
    out = log.orderBy(F.col(id_col).desc()).limit(n)
    return out.select(*columns) if columns else out
