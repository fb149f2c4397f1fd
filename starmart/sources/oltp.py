"""Reading the five OLTP tables and the number series.

Every reader takes the fixed schema; nothing is inferred. CSV follows the
contract of one file per table under a base path (``users.csv``,
``products.csv``, ``orders.csv``, ``order_items.csv``, ``payments.csv``) with a
header row.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart import schemas
from starmart.session import materialize

CORRUPT = "_corrupt_record"


def read_table(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
               mode: str = "FAILFAST", header: bool = True, delimiter: str = ",") -> DataFrame:
    """Scan one table (``SELECT * FROM t``) with its declared schema.

    For CSV, ``mode="FAILFAST"`` raises on a malformed row; ``"PERMISSIVE"``
    keeps it with NULLs and the raw line in ``_corrupt_record`` (see
    ``csv_rejects``). A permissive read is parsed whole, once, into a staging
    table: Spark parses only the columns a query asks for, and a row can look
    sound to a query that does not ask for its broken column.
    """
    if fmt == "parquet":
        return spark.read.schema(schema).parquet(path)
    if fmt == "csv":
        read_schema = schema
        if mode == "PERMISSIVE":
            read_schema = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
        rows = (
            spark.read.schema(read_schema)
            .option("columnPruning", False)
            .option("header", header)
            .option("sep", delimiter)
            .option("mode", mode)
            .option("columnNameOfCorruptRecord", CORRUPT)
            .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
            .csv(path)
        )
        return materialize(rows) if mode == "PERMISSIVE" else rows
    return spark.read.schema(schema).format(fmt).load(path)


def read_sources(spark: SparkSession, base_path: str, fmt: str = "parquet", **options) -> dict[str, DataFrame]:
    """The five source tables from ``<base_path>/<table>.<fmt>``."""
    out = {}
    for name, schema in schemas.SOURCES.items():
        path = os.path.join(base_path, f"{name}.{fmt}")
        out[name] = read_table(spark, path, schema, fmt=fmt, **options)
    return out


def csv_rejects(df: DataFrame) -> DataFrame:
    """Rows a PERMISSIVE CSV read could not parse."""
    return df.where(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def csv_clean(df: DataFrame) -> DataFrame:
    """Rows a PERMISSIVE CSV read parsed, without the corrupt-record column."""
    if CORRUPT not in df.columns:
        return df
    return df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


DATE_COMPANION = "last_updated_date"


def write_sources(tables: dict[str, DataFrame], base_path: str, fmt: str = "parquet", mode: str = "overwrite",
                  date_partitioned: bool = False) -> None:
    """Write source tables in the layout ``read_sources`` expects.

    ``date_partitioned=True`` partitions every table that has a change stamp
    by ``last_updated_date``: the incremental extract's watermark then prunes
    whole directories (the role the reference's ``last_updated`` indexes
    play), instead of scanning the table every hour.
    """
    for name, df in tables.items():
        w = df.write.mode(mode)
        if date_partitioned and "last_updated" in df.columns:
            w = df.withColumn(DATE_COMPANION, F.to_date("last_updated")).write.mode(mode).partitionBy(DATE_COMPANION)
        path = os.path.join(base_path, f"{name}.{fmt}")
        if fmt == "csv":
            w.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path)
        else:
            w.format(fmt).save(path)


def number_series(spark: SparkSession, n: int, start: int = 1) -> DataFrame:
    """``helper_numbers``: one int column ``n`` = start .. start + n - 1,
    generated in parallel (no digit cross join needed)."""
    return spark.range(start, start + n).select(F.col("id").cast("int").alias("n"))
