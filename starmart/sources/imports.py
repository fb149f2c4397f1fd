"""CSV import that keeps what it cannot load.

``import_csv`` reads ``<table>.csv`` of every source table, writes the sound
rows as parquet in the layout ``read_sources`` expects, and the others to one
reject table: the raw line, which table it was meant for, and the first reason
found. A line is rejected when it has another number of fields than the table,
when a field is no value of its column's type, or when a NOT NULL column is
empty: what the source database's own import refuses. Both sides come from one
parse of each file, written once; nothing is collected.

A field that is quoted may hold the delimiter and, doubled, quotes, but no line
break: files are split into lines by the scan, so that large ones are read in
parallel. An empty field is NULL.
"""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart import schemas
from starmart.session import discard, materialize

REJECTS = T.StructType([
    T.StructField("table_name", T.StringType(), False),
    T.StructField("line", T.StringType(), False),
    T.StructField("reason", T.StringType(), False),
])
_BROKEN = "_broken"


def _value(field: T.StructField) -> Column:
    raw = F.col(f"_raw.{field.name}")
    return raw if isinstance(field.dataType, T.StringType) else raw.try_cast(field.dataType)


def _reason(schema: T.StructType) -> Column:
    """The first reason against a parsed line, in column order; NULL for a sound one."""
    tests = [F.when(F.col(f"_raw.{_BROKEN}").isNotNull(), F.lit("number of fields"))]
    for f in schema.fields:
        raw = F.col(f"_raw.{f.name}")
        tests.append(F.when(raw.isNotNull() & _value(f).isNull(), F.lit(f"{f.name}: no {f.dataType.simpleString()}")))
        if not f.nullable:
            tests.append(F.when(raw.isNull(), F.lit(f"{f.name}: empty")))
    return F.coalesce(*tests)


def parse_csv(spark: SparkSession, path: str, schema: T.StructType, delimiter: str = ",", header: bool = True) -> DataFrame:
    """Lines of a CSV file with their values (``schema``'s columns, typed), and ``reason``
    (NULL for a sound line). Empty lines and, with ``header``, lines that equal the header are skipped."""
    names = ", ".join(f"`{f.name}` string" for f in schema.fields)
    lines = spark.read.text(path).select(F.col("value").alias("line")).where("line <> ''")
    if header:
        lines = lines.where(F.col("line") != delimiter.join(schema.fieldNames()))
    options = {"sep": delimiter, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN, "nullValue": "", "escape": '"'}
    parsed = lines.withColumn("_raw", F.from_csv("line", f"{names}, {_BROKEN} string", options))
    return parsed.select("line", _reason(schema).alias("reason"), *[_value(f).alias(f.name) for f in schema.fields])


def import_csv(spark: SparkSession, base_path: str, out_path: str, tables: list[str] | None = None, delimiter: str = ",") -> dict[str, DataFrame]:
    """Import ``<base_path>/<table>.csv`` into ``<out_path>/<table>.parquet`` and
    ``<out_path>/rejects.parquet``. Returns the tables and ``rejects``, as written."""
    rejects, held = [], []
    for name in tables or list(schemas.SOURCES):
        rows = materialize(parse_csv(spark, os.path.join(base_path, f"{name}.csv"), schemas.SOURCES[name], delimiter))
        held.append(rows)
        sound = rows.where("reason IS NULL").select(*schemas.SOURCES[name].fieldNames())
        sound.write.mode("overwrite").parquet(os.path.join(out_path, f"{name}.parquet"))
        rejects.append(rows.where("reason IS NOT NULL").select(F.lit(name).alias("table_name"), "line", "reason"))
    path = os.path.join(out_path, "rejects.parquet")
    reduce(DataFrame.unionByName, rejects).write.mode("overwrite").parquet(path)
    discard(*held)
    out = {name: spark.read.schema(schemas.SOURCES[name]).parquet(os.path.join(out_path, f"{name}.parquet")) for name in tables or list(schemas.SOURCES)}
    return out | {"rejects": spark.read.schema(REJECTS).parquet(path)}
