"""D10 at file grain: point updates that rewrite only the files that hold a row.

A ``FileTable`` is a folder of immutable parquet files and a log of which of
them are live: ``log/version=N`` lists the files that version N adds and
removes, and is written last, which is the commit. Readers open the live files
of one version and are unaffected by later ones. ``update`` finds the files
with a matching row by ``_metadata.file_path`` (a scan that reads the
predicate's columns only, and skips files and row groups by their statistics),
rewrites those, and commits; every other file stays as it is. The list of live
files is the table's metadata, of the size of the listing Spark itself keeps on
the driver to plan a scan. One writer at a time.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart import schemas
from starmart.operators.maintain import point_update

LOG = T.StructType([T.StructField("file", T.StringType(), False), T.StructField("live", T.BooleanType(), False)])


class Update(NamedTuple):
    version: int
    rewritten: list[str]  # files that held a matching row
    kept: int             # files left as they are


class FileTable:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def _log(self) -> DataFrame:
        return self.spark.read.schema(T.StructType([*LOG.fields, T.StructField("version", T.IntegerType())])).parquet(f"{self.path}/log")

    def _commit(self, version: int, added: list[str], removed: list[str]) -> None:
        rows = [(f, True) for f in added] + [(f, False) for f in removed]
        self.spark.createDataFrame(rows, LOG).coalesce(1).write.parquet(f"{self.path}/log/version={version}")

    def _write(self, df: DataFrame) -> list[str]:
        """Data files of a new part of the table; an empty part has none."""
        part = f"{self.path}/data/{uuid.uuid4().hex}"
        schemas.conform(df, self.schema).write.parquet(part)
        return sorted(self.spark.read.schema(self.schema).parquet(part).inputFiles())

    def create(self, df: DataFrame) -> None:
        """Version 1, with the files that ``df``'s partitions give."""
        self._commit(1, self._write(df), [])

    def version(self) -> int:
        return self._log().agg(F.max("version")).first()[0]

    def files(self, version: int | None = None) -> list[str]:
        """Live files: those whose last entry up to the version adds them."""
        log = self._log() if version is None else self._log().where(F.col("version") <= version)
        last = log.groupBy("file").agg(F.max_by("live", "version").alias("live")).where("live")
        return sorted(r["file"] for r in last.select("file").collect())

    def read(self, version: int | None = None) -> DataFrame:
        return self._of(self.files(version))

    def _of(self, files: list[str]) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*files) if files else schemas.empty(self.spark, self.schema)

    def update(self, predicate: Column, assignments: dict) -> Update:
        """``UPDATE t SET ... WHERE predicate``, rewriting the files that hold a match."""
        live, version = self.files(), self.version()
        name = F.col("_metadata.file_path")
        touched = [r[0] for r in self._of(live).where(predicate).select(name).distinct().collect()] if live else []
        # one spelling of a path: as the listing gives it
        spelled = {_plain(f): f for f in live}
        touched = sorted(spelled[_plain(f)] for f in touched)
        if touched:
            added = self._write(point_update(self._of(touched), predicate, assignments))
            version += 1
            self._commit(version, added, touched)
        return Update(version, touched, len(live) - len(touched))


def _plain(path: str) -> str:
    scheme, _, rest = path.partition(":/")
    return "/" + rest.lstrip("/") if scheme == "file" else path
