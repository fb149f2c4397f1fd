"""Spark session settings the library relies on."""

from __future__ import annotations

import os
import re
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job assumes: UTC wall clock, ANSI arithmetic (decimal
# overflow raises instead of wrapping), adaptive execution with skew-join
# splitting, and no web UI.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}
# Spark compares its broadcast threshold with the size of the files, and a file
# of ids is many times larger in rows, all of which pass the driver. Joins with
# tables larger than this are shuffled, at every scale.
BROADCAST_BYTES = 1 << 20


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "starmart", extra: dict | None = None) -> SparkSession:
    """Session for tests and local runs. On a cluster, pass the cluster's
    own builder settings through ``extra``."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.setdefault("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def scale_conf(input_bytes: int, cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Settings sized to the input: initial shuffle partitions so that each
    holds about ``target_partition_bytes`` (AQE then coalesces small ones),
    at least two per core; scan splits of 256 MiB. For a 100 TB input on
    1,000 executors this gives ~400k shuffle partitions of ~256 MiB."""
    parts = max(2 * cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }


def _bytes(size: str) -> int:
    """A size as Spark's settings spell it: -1, 256k, 10485760b, 10mb."""
    number, unit = re.fullmatch(r"(-?\d+)([kmgtp]?)b?", size.strip().lower()).groups()
    return int(number) << 10 * "_kmgtp".index(unit or "_")


def apply_conf(spark: SparkSession) -> None:
    """Pin the runtime-settable parts of ``BASE_CONF`` on an existing session."""
    for k, v in BASE_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    if _bytes(spark.conf.get(threshold)) > BROADCAST_BYTES:
        spark.conf.set(threshold, str(BROADCAST_BYTES))


_LOCAL_CKPT: dict = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint directory, setting a local one only when the
    session has none (tests and local runs). On a cluster the shared folder
    named by ``spark.checkpoint.dir`` is used as given."""
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect session has no local context
        sc = None
    if sc is not None:
        current = sc.getCheckpointDir()
        if current:
            return current
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    else:
        configured = spark.conf.get("spark.checkpoint.dir", None)
    path = configured or _LOCAL_CKPT.get("dir")
    if not path:
        master = sc.master if sc is not None else "remote"
        if not master.startswith("local[") and master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="starmart-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        _LOCAL_CKPT["dir"] = path
    if sc is not None:
        sc.setCheckpointDir(path)
    return path


def session_key(spark: SparkSession) -> str:
    """Identifier of the running application (for per-session caches)."""
    return spark.conf.get("spark.app.id", None) or str(id(spark))


_SCRATCH: list[list] = []  # tables of the open ``scratch_tables`` blocks


def materialize(df, keep: bool = False, compression: str = "snappy"):
    """Write ``df`` as a parquet table under the session's checkpoint
    directory (the shared folder on a cluster) and read it back: cuts the
    lineage and freezes nondeterministic columns in one columnar write.
    ``discard`` removes the table, and so does an enclosing ``scratch_tables``
    unless it is to ``keep`` it."""
    import uuid

    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/tables/{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    out = spark.read.parquet(path)
    out._table = path
    if _SCRATCH and not keep:
        _SCRATCH[-1].append(out)
    return out


def discard(*frames) -> None:
    """Remove tables that ``materialize`` wrote, once nothing reads them any
    more. Frames it did not write are left alone."""
    for df in frames:
        path = df.__dict__.get("_table")
        if path:
            spark = df.sparkSession
            jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
            jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


@contextmanager
def kept_tables():
    """Tables that are materialized in the block stay when an enclosing
    ``scratch_tables`` block ends."""
    held: list = []
    _SCRATCH.append(held)
    try:
        yield
    finally:
        _SCRATCH[:] = [x for x in _SCRATCH if x is not held]


@contextmanager
def scratch_tables():
    """Remove, at the end of the block, the tables that were materialized in
    it: for jobs whose results are written elsewhere by then."""
    held: list = []
    _SCRATCH.append(held)
    try:
        yield
    finally:
        _SCRATCH.remove(held)
        discard(*held)
