"""Session construction and shared-folder resolution."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def default_driver_memory(fraction: float = 0.6, cap_gb: int = 16) -> str:
    """Heap for a local driver: a share of the container's memory limit
    (cgroup), else of physical memory, capped - never more than the box has."""
    limit = None
    for path in ("/sys/fs/cgroup/memory.max", "/sys/fs/cgroup/memory/memory.limit_in_bytes"):
        try:
            raw = open(path).read().strip()
            if raw.isdigit() and int(raw) < (1 << 60):
                limit = int(raw)
                break
        except OSError:
            pass
    if limit is None:
        try:
            limit = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
        except (ValueError, OSError):
            limit = 8 << 30
    gb = max(1, min(cap_gb, int(limit * fraction) >> 30))
    return f"{gb}g"


def get_spark(app: str = "aspectflow", cpus: int | str | None = None,
              shuffle_partitions: int | None = None,
              driver_memory: str | None = None,
              checkpoint_dir: str | None = None,
              extra_conf: dict | None = None) -> SparkSession:
    """Local session with the settings the library assumes.

    On a cluster, pass nothing: the master, memory and ``spark.checkpoint.dir``
    come from the submit configuration.  ``checkpoint_dir`` is only applied
    when the cluster has not named one (tests, local runs).
    """
    cores = cpus or os.environ.get("BENCH_CPUS") or "*"
    builder = (
        SparkSession.builder.appName(app)
        .master(f"local[{cores}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # reliable checkpoints are removed once their DataFrame is gone
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", driver_memory or default_driver_memory())
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, str(value))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark, checkpoint_dir)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder named by the session.

    The cluster's ``spark.checkpoint.dir`` always wins; ``fallback`` is only
    used when it is unset (tests and local runs).
    """
    current = checkpoint_root(spark)
    if current:
        return current
    if fallback is None:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; configure a shared folder "
            "(or pass checkpoint_dir= for a local run)")
    spark.sparkContext.setCheckpointDir(fallback)
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


def checkpoint_root(spark: SparkSession) -> str | None:
    conf = spark.sparkContext.getConf()
    value = conf.get("spark.checkpoint.dir", None)
    if not value:
        try:
            value = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key raises in Spark Connect/classic
            value = None
    if value and spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(value)
    return value or None


def _root(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``.  Where it is unset, a session on one
    machine (``local`` master) gets a folder of its own under its warehouse; on a
    cluster that is an error, as no folder is known to be shared."""
    root = checkpoint_root(spark)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir is not set; name a folder that all executors share")
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_aspectflow_checkpoints"
        spark.sparkContext.setCheckpointDir(root)
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def shared_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path under the shared checkpoint folder (never a machine-local temp dir)."""
    root = _root(spark)
    tail = list(parts)
    if unique:
        tail.append(uuid.uuid4().hex)
    return "/".join([root.rstrip("/"), "aspectflow", *tail])


def cut_lineage(df):
    """Reliable checkpoint into spark.checkpoint.dir (survives executor loss)."""
    _root(df.sparkSession)
    return df.checkpoint(eager=True)


def cut_lineage_columnar(df, name: str):
    """Write as Parquet into the shared folder and read back: durable like a
    checkpoint, and later reads take only the columns they need."""
    path = shared_path(df.sparkSession, name, unique=True)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_batches(spark: SparkSession, size: int) -> Iterator[None]:
    """Jobs started inside send tasks' Python Arrow batches of about ``size`` bytes, not of Spark's 64 MB: both the
    executor and its Python hold a batch per task.  Rows and results are the same."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        spark.conf.set(key, before)
