"""Session helpers: a local session for tests and bench, and the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int | None = None,
                  event_log_dir: str | None = None) -> SparkSession:
    """A local session configured the way tests and bench.py run.

    ``event_log_dir`` writes Spark's event log there (stage and task times
    without any UI)."""
    parts = shuffle_partitions or (cores if isinstance(cores, int) else 8)
    builder = SparkSession.builder
    if event_log_dir:
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
    spark = (
        builder.master(f"local[{cores}]")
        .appName("bizlens")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for lineage cuts and stored tables, from
    ``spark.checkpoint.dir`` (or the context's checkpoint dir).

    Where neither is set, a session that runs in one process (``local[n]``, as
    in tests) makes a temporary folder; on a cluster, where each executor would
    write to its own disk, that is an error.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="bizlens-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)  # so that DataFrame.checkpoint() writes there
    return path.rstrip("/")


def table_path(spark: SparkSession, name: str) -> str:
    """A new folder for one run of the table ``name``."""
    return f"{shared_dir(spark)}/tables/{name}/{uuid.uuid4().hex}"
