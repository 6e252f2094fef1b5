"""Session helpers: a local session for tests/bench and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "daybook") -> SparkSession:
    """A ``local[cores]`` session configured the way tests and the bench expect.

    On a cluster the caller owns the session; nothing in the library changes
    session configuration.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Local data is tiny: without this, adaptive coalescing packs a whole
        # shuffle into one task (the 1 MB default minimum), which serialises
        # partitioned writes of thousands of date folders.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        # One local listing task per partition folder costs more than the
        # listing itself; a few dozen tasks cover thousands of folders.
        .config("spark.sql.sources.parallelPartitionDiscovery.parallelism", "32")
        .config("spark.driver.memory", os.environ.get("DAYBOOK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    event_dir = os.environ.get("DAYBOOK_EVENT_LOG_DIR")
    if event_dir:
        # Stage/task timings for offline reading (the UI stays off).
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can see, taken from ``spark.checkpoint.dir``.

    When the session has none (a local test session), a fresh temporary
    folder is created and registered as the checkpoint dir; on a cluster a
    missing setting is an error, because a machine-local folder would not be
    visible to the executors.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    master = spark.sparkContext.master or ""
    if not master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; daybook needs a shared folder for scratch tables"
        )
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="daybook-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared folder. Never reused, never cleared."""
    return f"{shared_dir(spark)}/daybook-scratch/{name}-{uuid.uuid4().hex[:12]}"


def scratch_table_name(name: str) -> str:
    """A unique table name for a scratch catalog table."""
    return f"daybook_{name}_{uuid.uuid4().hex[:10]}"
