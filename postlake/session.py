"""Session helpers: a local session for tests/bench and the shared work dir."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session configured like the cluster jobs expect (UTC, AQE on, UI off)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("postlake")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.postlake.spread", str(3 * (os.cpu_count() if cores == "*" else int(cores))))
        .config("spark.checkpoint.dir", os.environ.get("POSTLAKE_WORK_DIR", "/tmp/postlake-work"))
        # pages are large rows: keep Arrow batches to the extraction job small
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "1024")
        .config("spark.driver.memory", os.environ.get("POSTLAKE_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, purpose: str = "work") -> str:
    """A fresh directory under the cluster's shared checkpoint folder.

    The folder is the session's ``spark.checkpoint.dir``, or the context's
    checkpoint dir where a job set that. There is no other fallback on a
    cluster: a folder of one machine would lose data. A local session without
    either (one machine by definition) works in its warehouse folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; a shared folder is required on a cluster")
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/work"
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"
