"""Session helpers for tests, the bench and command-line runs.

The library itself never changes session settings; operators only build
DataFrames.  These helpers give a local session the settings a cluster job
would carry (AQE, skew-join splitting, no UI) and find the shared checkpoint
folder (``spark.checkpoint.dir``).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int | str = 8, shuffle_partitions: int | None = None,
                  app: str = "tablestats", event_log_dir: str | None = None) -> SparkSession:
    """A local session configured like the cluster runs (tests, bench).

    ``event_log_dir`` writes Spark's event log there (stage and task times).
    """
    parts = shuffle_partitions or max(int(cpus) if str(cpus).isdigit() else 8, 1)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TABLESTATS_DRIVER_MEM", "8g"))
    )
    if event_log_dir:
        builder = (builder.config("spark.eventLog.enabled", "true")
                          .config("spark.eventLog.dir", event_log_dir))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder comes from the session (a shared file system).
    Only when it is unset, as in local tests, a private temporary folder is
    created and registered; on a cluster, whose machines don't share such a
    folder, that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        folder = configured
    elif spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
    else:
        folder = tempfile.mkdtemp(prefix="tablestats-ckpt-")
        spark.conf.set("spark.checkpoint.dir", folder)
    spark.sparkContext.setCheckpointDir(folder)
    return folder

