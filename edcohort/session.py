"""Session helpers.

Library code never creates a session; it receives one.  ``local_session`` is for
tests and the benchmark only.  ``checkpoint_dir`` reads the shared folder the
cluster configures in ``spark.checkpoint.dir`` and only falls back to a fresh
scratch folder when nothing is configured (local tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", app: str = "edcohort",
                  shuffle_partitions: int = 8, driver_memory: str = "12g") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder: the session's, else ``spark.checkpoint.dir``,
    else a new scratch folder, but only where the master is local (tests): on a
    cluster a folder of the driver's machine would be a wrong place."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="edcohort-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared checkpoint folder.

    Used where two passes must see identical partitioning (global ordinals),
    so that a lost executor cannot make the passes disagree."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
