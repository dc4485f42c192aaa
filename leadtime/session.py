"""Session helpers: one place that decides time zone and checkpoint folder."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession


def get_session(master: str | None = None, app: str = "leadtime",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the library assumes.

    AQE stays on so partition counts are coalesced and skewed joins split at
    run time; the session zone is pinned to UTC because every time column
    the library produces is a UTC instant.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    use_utc(spark)
    return spark


def use_utc(spark: SparkSession) -> None:
    """Pin the session zone to UTC (timestamps are UTC instants throughout)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    Reads the context's directory or ``spark.checkpoint.dir``.  With neither
    set, a local session (one machine) gets a fresh temporary folder, and a
    cluster raises: its executors can't share a folder of one machine.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        d = local_checkpoint_dir(sc.master)
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def local_checkpoint_dir(master: str) -> str:
    """A temporary folder for a session inside one process; raises for any
    other master."""
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="leadtime-ckpt-")
