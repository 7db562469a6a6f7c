"""Session defaults and the few settings every job needs."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "pulselake", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with UTC, naive timestamps by default and adaptive execution."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (
        b.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.timestampType", "TIMESTAMP_NTZ")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b.getOrCreate()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder all executors can reach, under ``spark.checkpoint.dir``, removed when the driver ends.

    The cluster names the shared folder in ``spark.checkpoint.dir``. Only where
    it is unset (tests, one machine) a temporary folder of this machine is used;
    on a cluster without the setting this refuses rather than write to a disk
    that the other machines cannot see.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
        root = "file://" + tempfile.gettempdir() + f"/pulselake-{os.getuid()}"
        spark.conf.set("spark.checkpoint.dir", root)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    home = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    path = spark._jvm.org.apache.hadoop.fs.Path(home)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return f"{home}/data"
