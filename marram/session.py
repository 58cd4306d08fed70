"""Session settings the operators are developed against."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time and adaptive execution.

    Nothing in the package needs these settings to be right; they keep years
    independent of the machine's zone and let Spark split skewed join
    partitions. ``conf`` uses ``__`` for dots: ``spark__sql__shuffle__partitions``.
    """
    builder = SparkSession.builder.appName("marram")
    if master is not None:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """The folder for stored tables that the driver and all executors see.

    That of ``spark.checkpoint.dir``; where it is unset, a folder in the
    warehouse on a cluster and a temporary one in a local session.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        master = spark.sparkContext.master
        if master.startswith("local") and not master.startswith("local-"):
            folder = tempfile.mkdtemp(prefix="marram-")
        else:
            folder = spark.conf.get("spark.sql.warehouse.dir") + "/_work"
        spark.sparkContext.setCheckpointDir(folder)
        folder = spark.sparkContext.getCheckpointDir()
    return folder
