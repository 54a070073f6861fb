"""Session builder with the settings that the operators count on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def session(master: str | None = None, **conf: str) -> SparkSession:
    """UTC for all times and adaptive execution; partition counts are left to the cluster."""
    builder = SparkSession.builder.appName("anchorline")
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
    return builder.config(map=defaults | conf).getOrCreate()


def with_checkpoints(spark: SparkSession) -> SparkSession:
    """The session with a checkpoint folder: the one it names, a temporary one only if a session on one machine names none."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and sc.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="anchorline-"))
    return spark
