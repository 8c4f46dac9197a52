"""Spark sessions for tests, benches and local runs; a cluster brings its own."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, partitions: int = 8, **conf: str) -> SparkSession:
    """A UTC, ANSI, AQE session on local[cores]."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("driftfold")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, which driver and executors share; a folder of this machine only where all run in one process."""
    conf = spark.sparkContext.getConf()
    if not spark.sparkContext.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir")
        if not named and not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(named or "file://" + tempfile.mkdtemp(prefix="driftfold-"))
    return (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()).rstrip("/")
