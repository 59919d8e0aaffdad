"""Session settings and the shared folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def build_session(cores: str = "*", app_name: str = "telemill", **conf: str) -> SparkSession:
    """A local session for tests and the benchmark; on a cluster use the one you are given."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_utc(spark: SparkSession) -> None:
    """Day and hour keys are UTC, so that every session files a message under the same day."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name below the shared folder of the cluster, `spark.checkpoint.dir`."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return os.path.join(base, f"{purpose}-{uuid.uuid4().hex}")
