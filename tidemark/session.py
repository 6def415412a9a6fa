"""Session helpers: a local session for tests and benchmarks, the shared folder of a cluster."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def local_session(cores: str = "*", app: str = "tidemark", **conf: str) -> SparkSession:
    """A local session. On a cluster the submitter brings the session instead."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder, visible to all executors, under ``spark.checkpoint.dir``.

    Where that is unset, as in local sessions, the folder lies in the warehouse
    directory, which any cluster shares too.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    root = root or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/work"
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
