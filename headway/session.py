"""Session set-up and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "headway", **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Lists per trip are short: keep hashing instead of sorting after 128 keys.
        "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "16384",
        # Recording a Python call site for every column expression slows plan building.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **{k.replace("__", "."): str(v) for k, v in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir`` that every executor can reach.

    Where the setting is unset, a local session gets a temporary folder; a
    cluster session has to name a shared one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="headway-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/headway/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and continue from the written table."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
