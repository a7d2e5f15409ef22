"""Session settings that the operators rely on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(name: str = "freshet", **conf: str) -> SparkSession:
    """UTC clocks, ANSI arithmetic and adaptive execution; everything else stays as the cluster has it."""
    builder = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").config("spark.sql.ansi.enabled", "true").config("spark.sql.adaptive.enabled", "true")
    for k, v in conf.items():
        builder = builder.config(k.replace("__", "."), v)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Lets Python workers on this machine import the package from where the driver has it (clusters: --py-files)."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in paths.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, paths]))


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``; only a local session may go without that setting."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("freshet.shared.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="freshet-")
        spark.conf.set("freshet.shared.dir", base)
    return f"{base.rstrip('/')}/freshet/{name}-{uuid.uuid4().hex[:12]}"


def cut(df: DataFrame, name: str = "step") -> DataFrame:
    """Writes a step of an iteration to the shared folder and reads it back, so that lineage stays short."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
