"""Folders for tables between jobs, in the place that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where that is unset, a local one, on a local master only."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not where:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        where = tempfile.mkdtemp(prefix="spark-quillon-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A name in the shared folder that nothing has yet."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
