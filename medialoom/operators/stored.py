"""Tables written once in the cluster's shared folder and read again.

What a provider answered, and rows whose order was settled by a shuffle, must not be
computed a second time: the next run of the same plan could give something else.
"""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


@functools.cache
def _own_dir() -> str:
    """One folder a process: the setting belongs to the context and cannot be changed while it runs."""
    return "file://" + tempfile.mkdtemp(prefix="medialoom-")


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; in local mode one of our own, where none is set."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir names no folder that driver and executors share")
        found = _own_dir()
    return found.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
