"""The pipeline over a stream: new documents only, late ones bounded by a watermark."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F


def unseen(stream: DataFrame, key: str = "url", at: str = "event_time", late: str = "1 day") -> DataFrame:
    """The first arrival of each key; state older than the watermark is dropped."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark([key])


def counts_by_window(stream: DataFrame, at: str = "event_time", width: str = "1 hour", by: str = "type", late: str = "1 day") -> DataFrame:
    return stream.withWatermark(at, late).groupBy(F.window(at, width), by).agg(F.count("*").alias("n"))


def run_available(stream: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str):
    """Runs everything that has arrived through ``apply`` once, restartably."""
    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
