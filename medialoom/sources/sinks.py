"""Sinks: message bodies, run files, rejects, and flat exports."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, functions as F

from medialoom.operators.schema import envelope, flatten

ISO = "yyyy-MM-dd'T'HH:mm:ssXXX"


def message_json(c: Column) -> Column:
    """JSON of an envelope: ISO timestamps, text left as it is, nulls written out."""
    return F.to_json(c, {"timestampFormat": ISO, "ignoreNullFields": "false"})


def bodies(normalized: DataFrame) -> DataFrame:
    """(value): one message body per valid record; rejected ones never become a body."""
    return envelope(normalized.where("error IS NULL")).select(message_json(F.col("envelope")).alias("value"))


def publish_kafka(normalized: DataFrame, servers: str, topic: str) -> None:
    bodies(normalized).write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def publish(normalized: DataFrame, connect: Callable[[], object], tries: int = 3) -> None:
    """Per-partition sending over a connection object with ``send(body)`` and ``close()``.

    A failed send reconnects and repeats the message, at most ``tries`` times; delivery
    is at least once, as a retried task sends its partition again.
    """

    def send(rows: Iterable) -> None:
        link = None
        try:
            for r in rows:
                for k in range(tries):
                    try:
                        link = link or connect()
                        link.send(r.value)
                        break
                    except ConnectionError:
                        link = None
                        if k + 1 == tries:
                            raise
        finally:
            if link is not None:
                link.close()

    bodies(normalized).foreachPartition(send)


def run_file(normalized: DataFrame, path: str, by: str | None = None) -> None:
    """JSON lines of a run; an existing run is never overwritten."""
    rows = envelope(normalized.where("error IS NULL"))
    w = rows.select(*([by] if by else []), "envelope.*").write.mode("error").option("timestampFormat", ISO).option("ignoreNullFields", "false")
    (w.partitionBy(by) if by else w).json(path)


def rejects(normalized: DataFrame, path: str) -> None:
    normalized.where("error IS NOT NULL").write.mode("append").parquet(path)


def flat_csv(df: DataFrame, path: str) -> None:
    flatten(df).write.mode("error").csv(path, header=True, escape='"')
