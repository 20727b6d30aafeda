"""Pieces shared by the training-data operators.

Words are maximal runs of characters other than U+0020 and U+0009..U+000D, which
for UTF-8 bytes is exactly what ``bytes.split()`` yields.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T

from medialoom.operators.stored import shared_dir

#: White space that separates words, as a Java regular expression and as characters.
WS_CLASS = r"[\x20\x09-\x0D]"
WS_CHARS = " \t\n\x0b\x0c\r"


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Cut the lineage: write a table in the shared folder and read it again.

    The table survives the loss of any executor, and is written in one pass, whereas
    ``checkpoint()`` computes the last stage twice.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a table of ``materialise`` that nothing reads any more."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **types: str) -> DataFrame:
    """Only the named columns, cast; further columns of any name never clash."""
    return df.select(*[df[c].cast(t).alias(c) for c, t in types.items()])


def texts_of(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """UTF-8 bytes of each text; null reads as empty."""
    return [b"" if x is None else x for x in batch.column(batch.schema.get_field_index(column)).cast(pa.binary()).to_pylist()]


def release() -> None:
    """Hand freed memory of this worker back, which lives on after its task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The batch function, with ``release`` at its end."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release()

    return wrapped


def batch_of(schema: T.StructType, **columns) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(schema)
    arrays = [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, f.type, from_pandas=False) for f in target for c in [columns[f.name]]]
    return pa.RecordBatch.from_arrays([a.combine_chunks() if isinstance(a, pa.ChunkedArray) else a for a in arrays], schema=target)
