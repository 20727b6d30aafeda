"""SimHash near-duplicate groups by multi-index hashing.

A 64-bit fingerprint has two 32-bit segments, each with a table of the distinct
fingerprints by the segment's value.  Of two fingerprints within two bits, one segment
differs in one bit at most, so every fingerprint looks up the 33 values of the radius-1
Hamming ball of each of its segments; what the tables give is verified on the complete
distance.

A value that more than ``DENSE`` fingerprints share is not answered with all of them: its
entries are split by the remaining bits.  They are filed under every value of the
radius-1 ball of the other segment, and a look-up that spent no bit files itself so too,
one that spent a bit goes to its own other segment.  Members of such a key are within
two bits of each of its entries, so a star from the smallest entry has the same
components as all pairs, and a key holds few members however dense the group is.

Defined cases: null text reads as empty; a text without words has fingerprint zero and
links like any other; rows of the same text share a fingerprint; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from medialoom.llm.common import batch_of, materialise, pick, texts_of
from medialoom.llm.components import connected_components

SEED = 42
BLOCK = 1 << 16
DENSE = 32


def fingerprint(text: bytes, width: int) -> int:
    """Majority bits of XXH64 over the shingles of ``width`` words, repeats included."""
    words = text.lower().split()
    n = len(words)
    if not n:
        return 0
    if n < width:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[k:] for k in range(width)), strict=False)))
    return majority(np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), dtype="<u8", count=len(shingles)))


def majority(h: np.ndarray) -> int:
    """The bits that over half of the 64-bit hashes have, as a signed number."""
    votes = np.zeros(64, dtype=np.int64)
    for k in range(0, len(h), BLOCK):
        part = np.ascontiguousarray(h[k : k + BLOCK], dtype="<u8")
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(h), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, width: int = 5) -> DataFrame:
    """doc_id, fp (signed 64-bit)."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield batch_of(schema, doc_id=b.column(0), fp=[fingerprint(x, width) for x in texts_of(b, "text")])

    return pick(docs, doc_id="long", text="string").mapInArrow(run, schema)


def _ball(value: str) -> str:
    """SQL array of the values within one of the lower 32 bits of a value."""
    return f"concat(array({value}), transform(sequence(0, 31), i -> {value} ^ shiftleft(1L, i)))"


def links(fps: DataFrame, dense: int = DENSE) -> DataFrame:
    """Distinct fingerprints (fp) -> pairs (a, b) that differ in one or two bits.

    The pairs have the same components as all pairs within two bits.
    """
    low, high = "fp & 4294967295L", "shiftrightunsigned(fp, 32)"
    # a key is a segment's number in bit 32 above its value
    sides = fps.selectExpr("fp", f"explode(array({low}, {high} | 4294967296L)) AS key")
    sizes = sides.groupBy("key").count()
    stored = sides.join(sizes.where(F.col("count") > dense).select("key", F.lit(True).alias("many")), "key", "left")
    stored, path = materialise(stored.select("key", "fp", F.coalesce("many", F.lit(False)).alias("many")), "segments")
    # a dense value is one marker row in its table
    tables = stored.where("NOT many").select("key", F.col("fp").alias("b")).unionByName(stored.where("many").select("key").distinct().withColumn("b", F.lit(None).cast("long")))
    # 66 rows a fingerprint, of which Spark's estimate counts one: it must never be broadcast
    asked = sides.select("fp", F.expr(f"explode({_ball('key')})").alias("value")).hint("merge")
    met = asked.join(tables, F.col("value") == tables["key"]).select(F.col("fp").alias("a"), "b", "value")
    plain = met.where("b IS NOT NULL AND a <> b")
    low, high = low.replace("fp", "a"), high.replace("fp", "a")
    first = "value < 4294967296L"
    crowd = met.where("b IS NULL").selectExpr("a", "value", f"CASE WHEN {first} THEN {high} ELSE {low} END AS other", f"value = CASE WHEN {first} THEN {low} ELSE {high} | 4294967296L END AS same")
    filed = crowd.select("value", F.expr(f"explode(CASE WHEN same THEN {_ball('other')} ELSE array(other) END)").alias("mid"), "a", "same")
    centers = filed.where("same").groupBy("value", "mid").agg(F.min("a").alias("b"))
    stars = filed.join(centers, ["value", "mid"])
    both = plain.select("a", "b").unionByName(stars.select("a", "b"))
    return both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b AND bit_count(a ^ b) <= 2").distinct()


def near_duplicates(docs: DataFrame, width: int = 5) -> DataFrame:
    """doc_id, fp, component_id: the smallest doc_id reachable over links of <= 2 bits."""
    f, _ = materialise(fingerprints(docs, width), "fingerprints")
    by_fp, _ = materialise(f.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "distinct-fp")
    group = connected_components(links(by_fp.select("fp")))
    linked = by_fp.join(group, by_fp.fp == group.node)
    least = linked.groupBy("label").agg(F.min("least_id").alias("group_id"))
    merged = linked.join(least, "label").select("fp", "group_id")
    final = by_fp.join(merged, "fp", "left").select("fp", F.coalesce("group_id", "least_id").alias("component_id"))
    # f has a row a document and is estimated by its compressed file
    return f.hint("merge").join(final, "fp").select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, width: int = 5) -> DataFrame:
    """Keep, of each group of similar shingle sets, the row of the smallest doc_id (all rows with that id).

    Groups are those of ``resemblance``, for which fingerprints within two bits are candidates.
    """
    from medialoom.llm import resemblance

    return docs.join(resemblance.gone_ids(docs, width), "doc_id", "left_anti").select(docs.columns)


def op4(spark, sf_dir) -> DataFrame:
    from medialoom.llm.common import table

    out = near_duplicates(table(spark, sf_dir, "documents"), width=3)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
