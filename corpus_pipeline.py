"""The corpus pipeline: five training-data operators, each on what the one before kept.

Each stage takes (spark, docs, sf_dir); all but the last return the columns of
``documents``, with their decisions in effect: rejected and duplicate documents are
gone, failing lines and repeated passages are cut, and the last stage's rows are the
encodings of what is left.

Defined cases: documents without words (null and empty texts too) go with the quality
rules; rows without an id are in no group of near duplicates, and of a group all rows
with its smallest id stay; nulls in other columns and further columns of any name stay
as they are; benchmark items without text leak nowhere; an empty table gives an empty
result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from medialoom.llm import decontaminate, piece_fst, quality, simhash, substring
from medialoom.llm.common import drop_path, scratch_path, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.clean(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substring.remove(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return piece_fst.encoded(docs, public_tokenizers.path("piece_bpe_32k.model"), memo=100_000)


STAGES = [
    ("quality rules", quality_rules),
    ("near dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("decontamination", decontamination),
    ("encoding", encoding),
]
#: SQL can't express fingerprints, edit verification or encodings: tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        if before is not None:  # its reader's result is whole, so nothing reads it any more
            drop_path(spark, before)
        docs, before = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
