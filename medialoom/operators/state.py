"""Keyed state: profiles, filter outcomes, caches; merged as tables, swapped by version.

Plain Parquet has no MERGE, so a merge is a full outer join written as the next version
of the table; readers take the latest complete version and a crash leaves the old one.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from medialoom.functions.text import cache_key  # noqa: F401  (part of this module's surface)
from medialoom.functions.urls import without_final_slash
from medialoom.operators.stored import stored


def canonical_users(users: DataFrame, order: str = "_ord") -> DataFrame:
    """Keys that differ by a final slash collapse; the last row counts."""
    fields = [c for c in users.columns if c not in ("profile_url", order)]
    keyed = users.withColumn("profile_url", without_final_slash(F.col("profile_url")))
    return keyed.groupBy("profile_url").agg(F.max_by(F.struct(*fields), order).alias("v")).select("profile_url", "v.*")


def merge(old: DataFrame, new: DataFrame, key: list[str], nulls_overwrite: bool, stamp: dict[str, Column] | None = None) -> DataFrame:
    """Upsert.  Columns that only one side has are kept; ``stamp`` is set on touched rows."""
    stamp = stamp or {}
    columns = list(dict.fromkeys([*old.columns, *new.columns, *stamp]))
    types = {f.name: f.dataType for f in [*new.schema, *old.schema]}
    o = old.select(F.struct(*old.columns).alias("o"), *[F.col(k).alias(f"_o_{k}") for k in key])
    n = new.select(F.struct(*new.columns).alias("n"), *[F.col(k).alias(f"_n_{k}") for k in key])
    on = [o[f"_o_{k}"].eqNullSafe(n[f"_n_{k}"]) for k in key]
    both = o.join(n, on, "full")
    touched = F.col("n").isNotNull()
    out = []
    for c in columns:
        before = F.col("o")[c] if c in old.columns else F.lit(None).cast(types.get(c, "string"))
        if c in key:
            v = F.coalesce(before, F.col("n")[c])
        elif c in stamp:
            v = F.when(touched, stamp[c]).otherwise(before)
        elif c not in new.columns:
            v = before
        elif nulls_overwrite:
            v = F.when(touched, F.col("n")[c]).otherwise(before)
        else:
            v = F.coalesce(F.col("n")[c], before)
        out.append(v.alias(c))
    return both.select(*out)


def merge_user_stats(users: DataFrame, stats: DataFrame, now: Column) -> DataFrame:
    """New figures replace stored ones, nulls too, and the date is set."""
    return merge(users, stats.withColumn("profile_url", without_final_slash(F.col("profile_url"))), ["profile_url"], True, {"date_stats_updated": now})


def merge_user_places(users: DataFrame, places: DataFrame) -> DataFrame:
    return merge(users, places.withColumn("profile_url", without_final_slash(F.col("profile_url"))), ["profile_url"], False)


def filter_outcomes(docs: DataFrame, survivors: DataFrame, task: str, url: str = "url", order: str = "_ord") -> DataFrame:
    """(task_id, url, survived) of every input document that has a URL; the last document of a URL counts.

    Documents are told apart by ``order``, which survivors carry.
    """
    s = survivors.select(F.col(order).alias("_s"), F.lit(True).alias("_ok")).distinct()
    judged = docs.where(F.col(url).isNotNull()).select(F.col(url).alias("url"), F.col(order).alias("_o")).join(s, F.col("_o") == F.col("_s"), "left")
    rows = judged.groupBy("url").agg(F.max_by(F.coalesce("_ok", F.lit(False)), "_o").alias("survived"))
    return rows.select(F.lit(task).alias("task_id"), "url", "survived")


def merge_filter_cache(cache: DataFrame, outcomes: DataFrame) -> DataFrame:
    return merge(cache, outcomes, ["task_id", "url"], True)


def has_place(users: DataFrame) -> DataFrame:
    return users.where(F.coalesce(F.col("location_author_geoid"), F.lit("")) != "")


def request_key(condition: Column, content: Column) -> Column:
    return F.sha2(F.concat_ws("\n", condition, content), 256)


def cached_call(requests: DataFrame, cache: DataFrame | None, provider) -> tuple[DataFrame, DataFrame]:
    """(answered requests, new cache rows): only requests that the cache lacks are sent, each once, and answers are written before they are used."""
    asked = requests.select("request", "prompt")
    if cache is not None:
        asked = asked.join(cache.select("request"), "request", "left_anti")
    new = stored(provider(asked.groupBy("request").agg(F.first("prompt").alias("prompt"))).select("request", "answer"), "answers")
    known = new if cache is None else cache.select("request", "answer").unionByName(new)
    return requests.join(known, "request"), new


class VersionedTable:
    """A Parquet table whose overwrite is a new version folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _versions(self) -> list[str]:
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(root)]
        done = lambda n: fs.exists(jvm.org.apache.hadoop.fs.Path(f"{self.path}/{n}/_SUCCESS"))
        return sorted(n for n in names if n.startswith("v=") and done(n))

    def read(self, schema) -> DataFrame:
        versions = self._versions()
        return self.spark.read.schema(schema).parquet(f"{self.path}/{versions[-1]}") if versions else self.spark.createDataFrame([], schema)

    def write(self, df: DataFrame) -> str:
        name = f"v={time.time_ns():020d}"
        df.write.parquet(f"{self.path}/{name}")
        return name
