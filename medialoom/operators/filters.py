"""Document filters.  Those that judge documents keep what they cannot judge."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from medialoom.functions import text, urls
from medialoom.functions.coerce import falsy, wall_clock
from medialoom.functions.text import PERIOD_DAYS, normalize_language
from medialoom.operators.stored import stored

#: Fixed value: characters of an article that is worth attaching.
MIN_ARTICLE = 200


def kept(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(True))


def without_keywords(df: DataFrame, keywords: list[str], fields: tuple[str, ...] = ("body", "title")) -> DataFrame:
    """Drops documents in which any keyword stands, as a part of a word too."""
    if not keywords:
        return df
    said = F.lower(F.concat_ws(" ", *[F.coalesce(F.col(f), F.lit("")) for f in fields]))
    return df.where(~reduce(or_, [said.contains(k.lower()) for k in keywords]))


def cutoff(period: str | None, now: Column) -> Column | None:
    return now - F.expr(f"INTERVAL {PERIOD_DAYS[period]} DAYS") if period in PERIOD_DAYS else None


def since(df: DataFrame, minimum: Column, column: str = "timestamp") -> DataFrame:
    """Wall clocks are compared: an offset is dropped, not applied."""
    return df.where(kept(wall_clock(F.col(column)) >= minimum.cast("timestamp_ntz")))


def in_language(df: DataFrame, language: str | None, detect=None) -> DataFrame:
    """``detect``: a function of the text column, used only on rows without a language."""
    if not language:
        return df
    target = normalize_language(F.lit(language))
    if detect is not None:  # rows with a language give the detector nothing
        said = F.when(falsy(F.col("language")).isNull(), F.coalesce(falsy(F.col("body")), F.col("title")))
        df = df.withColumn("language", F.coalesce(falsy(F.col("language")), detect(said)))
    return df.where(kept(normalize_language(F.col("language")) == target))


def in_place(df: DataFrame, prefix: str | None) -> DataFrame:
    """Geographic ids start with an underscore; other ids say nothing about the place."""
    if not prefix:
        return df
    ids = F.filter(F.col("location_ids"), lambda x: x.startswith("_"))
    own = F.col("author_location_id")
    listed = (F.size(ids) == 0) | F.exists(ids, lambda x: x.startswith(prefix))
    return df.where(kept(F.when(F.size("location_ids") > 0, listed).otherwise(~own.startswith("_") | own.startswith(prefix))))


def not_rejected_before(df: DataFrame, cache: DataFrame, task: str | None, override: bool = False, key: str = "url") -> DataFrame:
    """Drops documents that the cache has as rejected for the task; no id, no cache."""
    if override or not task:
        return df
    bad = cache.where((F.col("task_id") == task) & ~F.col("survived")).select(F.col("url").alias("_bad")).distinct()
    return df.join(bad, df[key] == bad["_bad"], "left_anti")


def over(column: str, threshold: int) -> Column:
    """Gate on a count: absent counts as 0."""
    return F.coalesce(F.col(column), F.lit(0)) > threshold


def has_video(kind: Column, raw_url: Column) -> Column:
    return F.coalesce(kind.isin("Video", "Reel"), F.lit(False)) | falsy(raw_url).isNotNull()


def article_candidates(df: DataFrame, column: str = "url") -> DataFrame:
    return df.where(~urls.is_never_article(F.col(column)))


def usable_comments(df: DataFrame, url: str = "post_url") -> DataFrame:
    ok = falsy(F.col(url)).isNotNull()
    return df.where(ok & F.col("error").isNull() if "error" in df.columns else ok)


def meaningful_article(title: Column, body: Column, least: int = MIN_ARTICLE) -> Column:
    return (F.coalesce(F.trim(title), F.lit("")) != "") & (F.length(F.coalesce(F.trim(body), F.lit(""))) >= least)


def is_stale(updated: Column, now: Column, days: int = 90) -> Column:
    """Missing or unreadable dates are stale."""
    return F.coalesce(now - updated > F.expr(f"INTERVAL {days} DAYS"), F.lit(True))


def batches(df: DataFrame, size: int = 20, order: str = "_ord", within: tuple[str, ...] = ()) -> DataFrame:
    """Adds batch_id and a 1-based batch_index, in order, without a global window.

    The rows are range-sorted and written once, each with its partition and its place in
    it; a row's number is its place after the sizes of the partitions before.  Both are
    read from what was written, so they belong together whatever a later plan reads.
    """
    from pyspark.sql import Window as W

    if within:
        n = F.row_number().over(W.partitionBy(*within).orderBy(order)) - 1
        out = df.withColumn("_n", n.cast("long"))
    else:
        parts = df.repartitionByRange(order).sortWithinPartitions(order).withColumn("_p", F.spark_partition_id())
        parts = stored(parts.withColumn("_k", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)), "batches")
        starts, at = [], 0
        for p, c in sorted(map(tuple, parts.groupBy("_p").count().collect())):  # one row per partition
            starts.append((p, at))
            at += c
        before = df.sparkSession.createDataFrame(starts, "_p int, _before long")
        out = parts.join(before, "_p").withColumn("_n", F.col("_k") + F.col("_before")).drop("_p", "_k", "_before")
    return out.withColumns({"batch_id": F.floor(F.col("_n") / size), "batch_index": (F.col("_n") % size + 1).cast("int")}).drop("_n")


def prompts(batched: DataFrame, snippet: Column, within: tuple[str, ...] = ()) -> DataFrame:
    """One prompt per batch: its documents' lines in order, parted by a blank line."""
    line = text.prompt_line(F.col("batch_index"), F.col("author"), F.col("author_location_text"), F.col("author_profile_bio"), snippet)
    rows = batched.select(*within, "batch_id", "batch_index", line.alias("line"))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("batch_index", "line"))), lambda x: x["line"]), "\n\n")
    return rows.groupBy(*within, "batch_id").agg(joined.alias("prompt"))


def apply_verdicts(batched: DataFrame, replies: DataFrame, within: tuple[str, ...] = ()) -> DataFrame:
    """Keeps the documents whose index is in their batch's reply; a reply that is no list keeps its batch."""
    keep = replies.select(*within, "batch_id", text.reply_indices(F.col("reply")).alias("_keep"))
    joined = batched.join(keep, [*within, "batch_id"], "left")
    return joined.where(kept(F.array_contains("_keep", F.col("batch_index")))).drop("_keep")
