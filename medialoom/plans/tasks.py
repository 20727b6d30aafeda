"""Crawl tasks: rows of a table, parsed by column expressions, run one plan each."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, functions as F

from medialoom.functions.coerce import to_text

#: Columns of a task table, and which arguments every source takes.
COLUMNS = (
    "task_id actor_class search_params country_id language min_date period max_results enabled publish get_comments max_comments not_keywords llm_filter_condition "
    "override_filters enrich_followers fetch_attached_url theme actor_params"
).split()
COMMON = (
    "task_id max_results country_id language min_date period get_comments max_comments not_keywords llm_filter_condition override_filters enrich_followers fetch_attached_url"
).split()


def _flag(c: Column, default: bool) -> Column:
    s = F.lower(to_text(c))
    return F.when(s.isNull(), F.lit(default)).otherwise(s.isin("true", "1", "yes", "t"))


def _items(c: Column, separator: str) -> Column:
    return F.coalesce(F.filter(F.transform(F.split(c, separator), to_text), lambda x: x.isNotNull()), F.array().cast("array<string>"))


def parse_tasks(rows: DataFrame) -> DataFrame:
    """Typed tasks.  An unknown period or unreadable date is ignored; both set is an error."""
    c = {n: F.col(n).cast("string") if n in rows.columns else F.lit(None).cast("string") for n in COLUMNS}
    params = _items(c["search_params"], ",")
    actor = to_text(c["actor_class"])
    period = F.lower(to_text(c["period"]))
    period = F.when(period.isin("d", "w", "m"), period)
    date = to_text(c["min_date"]).try_cast("timestamp")
    out = rows.select(
        F.coalesce(to_text(c["task_id"]), F.concat(actor, F.lit(":"), F.array_join(params, ","))).alias("task_id"),
        actor.alias("actor_class"), params.alias("search_params"), to_text(c["country_id"]).alias("country_id"), to_text(c["language"]).alias("language"),
        date.alias("min_date"), period.alias("period"), F.coalesce(to_text(c["max_results"]).cast("int"), F.lit(30)).alias("max_results"),
        _flag(c["enabled"], True).alias("enabled"), _flag(c["publish"], True).alias("publish"), _flag(c["get_comments"], False).alias("get_comments"),
        F.coalesce(to_text(c["max_comments"]).cast("int"), F.lit(15)).alias("max_comments"), _items(c["not_keywords"], r"\|").alias("not_keywords"),
        to_text(c["llm_filter_condition"]).alias("llm_filter_condition"), _flag(c["override_filters"], False).alias("override_filters"),
        _flag(c["enrich_followers"], False).alias("enrich_followers"), _flag(c["fetch_attached_url"], False).alias("fetch_attached_url"),
        F.lower(to_text(c["theme"])).alias("theme"), to_text(c["actor_params"]).alias("actor_params"),
    )
    both = F.col("min_date").isNotNull() & F.col("period").isNotNull()
    return out.withColumn("error", F.when(both, F.lit("min_date and period are mutually exclusive")))


def runnable(tasks: DataFrame, theme: str | None = None) -> DataFrame:
    chosen = tasks.where("enabled AND error IS NULL")
    return chosen.where(F.col("theme") == theme.lower()) if theme else chosen


def arguments(task) -> dict:
    """Arguments of one task's source: the common ones, overridden by its own."""
    return {n: task[n] for n in COMMON} | json.loads(task["actor_params"] or "{}")


def search_terms(terms: list[str]) -> dict[str, list[str]]:
    """Hashtags, phrases and plain keywords among search terms."""
    bare = [t.strip().strip("\"'") for t in terms]
    kind = lambda t: "hashtags" if t.startswith("#") else "phrases" if " " in t else "keywords"
    return {k: [t.lstrip("#") if k == "hashtags" else t for t in bare if t and kind(t) == k] for k in ("hashtags", "phrases", "keywords")}
