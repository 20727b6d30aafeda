"""The staged pipeline: an order of stages per source, each a DataFrame transformation.

Stages are looked up by letter, so that a source can reorder or replace them.  Native
filters come before anything that needs a provider; what a provider answers is written
once before the plan goes on, and no stage reads its input twice without writing it.

What stages learn besides documents - profiles, places of authors, unknown sources,
model answers - is left in ``Context.results`` for the caller to save.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, functions as F

from medialoom.functions.python_text import detect_language, snippet
from medialoom.operators import enrich, filters, lookups, state
from medialoom.operators.stored import stored
from medialoom.sources.providers import Providers

#: Fixed values.  K keywords, D date, C content, L language, A author, G geocoding, P place, 1 and 2 model passes, M comments, F first-comment link.
ORDERS = {
    "google_news": "KDCLAGP12M",
    "facebook_page_posts": "KDCLAGP12MF",
    "facebook_keyword_search": "KDCL12AGPM",
    "instagram_hashtags": "KDCLGP1A2M",
    "instagram_profile_posts": "KDCLGP1A2M",
    "linkedin_keyword_search": "KDCLGP1A2M",
    "twitter_keyword_search": "KDCLGP12M",
}
SNIPPETS = {"1": 250, "2": 2500}


@dataclass
class Context:
    """What stages read: the task's arguments, dimension tables and providers."""

    task: dict
    providers: Providers = field(default_factory=Providers)
    sources: DataFrame | None = None
    users: DataFrame | None = None
    articles: DataFrame | None = None
    comments: DataFrame | None = None
    cache: DataFrame | None = None
    now: str | None = None
    keywords: list[str] = field(default_factory=list)
    answers: DataFrame | None = None
    counters: dict[str, Observation] | None = None
    results: dict[str, DataFrame] = field(default_factory=dict)

    def at(self):
        return F.current_timestamp() if self.now is None else F.lit(self.now).cast("timestamp")


def keyword_stage(df: DataFrame, c: Context) -> DataFrame:
    return filters.without_keywords(df, c.task.get("not_keywords") or [])


def date_stage(df: DataFrame, c: Context) -> DataFrame:
    least = c.task.get("min_date")
    limit = F.lit(least).cast("timestamp") if least else filters.cutoff(c.task.get("period"), c.at())
    return df if limit is None else filters.since(df, limit)


def content_stage(df: DataFrame, c: Context) -> DataFrame:
    if c.task.get("add_text_from_images") and "_raw" in df.columns:
        df = enrich.with_ocr(df)
    if not c.task.get("fetch_attached_url") or c.articles is None:
        return df
    link = F.get_json_object("_raw", "$.external_url") if "_raw" in df.columns else F.lit(None).cast("string")
    link = F.coalesce(link, F.get_json_object("_raw", "$.link")) if "_raw" in df.columns else link
    return lookups.attach_articles(df, c.articles, lookups.article_link(link, F.col("body"), F.col("url")))


def language_stage(df: DataFrame, c: Context) -> DataFrame:
    return filters.in_language(df, c.task.get("language"), detect_language)


def author_stage(df: DataFrame, c: Context) -> DataFrame:
    if c.users is None:
        return df
    if c.task.get("enrich_followers") and c.providers.profiles:
        df = stored(df, "documents")
        stale = lookups.stale_profiles(df, c.users, c.at())
        c.users = c.results["users"] = stored(state.merge_user_stats(c.users, c.providers.profiles(stale), c.at()), "users")
    return lookups.fill_from_users(df, c.users)


def geocode_stage(df: DataFrame, c: Context) -> DataFrame:
    """Articles take their source's place; posts their author's, and the rest are geocoded."""
    news = F.coalesce(F.col("type") == "news", F.lit(False))
    if c.sources is not None:
        df = lookups.source_places(df, c.sources, only=news)
        seen = df.where(news).select(lookups.urls.registrable_domain(F.col("url")).alias("domain"), "url", "source")
        c.results["unknown_sources"] = lookups.unknown_sources(seen, c.sources)
    if c.users is not None and "location_author_geoid" in c.users.columns:
        fields = tuple(f for f in lookups.PLACE if f in c.users.columns)
        df = lookups.fill_from_users(df, c.users, fields, needs="location_author_geoid", only=~news)
    if c.providers.geocode:
        df = stored(df, "documents")
        open_ = ~news & F.col("location_author_geoid").isNull()
        found = stored(lookups.geocoded(c.providers.geocode(df.where(open_))), "geocoded")
        df = df.where(~open_).unionByName(found.select(df.columns))
        if c.users is not None:
            c.results["users"] = state.merge_user_places(c.users, lookups.author_places(found, c.users))
    return df


def place_stage(df: DataFrame, c: Context) -> DataFrame:
    return filters.in_place(df, c.task.get("country_id"))


def model_stage(size: int) -> Callable[[DataFrame, Context], DataFrame]:
    def run(df: DataFrame, c: Context) -> DataFrame:
        condition = c.task.get("llm_filter_condition")
        if not condition or not c.providers.model:
            return df
        batched = filters.batches(df)
        asked = filters.prompts(batched, snippet(F.col("body"), c.keywords, size))
        asked = asked.withColumn("request", state.request_key(F.lit(condition), F.col("prompt")))
        answered, new = state.cached_call(asked, None if c.task.get("override_filters") else c.answers, c.providers.model)
        c.answers = c.results["answers"] = new if c.answers is None else c.answers.select("request", "answer").join(new, "request", "left_anti").unionByName(new)
        replies = answered.select("batch_id", F.col("answer").alias("reply"))
        return filters.apply_verdicts(batched, replies).drop("batch_id", "batch_index")

    return run


def comment_stage(df: DataFrame, c: Context) -> DataFrame:
    if not c.task.get("get_comments") or c.comments is None:
        return df
    return lookups.attach_comments(df, lookups.grouped_comments(c.comments, most=c.task.get("max_comments")))


def first_comment_stage(df: DataFrame, c: Context) -> DataFrame:
    """Where no article is attached yet, the first comment's link is tried."""
    if not c.task.get("fetch_attached_url") or c.articles is None or "attached_news" not in df.columns:
        return df
    said = F.get("comments", F.lit(0))["comment_text"]
    link = F.when(F.col("_had").isNull(), lookups.article_link(F.lit(None).cast("string"), said, F.col("url")))
    again = lookups.attach_articles(df.withColumnRenamed("attached_news", "_had"), c.articles, link)
    return again.withColumn("attached_news", F.coalesce("_had", "attached_news")).select(df.columns)


STAGES: dict[str, Callable[[DataFrame, Context], DataFrame]] = {
    "K": keyword_stage, "D": date_stage, "C": content_stage, "L": language_stage, "A": author_stage, "G": geocode_stage, "P": place_stage,
    "1": model_stage(SNIPPETS["1"]), "2": model_stage(SNIPPETS["2"]), "M": comment_stage, "F": first_comment_stage,
}


def order_of(source: str) -> str:
    if source not in ORDERS:
        raise KeyError(f"unknown source {source!r}; known: {', '.join(sorted(ORDERS))}")
    return ORDERS[source]


def process(docs: DataFrame, source: str, c: Context, stages: dict | None = None) -> DataFrame:
    """Documents that survive the source's stages.

    Flags that the source does not support raise before anything runs.  With
    ``c.counters`` every stage's rows are counted as they pass, without a job of its own.
    """
    letters = order_of(source)
    platform = source if source.startswith("instagram") else source.split("_")[0]
    enrich.check_content(platform, c.task)
    table = STAGES | (stages or {})
    out = docs
    if c.cache is not None:
        out = filters.not_rejected_before(out, c.cache, c.task.get("task_id"), c.task.get("override_filters", False))
    for letter in letters:
        out = table[letter](out, c)
        if c.counters is not None:
            c.counters[letter] = Observation(f"after-{letter}")
            out = out.observe(c.counters[letter], F.count(F.lit(1)).alias("rows"))
    return out


def run_task(docs: DataFrame, source: str, c: Context) -> tuple[DataFrame, DataFrame]:
    """(surviving documents, the filter cache's new rows); further state is in ``c.results``."""
    kept = stored(process(docs, source, c), "survivors")
    return kept, state.filter_outcomes(docs, kept, c.task.get("task_id") or "")
