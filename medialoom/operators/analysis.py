"""Descriptions of video posts: prompts per section, answers, figures, one record.

Each post is asked one question set per section.  Sections are rows, so they run side
by side; a failed section becomes an ``_error`` and does not touch the others.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from medialoom.functions import text
from medialoom.functions.coerce import first_truthy

#: Which numbered questions a section asks.
SECTIONS = {
    "post_info": [2, 6, 8, 9, 12, 14],
    "context": list(range(15, 29)),
    "character": [*range(29, 40), 46],
    "plot": [40, 41, 42, 43, 45],
    "drawing": list(range(47, 61)),
    "messaging": list(range(61, 68)),
    "comments": [69, 70, 71],
}


def section_table(spark) -> DataFrame:
    return spark.createDataFrame(list(SECTIONS.items()), "section string, numbers array<int>")


def prompts(posts: DataFrame, questions: DataFrame, key: str = "url") -> DataFrame:
    """(key, section, prompt) of every post and section.

    The handful of sections travels to the posts, whatever their number.
    """
    asked = questions.where(F.col("section").isin(*SECTIONS)).select("section", "questions").collect()  # one row per section
    q = F.array(*[F.struct(F.lit(r.section).alias("section"), F.lit(r.questions).alias("questions")) for r in asked])
    rows = posts.select(key, "body", F.explode(q).alias("q"))
    prompt = F.concat(F.lit("Section: "), F.col("q.section"), F.lit("\nCaption: "), F.coalesce("body", F.lit("")), F.lit("\n\n"), F.col("q.questions"))
    return rows.select(key, F.col("q.section").alias("section"), prompt.alias("prompt"))


def answered(asked: DataFrame, answer: Callable[[str], dict], key: str = "url") -> DataFrame:
    """(key, section, answer): the answer as JSON, or its failure."""

    def one(prompt: str) -> str:
        try:
            return json.dumps(answer(prompt), ensure_ascii=False)
        except Exception as e:
            return json.dumps({"_error": str(e)}, ensure_ascii=False)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield f[[key, "section"]].assign(answer=[one(p) for p in f["prompt"]])

    return asked.mapInPandas(run, f"{key} {dict(asked.dtypes)[key]}, section string, answer string")


def meta_fields(body: Column, kind: Column) -> Column:
    """Figures of a caption that no model is needed for."""
    b = F.coalesce(body, F.lit(""))
    return F.struct(
        kind.alias("post_type"),
        text.post_format(kind).alias("post_format"),
        text.hashtag_count(b).alias("hashtag_count"),
        text.mention_count(b).alias("mention_count"),
        text.word_count(b).alias("caption_word_count"),
        text.emoji_percent(b).alias("emoji_pct"),
    )


def records(posts: DataFrame, answers: DataFrame, key: str = "url") -> DataFrame:
    """One record per post: its sections, its figures, and the characters found."""
    pivot = answers.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("section", "answer"))).alias("_s"))
    j = posts.join(pivot, key, "left")
    part = lambda n: F.try_element_at("_s", F.lit(n))
    who = part("character")
    sound = F.get_json_object(who, "$._error").isNull()
    characters = F.coalesce(F.when(sound, F.from_json(F.get_json_object(who, "$.characters"), "array<string>")), F.array().cast("array<string>"))
    return j.select(
        F.col(key).alias("post_url"),
        F.when(sound, F.get_json_object(who, "$.character_count_label")).alias("character_count_label"),
        F.when(sound, F.get_json_object(who, "$.has_voiceover").try_cast("boolean")).alias("has_voiceover"),
        F.struct(part("post_info").alias("answers"), "timestamp", meta_fields(F.col("body"), F.col("post_type")).alias("meta"), "likes", "views", "shares").alias("post_info"),
        *[part(n).alias(n) for n in ("context", "plot", "drawing", "messaging")],
        characters.alias("characters"),
        F.struct(part("comments").alias("answers"), F.col("n_comments").alias("comment_count")).alias("comment_insights"),
    )


def fill_gaps(*tiers: Column) -> Column:
    """The first tier of a parser that found something."""
    return first_truthy(*tiers)
