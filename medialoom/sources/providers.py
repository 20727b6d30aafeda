"""Batch providers for outside services, with deterministic offline stand-ins.

A provider is a function from a DataFrame of requests to one of answers, built on
``mapInPandas``: one call per Arrow batch, retries inside, and no side effects on
import.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, functions as F

TRIES, PAUSE_S = 3, 5.0
PLACE_DDL = "map<string,array<struct<geoid:string,formatted_name:string,precision_level:string>>>"


@dataclass
class Providers:
    model: Callable[[DataFrame], DataFrame] | None = None
    geocode: Callable[[DataFrame], DataFrame] | None = None
    profiles: Callable[[DataFrame], DataFrame] | None = None


def with_retries(call: Callable, tries: int = TRIES, pause: float = PAUSE_S) -> Callable:
    """The call, repeated with pauses; the last failure is raised."""

    def run(*args):
        for k in range(tries):
            try:
                return call(*args)
            except Exception:
                if k + 1 == tries:
                    raise
                time.sleep(pause)

    return run


def model_provider(answer: Callable[[str], str], tries: int = TRIES, pause: float = PAUSE_S) -> Callable[[DataFrame], DataFrame]:
    """Answers ``prompt`` rows by a function of the prompt."""
    ask = with_retries(answer, tries, pause)

    def provider(requests: DataFrame) -> DataFrame:
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for f in frames:
                yield f.assign(answer=[ask(p) for p in f["prompt"]])

        fields = ", ".join(f"{c} {t}" for c, t in requests.dtypes)
        return requests.mapInPandas(run, f"{fields}, answer string")

    return provider


def gazetteer_provider(places: dict[str, str]) -> Callable[[DataFrame], DataFrame]:
    """Finds known place names: in the text for group 1, in the author's own place for group 2."""

    def found(column: str):
        hits = [F.when(F.lower(F.coalesce(F.col(column), F.lit(""))).contains(n.lower()), F.struct(F.lit(g).alias("geoid"), F.lit(n).alias("formatted_name"), F.lit("1").alias("precision_level"))) for n, g in sorted(places.items())]
        return F.array_compact(F.array(*hits)) if hits else F.array()

    return lambda docs: docs.withColumn("groups", F.create_map(F.lit("1"), found("body"), F.lit("2"), found("author_location_text")).cast(PLACE_DDL))


def extracted_articles(pages: DataFrame) -> DataFrame:
    """(url, title, body) of landed pages: the title element and the paragraphs' text.

    Three tiers, each filling what the one before left empty: the article's own heading
    and paragraphs, the head's title, then all the text of the page.
    """
    from medialoom.functions.coerce import falsy
    from medialoom.functions.text import collapse

    html = F.col("html")
    bare = lambda c: collapse(F.regexp_replace(c, r"<[^>]*>", " "))
    body = bare(F.array_join(F.regexp_extract_all(html, F.lit(r"(?is)<p\b[^>]*>(.*?)(?=</p>|<p\b|$)"), F.lit(1)), " "))
    whole = bare(F.regexp_replace(html, r"(?is)<(script|style|head|nav|header|footer|aside)\b.*?</\1>", " "))
    heading = bare(F.regexp_extract(html, r"(?is)<h1\b[^>]*>(.*?)</h1>", 1))
    title = bare(F.regexp_extract(html, r"(?is)<title\b[^>]*>(.*?)</title>", 1))
    return pages.select("url", F.coalesce(falsy(heading), falsy(title)).alias("title"), F.coalesce(falsy(body), falsy(whole)).alias("body"))


PAGE_BYTES = 10_000_000


def page_provider(fetch: Callable[[str], tuple[str, str] | None], tries: int = TRIES, pause: float = PAUSE_S) -> Callable[[DataFrame], DataFrame]:
    """(url, final_url, html) of ``url`` rows; pages that fail or are too large are null.

    ``fetch`` returns (html, final URL); each distinct URL is fetched once.
    """
    get = with_retries(fetch, tries, pause)

    def one(url: str) -> tuple[str | None, str | None]:
        try:
            html, final = get(url)
        except Exception:
            return None, None
        return (None, final) if len(html.encode()) > PAGE_BYTES else (html, final)

    def provider(links: DataFrame) -> DataFrame:
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for f in frames:
                got = [one(u) for u in f["url"]]
                yield f.assign(final_url=[g[1] for g in got], html=[g[0] for g in got])

        return links.select("url").where("url IS NOT NULL").distinct().mapInPandas(run, "url string, final_url string, html string")

    return provider
