"""Scans: landed scraper payloads, dimensions, tasks, question sheets; and a Python source.

``scraper_source`` makes a Python data source whose requests carry limits, dates, periods
and languages to the scraper; scrapers are callables registered per platform.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from medialoom.functions.text import PERIOD_WORDS, POSTED_LIMITS
from medialoom.plans.tasks import search_terms

#: How many results a source asks for when a task says nothing.
DEFAULT_RESULTS = {"facebook_keyword_search": 20, "facebook_page_posts": 20, "google_news": 30, "instagram_hashtags": 10, "instagram_profile_posts": 10, "linkedin_keyword_search": 30, "twitter_keyword_search": 30}


def landed_json(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines as (raw, _ord); order follows file and position."""
    return spark.read.text(path).where("value <> ''").select(F.col("value").alias("raw"), F.monotonically_increasing_id().alias("_ord"))


def source_dimension(spark: SparkSession, path: str) -> DataFrame:
    """One row per publisher domain, with its place where it has one."""
    s = spark.read.json(path)
    stats = s.schema["stats"].dataType.names
    names = ["location_author_formatted_name", "location_author_geoid", "location_author_coords", "location_author_precision_level"] + [f"location_author_level_{k}{x}" for k in (1, 2, 3) for x in ("", "_id")]
    cols = [F.col(f"stats.{n}").alias(n) for n in names if n in stats]
    more = [F.col("stats.location_author_formatted_name").alias("author_location_text"), F.col("stats.location_author_geoid").alias("author_location_id")] if "location_author_geoid" in stats else []
    return s.select("domain", "sitio", *cols, *more)


def task_table(spark: SparkSession, path: str) -> DataFrame:
    """A task sheet saved as CSV, every cell as text."""
    return spark.read.csv(path, header=True, inferSchema=False, multiLine=True, escape='"')


def question_sheet(spark: SparkSession, path: str) -> DataFrame:
    q = spark.read.csv(path, header=True, inferSchema=False, multiLine=True, escape='"')
    return q.where(F.col("no").try_cast("int").isNotNull()).withColumn("no", F.col("no").cast("int"))


def scrape_request(platform: str, params: list[str], task: dict) -> dict:
    """What a scraper is asked for: terms, limit, and what it can filter itself."""
    limit = task.get("max_results") or DEFAULT_RESULTS[platform]
    least = str(task["min_date"])[:10] if task.get("min_date") else None
    period = task.get("period")
    if platform == "google_news":
        out = {"keywords": params, "maxArticles": limit, "timeframe": PERIOD_WORDS.get(period, "1d"), "region_language": "MX:es-419", "decodeUrls": True, "extractDescriptions": True}
    elif platform == "instagram_hashtags":
        out = {"hashtags": params, "resultsType": "posts", "resultsLimit": limit, "keywordSearch": bool(task.get("keyword_search"))}
    elif platform == "instagram_profile_posts":
        out = {"directUrls": params, "resultsType": "posts", "resultsLimit": limit}
    elif platform == "facebook_page_posts":
        out = {"startUrls": [{"url": u} for u in params], "resultsLimit": limit, "captionText": False, "onlyPostsNewerThan": least}
    elif platform == "facebook_keyword_search":
        out = {"queries": params, "max_results": limit, "start_date": least}
    elif platform == "twitter_keyword_search":
        terms = search_terms(params)
        out = {**terms, "maxItems": max(20, limit), "lang": task.get("language"), "since": least, "query": None if any(terms.values()) else " OR ".join(params)}
    elif platform == "linkedin_keyword_search":
        out = {"searchQueries": params, "maxPosts": limit, "sortBy": "date", "postedLimit": POSTED_LIMITS.get(period)}
    else:
        raise KeyError(f"unknown source {platform!r}; known: {', '.join(sorted(DEFAULT_RESULTS))}")
    return {k: v for k, v in out.items() if v is not None}


#: Scrapers by platform: request -> payloads.
SCRAPERS: dict[str, Callable[[dict], list[dict]]] = {}


class Query(InputPartition):
    def __init__(self, request: dict):
        self.request = request


class ScraperReader(DataSourceReader):
    """One partition a request, in their order."""

    def __init__(self, requests: list[dict], scrape: Callable[[dict], list[dict]]):
        self.requests, self.scrape = requests, scrape

    def partitions(self):
        return [Query(r) for r in self.requests]

    def read(self, partition) -> Iterator[tuple]:
        for k, item in enumerate(self.scrape(partition.request)):
            yield json.dumps(item, ensure_ascii=False), k


def scraper_source(platform: str) -> type[DataSource]:
    """A data source of its own for a platform: its scraper travels inside the class."""
    scrape = SCRAPERS[platform]

    class Scraper(DataSource):
        @classmethod
        def name(cls) -> str:
            return f"scraper_{platform}"

        def schema(self) -> str:
            return "raw string, position long"

        def reader(self, schema) -> DataSourceReader:
            return ScraperReader(json.loads(self.options["requests"]), scrape)

    return Scraper


def scraped(spark: SparkSession, platform: str, requests: list[dict]) -> DataFrame:
    """(raw, _ord) of all requests, in their order."""
    source = scraper_source(platform)
    spark.dataSource.register(source)
    df = spark.read.format(source.name()).option("requests", json.dumps(requests)).load()
    return df.select("raw", F.monotonically_increasing_id().alias("_ord"))
