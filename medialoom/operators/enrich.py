"""Second scans of a post's author and comments, and what they bring, per platform.

A scan is a request of distinct keys, a provider, and a projection of its payloads; the
results meet the posts through the joins of ``lookups``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from medialoom.functions import text, urls
from medialoom.functions.coerce import falsy, first_truthy
from medialoom.operators import lookups, mappers

#: Comments a post when a task says nothing, what a generic image text starts with, and flags by platform.
MAX_COMMENTS = 15
GENERIC_IMAGE = "May be an image of"
CONTENT_FLAGS = ("fetch_attached_url", "download_images", "download_video", "add_text_from_images", "add_subtitles", "add_ai_transcription")
WORKS = {
    "facebook": {"fetch_attached_url", "add_text_from_images"},
    "instagram_hashtags": {"fetch_attached_url"},
    "instagram_profile_posts": {"fetch_attached_url", "download_video"},
    "other": {"fetch_attached_url"},
}


# --- requests ---------------------------------------------------------------
def profile_request(platform: str, keys: list[str]) -> dict:
    """What a profile scan asks for: pages, user names, or one post per author."""
    if platform == "facebook":
        return {"startUrls": [{"url": u} for u in keys]}
    if platform == "instagram":
        return {"usernames": [u.rstrip("/").rsplit("/", 1)[-1] for u in keys]}
    if platform == "linkedin":
        return {"searchQueries": [""], "authorUrls": keys, "maxPosts": 1, "profileScraperMode": "main"}
    raise KeyError(f"no profile scan for {platform!r}")


def comment_request(platform: str, post_urls: list[str], most: int = MAX_COMMENTS) -> dict:
    if platform == "facebook":
        return {"startUrls": [{"url": u} for u in post_urls], "resultsLimit": most}
    if platform == "instagram":
        return {"directUrls": post_urls, "resultsLimit": most}
    if platform == "linkedin":
        return {"searchQueries": [""], "authorUrls": post_urls, "maxPosts": 1, "scrapeComments": True, "maxComments": most, "postNestedComments": True}
    raise KeyError(f"no comment scan for {platform!r}")


def keyword_requests(queries: list[str], most: int, start_date: str | None = None, recent: bool = True, place: str | None = None) -> list[dict]:
    """One request a query; what several queries find is deduplicated by ``searched``."""
    more = {k: v for k, v in (("start_date", start_date), ("location_uid", place)) if v}
    return [{"query": q, "search_type": "posts", "max_results": most, "recent_posts": recent, **more} for q in queries]


def searched(raw: DataFrame) -> DataFrame:
    """Payloads (raw, _ord) of several queries, the first of each post; those without a URL all stay."""
    keyed = raw.withColumns({"post_url": F.get_json_object("raw", "$.post_url"), "url": F.get_json_object("raw", "$.url")})
    return lookups.dedupe_first_wins(keyed).select(raw.columns)


def commented_posts(posts: DataFrame, platform: str) -> DataFrame:
    """Distinct URLs whose comments are scanned; where counts are known, only posts that have some."""
    has = falsy(F.col("url")).isNotNull()
    return posts.where(has & (F.coalesce("n_comments", F.lit(0)) > 0) if platform == "linkedin" else has).select("url").distinct()


# --- payloads ---------------------------------------------------------------
_RAW = {
    "facebook": "text string, profileName string, date string, likesCount bigint, postUrl string, facebookUrl string",
    "instagram": "text string, ownerUsername string, timestamp string, likesCount bigint, postUrl string, inputUrl string",
    "linkedin": "url string, postUrl string, comments array<struct<text:string,content:string,author:struct<name:string>,postedAt:string,createdAt:string,likesCount:bigint,numLikes:bigint>>",
}


def _parsed(raw: DataFrame, ddl: str) -> DataFrame:
    return raw.select("_ord", "raw", F.from_json("raw", T._parse_datatype_string(ddl)).alias("r"))


def comments(raw: DataFrame, platform: str) -> DataFrame:
    """(post_url, _ord, comment) of scanned payloads; ones with an error, or of no post, are left out.

    A LinkedIn payload is a post with its comments: the last payload of a post counts.
    """
    r, p = F.col("r"), _parsed(raw, _RAW[platform])
    if platform == "linkedin":
        items = lookups.last_comments(p.select(first_truthy(r["url"], r["postUrl"]).alias("post_url"), "_ord", F.coalesce(r["comments"], F.array().cast(p.schema["r"].dataType["comments"].dataType)).alias("comments")))
        c = F.col("c")
        said = mappers.comment(first_truthy(c["text"], c["content"]), c["author"]["name"], first_truthy(c["postedAt"], c["createdAt"]), first_truthy(c["likesCount"], c["numLikes"], kind="bigint"))
        return items.select("post_url", F.posexplode("comments").alias("_ord", "c")).select("post_url", F.col("_ord").cast("long").alias("_ord"), said.alias("comment"))
    ok = F.get_json_object("raw", "$.error").isNull()
    if platform == "facebook":
        url, said = first_truthy(r["postUrl"], r["facebookUrl"]), mappers.comment(r["text"], r["profileName"], r["date"], r["likesCount"])
    else:
        url, said = first_truthy(r["postUrl"], r["inputUrl"]), mappers.comment(r["text"], r["ownerUsername"], r["timestamp"], r["likesCount"])
    return p.where(ok & url.isNotNull()).select(url.alias("post_url"), "_ord", said.alias("comment"))


_PROFILES = {
    "instagram": "username string, fullName string, biography string, followersCount bigint",
    "linkedin": "author struct<linkedinUrl:string,url:string,name:string,headline:string,about:string,location:string,locationName:string,followersCount:bigint,connectionsCount:bigint>",
}


def profiles(raw: DataFrame, platform: str) -> DataFrame:
    """(_ord, key, figures) of scanned profiles: by user name for Instagram, by URL for LinkedIn, by any page name for Facebook."""
    if platform == "facebook":
        p = _parsed(raw, mappers.FACEBOOK_PAGE_RAW)
        r = F.col("r")
        f = mappers.facebook_page(r)
        names = F.array_distinct(F.array_compact(F.array(falsy(r["pageName"]), urls.page_slug(r["facebookUrl"]), urls.page_slug(r["pageUrl"]))))
        return p.select("_ord", F.explode(names).alias("key"), *[c.alias(n) for n, c in f.items()])
    p = _parsed(raw, _PROFILES[platform])
    r = F.col("r")
    if platform == "instagram":
        out = p.select("_ord", falsy(r["username"]).alias("key"), r["followersCount"].alias("website_visits"), first_truthy(r["fullName"], r["username"]).alias("author"), r["fullName"].alias("author_full_name"), r["biography"].alias("author_profile_bio"))
    else:
        a = r["author"]
        out = p.select(
            "_ord", first_truthy(a["linkedinUrl"], a["url"]).alias("key"), first_truthy(a["followersCount"], a["connectionsCount"], kind="bigint").alias("website_visits"), a["name"].alias("author"),
            a["name"].alias("author_full_name"), first_truthy(a["headline"], a["about"]).alias("author_profile_bio"), first_truthy(a["location"], a["locationName"]).alias("author_location_text"),
        )
    return out.where("key IS NOT NULL")


def profile_key(platform: str, profile_url: Column) -> Column:
    """What a post's author is looked up by."""
    if platform == "facebook":
        return urls.page_slug(profile_url)
    if platform == "instagram":
        return F.nullif(F.regexp_extract(F.rtrim(profile_url, F.lit("/")), r"([^/]*)$", 1), F.lit(""))
    return falsy(profile_url)


def author_stats(posts: DataFrame, found: DataFrame, platform: str) -> DataFrame:
    """Stats rows for ``state.merge_user_stats`` of the posts' authors that a scan found, one per profile URL.

    Facebook names go to their first profile, others to the last.
    """
    fields = [c for c in found.columns if c not in ("_ord", "key", "profile_url")]
    per = lookups.first_value_per if platform == "facebook" else lookups.last_value_per
    one = per(found, "key", "_ord", *fields)
    keys = posts.where(falsy(F.col("profile_url")).isNotNull()).select("profile_url").distinct()
    return keys.withColumn("key", profile_key(platform, F.col("profile_url"))).join(one, "key").select("profile_url", *fields)


# --- content ----------------------------------------------------------------
def unsupported(platform: str, task: dict) -> list[str]:
    """Flags of a task that its platform does not support."""
    works = WORKS.get(platform, WORKS["other"])
    return [f for f in CONTENT_FLAGS if task.get(f) and f not in works]


def check_content(platform: str, task: dict) -> None:
    """Raises before anything runs."""
    wrong = unsupported(platform, task)
    if wrong:
        raise NotImplementedError(f"{platform} does not support {', '.join(wrong)}")


def with_ocr(posts: DataFrame, raw: str = "_raw") -> DataFrame:
    """Body with the texts that the scraper read in a Facebook post's images."""
    texts = F.from_json(F.get_json_object(raw, "$.media"), "array<struct<ocrText:string>>")
    return posts.withColumn("body", text.with_image_text(F.col("body"), F.transform(texts, lambda m: m["ocrText"]), GENERIC_IMAGE))


def field_ok(value: Column) -> Column:
    """Whether a parser found something."""
    return falsy(value).isNotNull()


def first_author(authors: Column) -> Column:
    return falsy(F.get(authors, F.lit(0)))


def fetched(news: DataFrame, pages: DataFrame, extract: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Articles with what their pages say: a redirect changes the URL, found fields overwrite.

    ``pages``: (url, final_url, html); ``extract`` gives (url, title, body[, author, timestamp, media_urls]).
    """
    landed = pages.select(F.col("url").alias("_asked"), F.coalesce(falsy(F.col("final_url")), F.col("url")).alias("_final"), "html")
    parts = extract(landed.where("html IS NOT NULL").select(F.col("_asked").alias("url"), "html"))
    found = [c for c in parts.columns if c != "url" and c in news.columns]
    parts = parts.select(F.col("url").alias("_of"), *[F.col(c).alias("_p_" + c) for c in found])
    both = landed.drop("html").join(parts, F.col("_asked") == F.col("_of"), "left")
    out = news.join(both, news["url"] == F.col("_asked"), "left")
    empty = lambda c: F.when(F.size(F.col("_p_" + c)) > 0, F.col("_p_" + c)) if isinstance(news.schema[c].dataType, T.ArrayType) else falsy(F.col("_p_" + c))
    return out.withColumns({"url": F.coalesce("_final", news["url"])} | {c: F.coalesce(empty(c), F.col(c)) for c in found}).drop("_asked", "_final", "_of", *["_p_" + c for c in found])


def news_from_urls(links: DataFrame, pages: DataFrame, extract: Callable[[DataFrame], DataFrame], sources: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(articles, unknown sources) of distinct links: never-articles and pages that failed are left out.

    Places and the source's name come from the known sources where the page has none.
    """
    asked = links.select("url").where("url IS NOT NULL").distinct().where(~urls.is_never_article(F.col("url")))
    got = asked.join(pages.where("html IS NOT NULL").select("url").distinct(), "url", "left_semi")
    empty = mappers.document(got.select(F.col("url").alias("_u")), {"url": F.col("_u"), "type": F.lit("news")})
    read = fetched(empty, pages, extract).withColumn("domain", urls.registrable_domain(F.col("url")))
    named = lookups.source_name(read, sources).withColumn("source", F.coalesce("source", "source_name")).drop("source_name")
    place = [c for c in sources.columns if c in lookups.PLACE]
    s = sources.select(F.col("domain").alias("_d"), *[F.col(c).alias("_s_" + c) for c in place])
    out = named.join(s, F.col("domain") == F.col("_d"), "left").withColumns({c: F.coalesce(F.col(c), F.col("_s_" + c).cast(read.schema[c].dataType)) for c in place})
    return out.drop("_d", "domain", *["_s_" + c for c in place]), lookups.unknown_sources(read.select("domain", "url", "source"), sources)


def newest_first(docs: DataFrame, column: str = "timestamp") -> DataFrame:
    return docs.orderBy(F.col(column).desc_nulls_last())
