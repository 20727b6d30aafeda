"""More named queries: scans, their payloads, state, files and the smaller rules.

Payloads are built as JSON from ``conversations`` (comments), ``customer`` (profiles),
``documents`` (posts) and ``pages`` (articles).
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, functions as F, types as T

from medialoom.functions import coerce, text, urls
from medialoom.operators import enrich, filters, lookups, mappers, schema, state
from medialoom.operators.stored import shared_dir
from medialoom.plans import pipeline, tasks
from medialoom.plans.catalogue import NOW, _raw, cache, messages, posts, query, read
from medialoom.sources import readers, sinks
from medialoom.sources.providers import Providers


def _comments(s, d, platform: str, *cols) -> DataFrame:
    c = read(s, d, "conversations")
    raw = c.select(F.col("conv_id") * 100 + F.col("turn"), F.to_json(F.struct(*cols)))
    return enrich.comments(raw.toDF("_ord", "raw"), platform)


def _said(c: DataFrame) -> DataFrame:
    return c.select("post_url", "_ord", *[F.col(f"comment.{k}").alias(k) for k in ("comment_text", "comment_author", "comment_timestamp", "comment_likes")])


def _at():
    return F.concat(F.lit("2024-01-01T00:00:0"), F.col("turn") % 10)


_SAID = "SELECT {} AS post_url, {} AS _ord, text AS comment_text, role AS comment_author, '2024-01-01T00:00:0' || turn % 10 AS comment_timestamp, length(text) AS comment_likes FROM conversations"


@query("comments_facebook", _SAID.format("'p' || conv_id", "conv_id * 100 + turn") + " WHERE turn <> 3")
def comments_facebook(s, d):
    url = F.concat(F.lit("p"), F.col("conv_id"))
    odd = F.col("turn") % 2 == 1
    cols = [F.when(odd, "").otherwise(url).alias("postUrl"), url.alias("facebookUrl"), "text", F.col("role").alias("profileName"), _at().alias("date"), F.length("text").alias("likesCount"), F.when(F.col("turn") == 3, "gone").alias("error")]
    return _said(_comments(s, d, "facebook", *cols))


@query("comments_instagram", _SAID.format("CASE WHEN turn = 1 THEN 'input' ELSE 'p' || conv_id END", "conv_id * 100 + turn") + " WHERE turn <> 2")
def comments_instagram(s, d):
    url = F.when(F.col("turn") > 2, F.concat(F.lit("p"), F.col("conv_id"))).when(F.col("turn") == 0, F.concat(F.lit("p"), F.col("conv_id")))
    cols = [url.alias("postUrl"), F.when(F.col("turn") == 1, "input").alias("inputUrl"), "text", F.col("role").alias("ownerUsername"), _at().alias("timestamp"), F.length("text").alias("likesCount")]
    return _said(_comments(s, d, "instagram", *cols))


@query("comments_linkedin", _SAID.format("'p' || conv_id", "row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1"))
def comments_linkedin(s, d):
    """One payload a post, sent twice: the last one, with the comments, counts."""
    c = read(s, d, "conversations")
    one = F.struct(F.when(F.col("turn") % 2 == 0, F.col("text")).alias("text"), F.when(F.col("turn") % 2 == 1, F.col("text")).alias("content"), F.struct(F.col("role").alias("name")).alias("author"), _at().alias("createdAt"), F.lit(0).alias("likesCount"), F.length("text").alias("numLikes"))
    full = c.groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("turn", one.alias("c")))), lambda x: x["c"]).alias("comments"))
    url = F.concat(F.lit("p"), F.col("conv_id")).alias("postUrl")
    raw = full.select((F.col("conv_id") * 2 + 1).alias("_ord"), F.to_json(F.struct(url, "comments")).alias("raw"))
    first = full.select((F.col("conv_id") * 2).alias("_ord"), F.to_json(F.struct(url)).alias("raw"))
    return _said(enrich.comments(raw.unionByName(first), "linkedin"))


def _customers(s, d, platform: str, *cols) -> DataFrame:
    return enrich.profiles(read(s, d, "customer").select(F.col("c_custkey").alias("_ord"), F.to_json(F.struct(*cols)).alias("raw")), platform)


@query("profiles_facebook", """SELECT c_custkey AS _ord, unnest(CASE WHEN c_custkey % 3 = 0 THEN ['page' || c_custkey, 'alias' || c_custkey] ELSE ['page' || c_custkey] END) AS key,
  CASE WHEN c_custkey % 2 = 0 THEN 0 ELSE c_custkey END AS website_visits, c_name AS author_full_name, 'one' || chr(10) || c_mktsegment AS author_profile_bio, CASE WHEN c_custkey % 5 = 0 THEN 'Lima' ELSE c_mktsegment END AS author_location_text FROM customer""")
def profiles_facebook(s, d):
    k = F.col("c_custkey")
    page = F.concat(F.lit("page"), k)
    cols = [
        page.alias("pageName"), F.concat(F.lit("https://www.facebook.com/"), F.when(k % 3 == 0, F.concat(F.lit("alias"), k)).otherwise(page), F.lit("/")).alias("facebookUrl"), F.when(k % 2 == 0, 0).alias("followers"), k.alias("likes"),
        F.when(k % 7 > 0, F.col("c_name")).alias("title"), F.struct(F.col("c_name").alias("name")).alias("personalProfile"), F.array(F.lit("one"), F.col("c_mktsegment")).alias("info"),
        F.when(k % 5 > 0, F.col("c_mktsegment")).alias("address"), F.lit("Lives in Lima").alias("current_city"),
    ]
    return _customers(s, d, "facebook", *cols).select("_ord", "key", "website_visits", "author_full_name", "author_profile_bio", "author_location_text")


@query("profiles_instagram", "SELECT c_custkey AS _ord, c_name AS key, c_custkey AS website_visits, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE c_name END AS author, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS author_full_name, 'bio' AS author_profile_bio FROM customer WHERE c_custkey % 4 < 3")
def profiles_instagram(s, d):
    k = F.col("c_custkey")
    return _customers(s, d, "instagram", F.when(k % 4 < 3, F.col("c_name")).alias("username"), F.when(k % 2 == 0, F.col("c_mktsegment")).alias("fullName"), F.lit("bio").alias("biography"), k.alias("followersCount"))


@query("profiles_linkedin", "SELECT c_custkey AS _ord, 'https://l/' || c_custkey AS key, CASE WHEN c_custkey % 2 = 0 AND c_custkey > 0 THEN c_custkey ELSE 500 END AS website_visits, c_name AS author, c_name AS author_full_name, CASE WHEN c_custkey % 3 = 0 THEN 'about' ELSE c_mktsegment END AS author_profile_bio, c_mktsegment AS author_location_text FROM customer")
def profiles_linkedin(s, d):
    k = F.col("c_custkey")
    u = F.concat(F.lit("https://l/"), k)
    a = F.struct(F.when(k % 2 == 0, u).alias("linkedinUrl"), u.alias("url"), F.col("c_name").alias("name"), F.when(k % 3 > 0, F.col("c_mktsegment")).otherwise("").alias("headline"), F.lit("about").alias("about"), F.col("c_mktsegment").alias("locationName"), F.when(k % 2 == 0, k).otherwise(0).alias("followersCount"), F.lit(500).alias("connectionsCount"))
    return _customers(s, d, "linkedin", a.alias("author"))


def _authors(platform: str, url: str):
    def run(s, d):
        p = read(s, d, "orders").select(F.concat(F.lit(url), F.col("o_custkey") % 50, F.lit("/")).alias("profile_url"))
        k = F.col("c_custkey")
        found = read(s, d, "customer").select(k.alias("_ord"), F.concat(F.lit("https://l/" if platform == "linkedin" else ""), k % 40, F.lit("/" if platform == "linkedin" else "")).alias("key"), k.alias("website_visits"), F.lit(None).cast("string").alias("author_full_name"))
        return enrich.author_stats(p, found, platform).select("profile_url", "website_visits")

    return run


for _platform, _url, _pick in (("facebook", "https://www.facebook.com/", "min"), ("instagram", "https://www.instagram.com/", "max"), ("linkedin", "https://l/", "max")):
    query(
        f"author_stats_{_platform}",
        f"SELECT profile_url, v AS website_visits FROM (SELECT DISTINCT '{_url}' || o_custkey % 50 || '/' AS profile_url, o_custkey % 50 AS k FROM orders) JOIN (SELECT c_custkey % 40 AS k, {_pick}(c_custkey) AS v FROM customer GROUP BY 1) USING (k)",
    )(_authors(_platform, _url))


_REQUESTS = [
    ("profile", "facebook", '{"startUrls":[{"url":"https://f/a/"}]}'), ("profile", "instagram", '{"usernames":["a"]}'), ("profile", "linkedin", '{"searchQueries":[""],"authorUrls":["https://f/a/"],"maxPosts":1,"profileScraperMode":"main"}'),
    ("comment", "facebook", '{"startUrls":[{"url":"https://f/a/"}],"resultsLimit":15}'), ("comment", "instagram", '{"directUrls":["https://f/a/"],"resultsLimit":15}'),
    ("comment", "linkedin", '{"searchQueries":[""],"authorUrls":["https://f/a/"],"maxPosts":1,"scrapeComments":true,"maxComments":15,"postNestedComments":true}'),
]


@query("scan_requests", "SELECT * FROM (VALUES " + ", ".join(str(r) for r in _REQUESTS) + ") t(scan, platform, request)")
def scan_requests(s, d):
    made = {"profile": enrich.profile_request, "comment": enrich.comment_request}
    return s.createDataFrame([(k, p, json.dumps(made[k](p, ["https://f/a/"]), separators=(",", ":"))) for k, p, _ in _REQUESTS], "scan string, platform string, request string")


_SEARCHES = [
    ("google_news", '{"keywords":["a","#b c"],"maxArticles":30,"timeframe":"7d","region_language":"MX:es-419","decodeUrls":true,"extractDescriptions":true}'),
    ("instagram_hashtags", '{"hashtags":["a","#b c"],"resultsType":"posts","resultsLimit":10,"keywordSearch":false}'),
    ("instagram_profile_posts", '{"directUrls":["a","#b c"],"resultsType":"posts","resultsLimit":10}'),
    ("facebook_page_posts", '{"startUrls":[{"url":"a"},{"url":"#b c"}],"resultsLimit":20,"captionText":false}'),
    ("linkedin_keyword_search", '{"searchQueries":["a","#b c"],"maxPosts":30,"sortBy":"date","postedLimit":"week"}'),
    ("twitter_keyword_search", '{"hashtags":["b c"],"phrases":[],"keywords":["a"],"maxItems":30}'),
]


@query("search_requests", "SELECT * FROM (VALUES " + ", ".join(str(r) for r in _SEARCHES) + ") t(source, request)")
def search_requests(s, d):
    return s.createDataFrame([(p, json.dumps(readers.scrape_request(p, ["a", "#b c"], {"period": "w"}), separators=(",", ":"))) for p, _ in _SEARCHES], "source string, request string")


def _find(request: dict) -> list[dict]:
    """A stand-in scraper: three posts a query, of which queries share some."""
    n = int(request["query"])
    return [{"post_url": f"https://f/{(n + k) // 2}" if k < 2 else "", "url": f"https://g/{n}" if k < 2 else "", "query": n} for k in range(min(3, request["max_results"]))]


@query(
    "search_union_dedupe",
    """WITH q AS (SELECT n_nationkey AS n, unnest([0, 1, 2]) AS k FROM nation), r AS (SELECT n, k, CASE WHEN k < 2 THEN 'https://f/' || (n + k) // 2 END AS u FROM q)
      SELECT u AS post_url, min(n) AS query FROM r WHERE u IS NOT NULL GROUP BY u UNION ALL SELECT NULL, n FROM r WHERE u IS NULL""",
)
def search_union_dedupe(s, d):
    """One run a query through the scraper source, united, the first of each post kept."""
    keys = [str(r[0]) for r in read(s, d, "nation").select("n_nationkey").orderBy("n_nationkey").collect()]  # the queries of one task
    readers.SCRAPERS["facebook_keyword_search"] = _find
    raw = readers.scraped(s, "facebook_keyword_search", enrich.keyword_requests(keys, 20, "2024-01-01"))
    return enrich.searched(raw).select(F.nullif(F.get_json_object("raw", "$.post_url"), F.lit("")).alias("post_url"), F.get_json_object("raw", "$.query").cast("long").alias("query"))


@query("content_ocr", "SELECT doc_id, text || CASE WHEN doc_id % 3 = 0 THEN chr(10) || chr(10) || ' image_text_1: read ' || doc_id || chr(10) || chr(10) || ' image_text_2: more' ELSE '' END AS body FROM documents")
def content_ocr(s, d):
    i = F.col("doc_id")
    seen = F.array(*[F.struct(t.alias("ocrText")) for t in (F.lit("May be an image of a cat"), F.when(i % 3 == 0, F.concat(F.lit("read "), i)), F.when(i % 3 == 0, "more").otherwise(""))])
    docs = posts(s, d).withColumn("_raw", F.to_json(F.struct(seen.alias("media"))))
    return pipeline.content_stage(docs, pipeline.Context({"add_text_from_images": True})).select("doc_id", "body")


_FLAGS = [(p, f, f in enrich.WORKS[p]) for p in ("facebook", "instagram_hashtags", "instagram_profile_posts") for f in enrich.CONTENT_FLAGS]


@query(
    "content_flags",
    """SELECT p.platform, f.flag, (f.flag = 'fetch_attached_url' OR (p.platform = 'facebook' AND f.flag = 'add_text_from_images') OR (p.platform = 'instagram_profile_posts' AND f.flag = 'download_video')) AS works
      FROM (VALUES ('facebook'), ('instagram_hashtags'), ('instagram_profile_posts')) p(platform), (VALUES ('fetch_attached_url'), ('download_images'), ('download_video'), ('add_text_from_images'), ('add_subtitles'), ('add_ai_transcription')) f(flag)""",
)
def content_flags(s, d):
    """Which flags run, found by asking: the others raise."""

    def works(platform: str, flag: str) -> bool:
        try:
            enrich.check_content(platform, {flag: True})
        except NotImplementedError:
            return False
        return True

    return s.createDataFrame([(p, f, works(p, f)) for p, f, _ in _FLAGS], "platform string, flag string, works boolean")


def _landed(s, d) -> DataFrame:
    k = F.col("page_id")
    return read(s, d, "pages").groupBy("url").agg(F.min("page_id").alias("page_id"), F.min_by("html", "page_id").alias("h")).select("url", F.when(k % 4 == 0, F.concat(F.lit("https://moved.example/"), k)).alias("final_url"), F.when(k % 5 > 0, F.col("h")).alias("html"), "page_id")


def _sizes(pages: DataFrame) -> DataFrame:
    return pages.select("url", F.when(F.length("html") % 2 == 0, "").otherwise(F.concat(F.lit("T"), F.length("html"))).alias("title"), F.concat(F.lit("B"), F.length("html")).alias("body"))


_LANDED = "l AS (SELECT url, min(page_id) AS k, min_by(html, page_id) AS h FROM pages GROUP BY url)"


@query(
    "fetch_and_parse",
    f"""WITH {_LANDED} SELECT doc_id, coalesce(CASE WHEN k % 4 = 0 THEN 'https://moved.example/' || k END, p.url) AS url, CASE WHEN k % 5 > 0 AND length(h) % 2 = 1 THEN 'T' || length(h) ELSE 'old' END AS title, CASE WHEN k % 5 > 0 THEN 'B' || length(h) ELSE 'text' END AS body
      FROM (SELECT doc_id, coalesce(pages.url, 'https://none/' || doc_id) AS url FROM documents LEFT JOIN pages ON page_id = doc_id) p LEFT JOIN l ON l.url = p.url""",
)
def fetch_and_parse(s, d):
    x = read(s, d, "documents").join(read(s, d, "pages"), F.col("page_id") == F.col("doc_id"), "left")
    news = mappers.document(x.withColumn("u", F.coalesce("url", F.concat(F.lit("https://none/"), F.col("doc_id")))), {"url": F.col("u"), "title": F.lit("old"), "body": F.lit("text")}, "doc_id")
    return enrich.fetched(news, _landed(s, d).drop("page_id"), _sizes).select("doc_id", "url", "title", "body")


@query(
    "news_from_url",
    f"""WITH {_LANDED}, f AS (SELECT CASE WHEN k % 4 = 0 THEN 'https://moved.example/' || k ELSE url END AS url, h FROM l WHERE k % 5 > 0)
      SELECT url, 'B' || length(h) AS body, CASE WHEN url LIKE 'https://moved.example/%' THEN 'Moved News' ELSE regexp_replace(regexp_extract(url, '([^./]+\\.[^./]+)(/|$)', 1), '\\.[^.]*$', '') END AS source, CASE WHEN url LIKE 'https://moved.example/%' THEN '_00101' END AS geoid FROM f""",
)
def news_from_url(s, d):
    known = s.createDataFrame([("moved.example", "Moved News", "_00101")], "domain string, sitio string, location_author_geoid string")
    out, _ = enrich.news_from_urls(_landed(s, d).select("url"), _landed(s, d).drop("page_id"), _sizes, known)
    return out.select("url", "body", "source", F.col("location_author_geoid").alias("geoid"))


@query("geocode_groups", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'a|b' || doc_id WHEN doc_id % 3 = 1 THEN 'a' ELSE '' END AS ids, CASE WHEN doc_id % 3 = 0 THEN 'b' || doc_id END AS geoid FROM documents")
def geocode_groups(s, d):
    i = F.col("doc_id")
    place = lambda g: F.array(F.struct(g.alias("geoid"), F.lit("n").alias("formatted_name"), F.lit("1").alias("precision_level")))
    groups = F.when(i % 3 == 0, F.create_map(F.lit("1"), place(F.lit("a")), F.lit("2"), place(F.concat(F.lit("b"), i)))).when(i % 3 == 1, F.create_map(F.lit("1"), place(F.lit("a"))))
    return lookups.geocoded(posts(s, d).withColumn("groups", groups)).select("doc_id", F.array_join("location_ids", "|").alias("ids"), F.col("location_author_geoid").alias("geoid"))


@query("media_files", "SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'f' || page_id ELSE 'old' END AS file FROM pages")
def media_files(s, d):
    p = read(s, d, "pages")
    at = F.concat(F.lit("https://m/"), F.col("page_id"))
    files = p.where("page_id % 2 = 0").select(F.concat(at, F.lit("/")).alias("url"), F.concat(F.lit("f"), F.col("page_id")).alias("filename"))
    return lookups.attach_media_files(p.select("page_id", at.alias("url"), F.lit("old").alias("video_filename")), files).select("page_id", F.col("video_filename").alias("file"))


@query("video_gate", "SELECT doc_id FROM documents WHERE doc_id % 4 IN (0, 1, 3)")
def video_gate(s, d):
    k = F.col("doc_id") % 4
    kind, raw = F.when(k == 0, "Video").when(k == 1, "Reel").when(k == 2, "Photo"), F.when(k == 3, "https://v").when(k == 2, "")
    return read(s, d, "documents").where(filters.has_video(kind, raw)).select("doc_id")


@query("usable_comments", "SELECT conv_id, turn FROM conversations WHERE turn % 3 = 0")
def usable_comments(s, d):
    k = F.col("turn") % 3
    c = read(s, d, "conversations").withColumns({"post_url": F.when(k == 1, "").otherwise("u"), "error": F.when(k == 2, "gone")})
    return filters.usable_comments(c).select("conv_id", "turn")


@query("runnable_tasks", "SELECT n_name AS task_id FROM nation WHERE n_nationkey % 3 = 0 AND n_regionkey = 1")
def runnable_tasks(s, d):
    n = read(s, d, "nation")
    rows = n.select(F.col("n_name").alias("task_id"), F.lit("google_news").alias("actor_class"), F.when(F.col("n_nationkey") % 3 == 0, "TRUE").otherwise("no").alias("enabled"), F.when(F.col("n_regionkey") == 1, " Food").alias("theme"))
    return tasks.runnable(tasks.parse_tasks(rows), "food").select("task_id")


@query("task_arguments", "SELECT n_name AS task_id, CASE WHEN n_nationkey % 2 = 0 THEN 7 ELSE 30 END AS max_results, CASE WHEN n_nationkey % 2 = 0 THEN 'x' END AS extra, 15 AS max_comments FROM nation")
def task_arguments(s, d):
    own = F.when(F.col("n_nationkey") % 2 == 0, '{"max_results": 7, "extra": "x"}')
    rows = tasks.parse_tasks(read(s, d, "nation").select(F.col("n_name").alias("task_id"), own.alias("actor_params"))).collect()  # a task sheet
    merged = [tasks.arguments(r) for r in rows]
    return s.createDataFrame([(a["task_id"], a["max_results"], a.get("extra"), a["max_comments"]) for a in merged], "task_id string, max_results int, extra string, max_comments int")


@query("small_text_rules", "SELECT page_id, 'site' || page_id AS site, CASE WHEN page_id % 2 = 0 THEN 'Lima' ELSE 'Near Lima' END AS place, 'filtered:t:' || url AS cache_key, CASE WHEN page_id % 2 = 0 THEN 'a' END AS first_author, page_id % 3 > 0 AS ok FROM pages")
def small_text_rules(s, d):
    k = F.col("page_id")
    place = F.when(k % 4 == 0, "Lives in Lima").when(k % 4 == 2, "From Lima").otherwise("Near Lima")
    return read(s, d, "pages").select(
        "page_id", text.site_name(F.concat(F.lit(" site"), k, F.lit(".com.mx "))).alias("site"), text.without_place_prefix(place).alias("place"), text.cache_key(F.lit("t"), F.col("url")).alias("cache_key"),
        enrich.first_author(F.when(k % 2 == 0, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("")))).alias("first_author"), enrich.field_ok(F.when(k % 3 == 1, "x").when(k % 3 == 2, "y").otherwise("")).alias("ok"),
    )


@query("list_coercions", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'a|b|a' WHEN doc_id % 3 = 1 THEN source ELSE '' END AS items, CASE WHEN doc_id % 3 = 0 THEN 'a|b' WHEN doc_id % 3 = 1 THEN source ELSE '' END AS urls, doc_id % 2 = 0 AS no_number, doc_id % 3 = 2 AS no_text FROM documents")
def list_coercions(s, d):
    k = F.col("doc_id")
    raw = F.when(k % 3 == 0, '["a", "b", "a"]').when(k % 3 == 1, F.col("source"))
    return read(s, d, "documents").select(
        "doc_id", F.array_join(coerce.to_list(raw), "|").alias("items"), F.array_join(coerce.url_list(F.when(k % 3 == 0, F.array(F.lit(" a "), F.lit("b"), F.lit(""), F.lit("a"))).otherwise(coerce.to_list(raw))), "|").alias("urls"),
        coerce.is_missing(F.when(k % 2 == 0, F.lit(float("nan"))).otherwise(F.lit(1.0)), "double").alias("no_number"), coerce.is_missing(raw, "string").alias("no_text"),
    )


@query("last_item_comments", "SELECT 'u' || conv_id AS post_url, max(turn) AS last_turn FROM conversations GROUP BY conv_id")
def last_item_comments(s, d):
    c = read(s, d, "conversations").select(F.concat(F.lit("u"), F.col("conv_id")).alias("post_url"), F.col("turn").alias("_ord"), F.array("turn").alias("comments"))
    return lookups.last_comments(c).select("post_url", F.get("comments", F.lit(0)).alias("last_turn"))


@query("user_places", "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN '_001' ELSE '_own' END AS geoid FROM customer WHERE c_custkey % 5 > 0")
def user_places(s, d):
    c = read(s, d, "customer")
    u = F.concat(F.lit("https://s.example/u"), F.col("c_custkey"))
    stored_users = c.select(F.concat(u, F.lit("/")).alias("profile_url"), F.when(F.col("c_custkey") % 3 > 0, "_001").alias("location_author_geoid"))
    docs = c.where("c_custkey % 5 > 0").select("c_custkey", u.alias("profile_url"), F.when((F.col("c_custkey") % 2 == 1) & (F.col("c_custkey") % 3 > 0), "_own").alias("location_author_geoid"))
    return lookups.fill_from_users(docs, state.has_place(stored_users), ("location_author_geoid",), needs="location_author_geoid").select("c_custkey", F.col("location_author_geoid").alias("geoid"))


@query("outcomes_last_wins", "SELECT 't' AS task_id, 'u' || conv_id AS url, max(turn) % 2 = 0 AS survived FROM conversations GROUP BY conv_id")
def outcomes_last_wins(s, d):
    docs = read(s, d, "conversations").select(F.concat(F.lit("u"), F.col("conv_id")).alias("url"), (F.col("conv_id") * 100 + F.col("turn")).alias("_ord"), "turn")
    return state.filter_outcomes(docs, docs.where("turn % 2 = 0"), "t")


@query("cached_answers", "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'old' ELSE 'new' || source END AS answer FROM documents")
def cached_answers(s, d):
    """Even documents' requests are in the cache; the others are one request a source."""
    x = read(s, d, "documents").select("doc_id", F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("even"), F.col("doc_id"))).otherwise(F.col("source")).alias("request"), F.col("source").alias("prompt"))
    known = x.where("doc_id % 2 = 0").select("request", F.lit("old").alias("answer"))
    answered, _ = state.cached_call(x, known, lambda r: r.withColumn("answer", F.concat(F.lit("new"), F.col("prompt"))))
    return answered.select("doc_id", "answer")


@query(
    "llm_stage",
    """WITH n AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS k FROM documents) SELECT doc_id FROM n WHERE (k // 20) % 3 = 0 OR k % 20 < 10""",
)
def llm_stage(s, d):
    """The model stage with batches, cache and verdicts; every third batch is answered by no list."""

    def answer(requests: DataFrame) -> DataFrame:
        first = F.regexp_extract("prompt", r"user_name: x(\d+)", 1).cast("long")
        return requests.withColumn("answer", F.when((first / 20).cast("long") % 3 == 0, "I cannot say").otherwise(F.lit(json.dumps(list(range(1, 11))))))

    n = posts(s, d).select("*", F.lit(None).cast("string").alias("z"))
    numbered = lookups_numbered(n)
    c = pipeline.Context({"llm_filter_condition": "any"}, Providers(model=answer))
    return pipeline.STAGES["1"](numbered, c).select("doc_id")


def lookups_numbered(df: DataFrame) -> DataFrame:
    """The author of every post is its place in the order, which the stand-in model reads."""
    b = filters.batches(df)
    return b.withColumn("author", F.concat(F.lit("x"), F.col("batch_id") * 20 + F.col("batch_index") - 1)).drop("batch_id", "batch_index")


@query("detected_language", "SELECT doc_id FROM documents WHERE lang = 'de' AND doc_id % 2 = 0")
def detected_language(s, d):
    """Even posts say their language; the detector, asked for the others, says English."""
    p = posts(s, d).withColumn("language", F.when(F.col("doc_id") % 2 == 0, F.col("language")))
    return filters.in_language(p, "german", lambda t: F.when(t.isNotNull(), F.lit("en"))).select("doc_id")


@query("filter_cache_override", "SELECT doc_id FROM documents")
def filter_cache_override(s, d):
    return filters.not_rejected_before(posts(s, d), cache(s, d), "t1", override=True).select("doc_id")


@query("stage_counters", "SELECT 'K' AS stage, count(*) AS n FROM documents UNION ALL SELECT 'L', count(*) FROM documents WHERE lang = 'en'")
def stage_counters(s, d):
    """Counts that were observed while the stages ran."""
    c = pipeline.Context({"language": "en"}, counters={})
    pipeline.process(posts(s, d), "google_news", c).write.format("noop").mode("overwrite").save()
    return s.createDataFrame([(k, c.counters[k].get["rows"]) for k in ("K", "L")], "stage string, n long")


@query("newest_first", "SELECT event_id FROM events")
def newest_first(s, d):
    return enrich.newest_first(read(s, d, "events"), "ts").select("event_id")


def _folder(s, name: str) -> str:
    import uuid

    return f"{shared_dir(s)}/{name}-{uuid.uuid4().hex}"


@query("sources_scan", "SELECT 'd' || n_nationkey AS domain, n_name AS sitio, CASE WHEN n_nationkey % 2 = 0 THEN '_00' || n_regionkey END AS location_author_geoid, CASE WHEN n_nationkey % 2 = 0 THEN n_name END AS author_location_text FROM nation")
def sources_scan(s, d):
    path, n = _folder(s, "sources"), read(s, d, "nation")
    even = F.col("n_nationkey") % 2 == 0
    stats = F.struct(F.when(even, F.concat(F.lit("_00"), F.col("n_regionkey"))).alias("location_author_geoid"), F.when(even, F.col("n_name")).alias("location_author_formatted_name"))
    n.select(F.concat(F.lit("d"), F.col("n_nationkey")).alias("domain"), F.col("n_name").alias("sitio"), stats.alias("stats")).write.json(path)
    return readers.source_dimension(s, path).select("domain", "sitio", "location_author_geoid", "author_location_text")


@query("task_sheet", "SELECT n_name AS task_id, 2 AS n_params, 'm' AS period FROM nation")
def task_sheet(s, d):
    path = _folder(s, "tasks")
    read(s, d, "nation").select(F.col("n_name").alias("task_id"), F.lit('a "b", c').alias("search_params"), F.lit("m").alias("period")).write.csv(path, header=True, escape='"')
    return tasks.parse_tasks(readers.task_table(s, path)).select("task_id", F.size("search_params").alias("n_params"), "period")


@query("question_sheet", "SELECT CAST(n_nationkey AS INTEGER) AS no, n_name AS question FROM nation")
def question_sheet(s, d):
    path = _folder(s, "questions")
    rows = read(s, d, "nation").select(F.col("n_nationkey").cast("string").alias("no"), F.col("n_name").alias("question"))
    rows.unionByName(s.createDataFrame([("Total", "x")], rows.schema)).write.csv(path, header=True)
    return readers.question_sheet(s, path).select("no", "question")


@query("run_file", "SELECT doc_id FROM documents WHERE FALSE")
def run_file(s, d):
    """Valid messages written as a run of JSON lines: what is read back that was not valid, and the other way round."""
    path, m = _folder(s, "run"), messages(s, d)
    sinks.run_file(m, path)
    back = s.read.json(path)
    lost = m.where("error IS NULL").select("doc_id", F.col("message.url").alias("u")).join(back.select(F.col("message.url").alias("v")), F.col("u") == F.col("v"), "left_anti")
    return lost.select("doc_id")


@query("flat_file", "SELECT CAST(conv_id AS VARCHAR) AS conv_id, CAST(count(*) AS VARCHAR) AS size, string_agg(role, ' | ' ORDER BY turn) AS roles FROM conversations GROUP BY conv_id")
def flat_file(s, d):
    path = _folder(s, "flat")
    c = read(s, d, "conversations").groupBy("conv_id").agg(F.count("*").alias("size"), F.transform(F.sort_array(F.collect_list(F.struct("turn", "role"))), lambda x: x["role"]).alias("roles"))
    sinks.flat_csv(c, path)
    return s.read.csv(path, header=True, escape='"')


@query("rejects_table", f"SELECT doc_id FROM documents LEFT JOIN events ON event_id = doc_id WHERE doc_id % 11 = 0 OR event_id IS NULL OR doc_id % 13 = 0 OR doc_id % 17 = 0 AND '{NOW}' <> ''")
def rejects_table(s, d):
    path, m = _folder(s, "rejects"), messages(s, d)
    sinks.rejects(m, path)
    return s.read.parquet(path).select("doc_id")


@query("nested_places", "SELECT n_nationkey, n_name AS name, 'n' || n_regionkey AS level_1 FROM nation")
def nested_places(s, d):
    n = read(s, d, "nation").select("n_nationkey", F.col("n_name").alias("location_author_formatted_name"), F.concat(F.lit("n"), F.col("n_regionkey")).alias("location_author_level_1"))
    out = schema.nested_author_location(n)
    place = out.schema["location_author"].dataType if "location_author" in out.columns else None
    if not isinstance(place, T.StructType):
        raise TypeError("places were not nested")
    return out.select("n_nationkey", F.col("location_author.formatted_name").alias("name"), F.col("location_author.level_1").alias("level_1"))


@query("flat_times", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at FROM events")
def flat_times(s, d):
    """Instants lose their zone in a flat record, as sheets have none."""
    e = schema.flatten(read(s, d, "events").select("event_id", F.struct(F.col("ts").cast("timestamp").alias("at")).alias("seen")))
    if dict(e.dtypes)["seen.at"] != "timestamp_ntz":
        raise TypeError("a zone was left")
    return e.select("event_id", F.date_format(F.col("`seen.at`"), "yyyy-MM-dd HH:mm:ss").alias("at"))


@query("deep_child_media", "SELECT doc_id, 'm0|m1|m2|m3|m4|m5' AS media FROM documents WHERE doc_id % 10 = 0 UNION ALL SELECT doc_id, 'm0' FROM documents WHERE doc_id % 10 > 0")
def deep_child_media(s, d):
    """Child posts nested five deep in every tenth post."""
    nested = None
    for k in (5, 4, 3, 2, 1):
        nested = F.array(F.struct(F.lit(f"m{k}").alias("displayUrl"), *([nested.alias("childPosts")] if nested is not None else [])))
    raw = _raw(read(s, d, "documents"), F.lit("m0").alias("displayUrl"), F.when(F.col("doc_id") % 10 == 0, nested).alias("childPosts"))
    return mappers.map_raw(raw, "instagram").select(F.col("_ord").alias("doc_id"), F.array_join("media_urls", "|").alias("media"))


@query("first_comment_article", "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'kept' WHEN doc_id % 4 = 1 THEN 'https://n.example/a' END AS article FROM documents")
def first_comment_article(s, d):
    """Posts without an article take the one that their first comment links to."""
    a = s.createDataFrame([("https://n.example/a", "news text")], "url string, body string")
    k = F.col("doc_id")
    said = F.array(F.struct(F.when(k % 4 == 1, "see https://n.example/a").otherwise("nothing").alias("comment_text")))
    p = posts(s, d).withColumns({"comments": said, "attached_news": F.when(k % 2 == 0, F.struct(F.lit("kept").alias("url"), F.lit("old").alias("body")))})
    out = pipeline.first_comment_stage(p, pipeline.Context({"fetch_attached_url": True}, articles=a))
    return out.select("doc_id", F.col("attached_news.url").alias("article"))


@query("social_links", "SELECT page_id, page_id % 3 = 0 AS social FROM pages")
def social_links(s, d):
    u = F.when(F.col("page_id") % 3 == 0, F.lit("https://www.notfacebook.com/x")).when(F.col("page_id") % 3 == 1, F.lit("https://news.example.com.pe/a")).otherwise(F.lit("https://a.co.cr/"))
    return read(s, d, "pages").select("page_id", urls.is_social(urls.registrable_domain(u)).alias("social"))


@query("national_domains", "SELECT * FROM (VALUES ('https://www.a.com.ec/x', 'a.com.ec'), ('http://b.c.co.cr', 'c.co.cr'), ('x.gob.gt/1', 'x.gob.gt'), ('https://d.com.es', 'd.com.es'), ('https://e.f.co.il:80/', 'f.co.il'), ('https://com.py', NULL), ('https://g.example.org', 'example.org'), ('http://10.0.0.1/', NULL)) t(url, domain)")
def national_domains(s, d):
    u = ["https://www.a.com.ec/x", "http://b.c.co.cr", "x.gob.gt/1", "https://d.com.es", "https://e.f.co.il:80/", "https://com.py", "https://g.example.org", "http://10.0.0.1/"]
    return s.createDataFrame([(x,) for x in u], "url string").select("url", urls.registrable_domain(F.col("url")).alias("domain"))
