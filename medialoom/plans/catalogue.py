"""Named queries over the driver's tables, each with its SQL twin where SQL can say it.

``documents`` stand for posts, ``conversations`` for comments, ``pages`` for articles,
``events`` for engagement, ``customer`` and ``supplier`` for profiles, ``nation`` and
``region`` for places, ``labels`` for verdicts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from medialoom.functions import coerce, text, urls
from medialoom.functions.python_text import clean_html, snippet
from medialoom.operators import analysis, filters, lookups, mappers, schema, state
from medialoom.operators.schemas import compiler
from medialoom.plans import pipeline, tasks
from medialoom.sources import sinks
from medialoom.sources.providers import Providers, extracted_articles

NOW = "2024-02-01 00:00:00"
KEYWORDS = ["idiot", "licensed", "the and attion"]
QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def posts(spark: SparkSession, d: str) -> DataFrame:
    x = read(spark, d, "documents")
    site = F.concat(F.lit("https://"), F.col("source"), F.lit(".example.com/"))
    filled = {
        "body": F.col("text"), "language": F.col("lang"), "author": F.col("source"), "source": F.col("source"), "type": F.lit("news"),
        "url": F.concat(site, F.lit("doc/"), F.col("doc_id")), "profile_url": site, "title": F.substring("text", 1, 80), "likes": F.col("n_chars"),
    }
    return mappers.document(x.withColumn("_ord", F.col("doc_id")), filled, "_ord", "doc_id")


POSTS = """posts AS (SELECT doc_id, doc_id AS _ord, text AS body, lang AS language, source AS author, source, 'news' AS type,
  'https://' || source || '.example.com/doc/' || doc_id AS url, 'https://' || source || '.example.com/' AS profile_url,
  substring(text, 1, 80) AS title, n_chars AS likes FROM documents)"""
GEO = "'_' || lpad(CAST(n_regionkey AS VARCHAR), 3, '0') || lpad(CAST(n_nationkey AS VARCHAR), 2, '0')"


def geo():
    return F.concat(F.lit("_"), F.lpad(F.col("n_regionkey").cast("string"), 3, "0"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"))


@query("map_document_to_post", f"WITH {POSTS} SELECT doc_id, url, profile_url, author, language, title, type, likes, length(body) AS body_chars FROM posts")
def map_document_to_post(s, d):
    return posts(s, d).select("doc_id", "url", "profile_url", "author", "language", "title", "type", "likes", F.length("body").cast("long").alias("body_chars"))


@query(
    "coerce_primitives",
    """SELECT o_orderkey, CAST(trunc(o_totalprice) AS BIGINT) AS as_int, o_totalprice AS as_float,
      CASE WHEN o_orderstatus = 'O' THEN TRUE WHEN o_orderstatus = 'F' THEN FALSE END AS as_bool, nullif(o_orderpriority, '') AS as_text,
      strftime(CAST(o_orderdate AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS as_time, CAST(NULL AS BIGINT) AS bad_int FROM orders""",
)
def coerce_primitives(s, d):
    o = read(s, d, "orders")
    flag = F.when(F.col("o_orderstatus") == "O", " Yes ").when(F.col("o_orderstatus") == "F", "0").otherwise("maybe")
    pad = F.concat(F.lit("\t "), F.col("o_orderpriority"), F.lit(" \n"))
    return o.select(
        "o_orderkey", coerce.to_int(F.col("o_totalprice").cast("string")).alias("as_int"), coerce.to_float(F.col("o_totalprice").cast("string")).alias("as_float"),
        coerce.to_bool(flag).alias("as_bool"), coerce.to_text(pad).alias("as_text"),
        F.date_format(coerce.to_timestamp(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")), "yyyy-MM-dd HH:mm:ss").alias("as_time"),
        coerce.to_int(F.concat(F.lit("1,"), F.col("o_orderkey"))).alias("bad_int"),
    )


_NOT = " AND ".join(f"NOT contains(lower(body || ' ' || title), '{k}')" for k in KEYWORDS)


@query("filter_not_keywords", f"WITH {POSTS} SELECT doc_id FROM posts WHERE {_NOT}")
def filter_not_keywords(s, d):
    return filters.without_keywords(posts(s, d), KEYWORDS).select("doc_id")


def dated(s, d):
    """Events as documents: some timestamps with an offset, some missing, some unreadable."""
    said = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    at = F.when(F.col("event_id") % 10 == 0, F.concat(said, F.lit("-06:00"))).when(F.col("event_id") % 10 == 1, F.lit(None)).when(F.col("event_id") % 10 == 2, F.lit("soon")).otherwise(said)
    return read(s, d, "events").select("event_id", at.alias("timestamp"))


@query("filter_min_date", "SELECT event_id FROM events WHERE event_id % 10 IN (1, 2) OR date_trunc('second', ts) >= TIMESTAMP '2024-01-15 00:00:00'")
def filter_min_date(s, d):
    return filters.since(dated(s, d), F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")).select("event_id")


@query("filter_period", "SELECT event_id FROM events WHERE event_id % 10 IN (1, 2) OR date_trunc('second', ts) >= TIMESTAMP '2024-01-25 00:00:00'")
def filter_period(s, d):
    return filters.since(dated(s, d), filters.cutoff("w", F.lit(NOW).cast("timestamp_ntz"))).select("event_id")


@query("filter_language", f"WITH {POSTS} SELECT doc_id FROM posts WHERE language = 'es'")
def filter_language(s, d):
    return filters.in_language(posts(s, d), "MX:es-419").select("doc_id")


_LANG = [("spanish", "es"), (" Español ", "es"), ("es-MX", "es"), ("pt_BR", "pt"), ("MX:es-419", "es"), ("US:english", "en"), ("EN", "en"), ("x", None), ("klingon", None), ("", None), ("e1", None)]


@query(
    "normalize_language_codes",
    "WITH raw(raw, code) AS (VALUES " + ", ".join(f"('{a}', {repr(b) if b else 'CAST(NULL AS VARCHAR)'})" for a, b in _LANG) + ") SELECT raw, lang, code, code = lang AS same, count(*) AS n FROM raw, documents GROUP BY ALL",
)
def normalize_language_codes(s, d):
    raw = s.createDataFrame([(a,) for a, _ in _LANG], "raw string").select("raw", text.normalize_language(F.col("raw")).alias("code"))
    langs = read(s, d, "documents").groupBy("lang").agg(F.count("*").alias("n"))
    pairs = langs.select("lang", "n", F.explode(F.array(*[F.lit(a) for a, _ in _LANG])).alias("raw"))
    return pairs.join(F.broadcast(raw), "raw").select("raw", "lang", "code", (F.col("code") == F.col("lang")).alias("same"), "n")


def customers(s, d):
    c = read(s, d, "customer").join(F.broadcast(read(s, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    return c.withColumn("geoid", geo())


@query(
    "filter_location_prefix",
    f"""SELECT c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE CASE WHEN c_custkey % 5 = 0 THEN {GEO} LIKE '\\_001%' ESCAPE '\\'
      WHEN c_custkey % 5 IN (1, 2) THEN TRUE ELSE {GEO} LIKE '\\_001%' ESCAPE '\\' END""",
)
def filter_location_prefix(s, d):
    c, k = customers(s, d), F.col("c_custkey") % 5
    ids = F.when(k == 0, F.array(F.lit("77"), F.col("geoid"))).when(k == 1, F.array(F.lit("77"))).otherwise(F.array().cast("array<string>"))
    own = F.when(k == 2, F.lit("88")).otherwise(F.col("geoid"))
    return filters.in_place(c.select("c_custkey", ids.alias("location_ids"), own.alias("author_location_id")), "_001").select("c_custkey")


def cache(s, d):
    x = read(s, d, "labels").join(posts(s, d).select("doc_id", "url"), "doc_id")
    return x.select(F.lit("t1").alias("task_id"), "url", (F.col("toxic") == 0).alias("survived"))


@query("filter_cache_anti", f"WITH {POSTS} SELECT doc_id FROM posts WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def filter_cache_anti(s, d):
    return filters.not_rejected_before(posts(s, d), cache(s, d), "t1").select("doc_id")


@query("filter_cache_outcomes", f"WITH {POSTS} SELECT 't1' AS task_id, url, {_NOT} AS survived FROM posts")
def filter_cache_outcomes(s, d):
    p = posts(s, d)
    old = s.createDataFrame([], "task_id string, url string, survived boolean")
    return state.merge_filter_cache(old, state.filter_outcomes(p, filters.without_keywords(p, KEYWORDS), "t1"))


def verdicts(s, d):
    """A stand-in model: keeps what the labels call good, and whatever they do not know; notes whether a place was known by then."""
    bad = read(s, d, "labels").where("quality = 0").select("doc_id")

    def stage(df, c):
        return df.withColumn("placed_when_judged", F.col("author_location_id").isNotNull()).join(bad, "doc_id", "left_anti")

    return stage


def _pipeline(source: str):
    def run(s, d):
        c = pipeline.Context({"task_id": "t1", "not_keywords": KEYWORDS, "language": "en", "country_id": "_001"}, sources=places(s, d), cache=cache(s, d))
        stage = verdicts(s, d)
        return pipeline.process(posts(s, d), source, c, {"1": stage, "2": stage}).select("doc_id", "author_location_id", "type", "placed_when_judged")

    return run


def places(s, d):
    """Hosts of the first ten sources, placed in nations."""
    n = read(s, d, "nation").where("n_nationkey < 10")
    return n.select(F.lit("example.com").alias("domain"), geo().alias("author_location_id"), "n_nationkey").where("n_nationkey = 1").drop("n_nationkey")


_PIPE = f"WITH {POSTS} SELECT doc_id, (SELECT {GEO} FROM nation WHERE n_nationkey = 1) AS author_location_id, type, @@ AS placed_when_judged FROM posts WHERE {_NOT} AND language = 'en' AND doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1 OR quality = 0) AND (SELECT {GEO} FROM nation WHERE n_nationkey = 1) LIKE '\\_001%' ESCAPE '\\'"
QUERIES |= {"pipeline_base": _pipeline("google_news"), "pipeline_llm_early": _pipeline("facebook_keyword_search")}
ORACLES |= {"pipeline_base": _PIPE.replace("@@", "TRUE"), "pipeline_llm_early": _PIPE.replace("@@", "FALSE")}

_ASCII_HEAD = "trim(regexp_replace(substring(body, 1, 250), '\\s+', ' ', 'g'))"


@query(
    "llm_batches",
    f"""WITH {POSTS}, n AS (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS k FROM posts)
      SELECT k // 20 AS batch_id, string_agg('[' || (k % 20 + 1) || '] user_name: ' || author || ' | ' || {_ASCII_HEAD}, chr(10) || chr(10) ORDER BY k) AS prompt FROM n GROUP BY 1""",
)
def llm_batches(s, d):
    return filters.prompts(filters.batches(posts(s, d)), snippet(F.col("body"), []))


@query(
    "llm_apply_verdicts",
    f"""WITH {POSTS}, n AS (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS k FROM posts)
      SELECT doc_id FROM n LEFT JOIN labels USING (doc_id) WHERE (k // 20) % 7 = 0 OR coalesce(quality, 1) = 1""",
)
def llm_apply_verdicts(s, d):
    """Replies are built from the labels; every seventh batch gets a reply that is no list."""
    b = filters.batches(posts(s, d))
    good = b.join(read(s, d, "labels"), "doc_id", "left").where("coalesce(quality, 1) = 1")
    lists = good.groupBy("batch_id").agg(F.concat(F.lit("```json\n"), F.to_json(F.collect_list("batch_index")), F.lit("```")).alias("r"))
    replies = b.select("batch_id").distinct().join(lists, "batch_id", "left").select("batch_id", F.when(F.col("batch_id") % 7 == 0, "I cannot say").otherwise(F.coalesce("r", F.lit("[]"))).alias("reply"))
    return filters.apply_verdicts(b, replies).select("doc_id")


@query("snippet_head", f"WITH {POSTS} SELECT doc_id, {_ASCII_HEAD} AS snippet FROM posts")
def snippet_head(s, d):
    return posts(s, d).select("doc_id", text.snippet_head(F.col("body")).alias("snippet"))


@query("snippet_keyword")
def snippet_keyword(s, d):
    return posts(s, d).select("doc_id", snippet(F.col("body"), ["license", "idiot", "tion"]).alias("snippet"))


_HOST = "lower(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1))"
_DOMAIN = f"regexp_extract({_HOST}, '([^.]+\\.[^.]+)$', 1)"


@query("url_domain", f"SELECT page_id, {_HOST} AS host, {_DOMAIN} AS domain, regexp_replace({_DOMAIN}, '\\.[^.]*$', '') AS label FROM pages")
def url_domain(s, d):
    u = F.col("url")
    return read(s, d, "pages").select("page_id", urls.host(u).alias("host"), urls.registrable_domain(u).alias("domain"), urls.without_last_label(urls.registrable_domain(u)).alias("label"))


#: Four spellings of a page's address, most of them wrong in some way.
_SPELLINGS = {
    "full_url": ("url", lambda h: F.col("url")),
    "host_query": ("split_part(url, '/', 3) || '?a=1'", lambda h: F.concat(h, F.lit("?a=1"))),
    "bare_host": ("split_part(url, '/', 3)", lambda h: h),
    "with_port": ("'http://' || split_part(url, '/', 3) || ':' || page_id || '0/x'", lambda h: F.concat(F.lit("http://"), h, F.lit(":"), F.col("page_id"), F.lit("0/x"))),
    "odd_label": ("'https://' || CASE page_id % 4 WHEN 0 THEN '-a.' WHEN 1 THEN 'a-.' WHEN 2 THEN '.' ELSE 'a_b.' END || split_part(url, '/', 3)", lambda h: F.concat(F.lit("https://"), F.when(F.col("page_id") % 4 == 0, "-a.").when(F.col("page_id") % 4 == 1, "a-.").when(F.col("page_id") % 4 == 2, ".").otherwise("a_b."), h)),
    "blank_in_path": ("url || CASE page_id % 2 WHEN 0 THEN '/a b' ELSE '  ' END", lambda h: F.concat(F.col("url"), F.when(F.col("page_id") % 2 == 0, "/a b").otherwise("  "))),
}


def _valid_sql(name: str, u: str) -> str:
    """The rule with lists: every label, the port and the path are looked at alone."""
    return (
        f"(SELECT len(ls) >= 2 AND len(list_filter(ls[:-2], lambda x: length(x) NOT BETWEEN 1 AND 63 OR translate(lower(x), 'abcdefghijklmnopqrstuvwxyz0123456789-', '') <> '' OR x[1] = '-' OR x[-1] = '-')) = 0"
        " AND length(ls[-1]) >= 2 AND translate(lower(ls[-1]), 'abcdefghijklmnopqrstuvwxyz', '') = '' AND len(hp) <= 2 AND (len(hp) = 1 OR (length(hp[2]) BETWEEN 1 AND 5 AND translate(hp[2], '0123456789', '') = '')) AND NOT contains(tail, ' ')"
        " FROM (SELECT string_split(hp[1], '.') AS ls, hp, tail FROM (SELECT string_split(split_part(b, '/', 1), ':') AS hp, b[length(split_part(b, '/', 1)) + 1:] AS tail FROM"
        f" (SELECT CASE WHEN v LIKE 'https://%' THEN v[9:] WHEN v LIKE 'http://%' THEN v[8:] ELSE v END AS b FROM (SELECT trim({u}) AS v))))) AS {name}"
    )


@query("url_valid", f"SELECT page_id, {', '.join(_valid_sql(n, u) for n, (u, _) in _SPELLINGS.items())} FROM pages")
def url_valid(s, d):
    h = F.split_part("url", F.lit("/"), F.lit(3))
    return read(s, d, "pages").select("page_id", *[urls.is_valid_url(f(h)).alias(n) for n, (_, f) in _SPELLINGS.items()])


@query(
    "url_blacklist",
    "SELECT page_id, page_id % 4 IN (0, 1) AS never FROM pages",
)
def url_blacklist(s, d):
    k = F.col("page_id") % 4
    u = F.when(k == 0, F.lit("https://m.youtube.com/watch?v=1")).when(k == 1, F.lit("https://www.google.com/maps/place/1")).when(k == 2, F.lit("https://www.google.com/search")).otherwise(F.col("url"))
    return read(s, d, "pages").select("page_id", urls.is_never_article(u).alias("never"))


@query(
    "first_external_url",
    """SELECT doc_id, CASE WHEN doc_id % 3 = 2 THEN NULL ELSE url END AS link FROM documents LEFT JOIN pages ON page_id = doc_id""",
)
def first_external_url(s, d):
    x = read(s, d, "documents").join(read(s, d, "pages"), F.col("page_id") == F.col("doc_id"), "left")
    body = F.concat(F.col("text"), F.lit(" see https://twitter.com/a/1, and "), F.when((F.col("doc_id") % 3 == 2) | F.col("url").isNull(), F.lit("nothing")).otherwise(F.concat(F.col("url"), F.lit(")."))))
    return x.select("doc_id", urls.first_external_url(body, F.lit("https://www.facebook.com/p/1")).alias("link"))


@query("url_hash_path", "SELECT page_id, '/media/' || substring(md5(url), 1, 12) || '.mp4' AS path FROM pages")
def url_hash_path(s, d):
    return read(s, d, "pages").select("page_id", urls.media_path("/media/", F.col("url"), F.lit("mp4")).alias("path"))


@query("clean_html_text")
def clean_html_text(s, d):
    return read(s, d, "pages").select("page_id", clean_html(F.col("html")).alias("clean"))


@query("article_extract")
def article_extract(s, d):
    return extracted_articles(read(s, d, "pages"))


@query("article_meaningful", "SELECT doc_id, length(trim(text)) >= 200 AND trim(substring(text, 1, 80)) <> '' AS meaningful FROM documents")
def article_meaningful(s, d):
    return read(s, d, "documents").select("doc_id", filters.meaningful_article(F.substring("text", 1, 80), F.col("text")).alias("meaningful"))


@query(
    "attach_article",
    f"""WITH {POSTS} SELECT doc_id, CASE WHEN url_p IS NULL THEN body ELSE body || chr(10) || chr(10) || ' attached_url_text: ' || html END AS body, url_p AS article
      FROM posts LEFT JOIN (SELECT page_id, url AS url_p, html FROM pages) ON page_id = doc_id""",
)
def attach_article(s, d):
    """A post links the page of its number: pages can share a URL."""
    p = read(s, d, "pages").select("page_id", "url", F.col("html").alias("body"))
    out = lookups.attach_articles(posts(s, d), p, F.col("doc_id"), "page_id")
    return out.select("doc_id", "body", F.col("attached_news.url").alias("article"))


@query(
    "source_location_join",
    f"""SELECT s_suppkey, CASE WHEN n_nationkey IS NULL THEN 'kept' ELSE n_name END AS author_location_text, {GEO} AS location_author_geoid, substring({GEO}, 1, 4) AS country
      FROM supplier LEFT JOIN (SELECT * FROM nation WHERE n_nationkey % 2 = 0) ON s_nationkey = n_nationkey""",
)
def source_location_join(s, d):
    n = read(s, d, "nation").where("n_nationkey % 2 = 0").select(F.concat(F.lit("n"), F.col("n_nationkey"), F.lit(".example")).alias("domain"), F.col("n_name").alias("author_location_text"), geo().alias("location_author_geoid"))
    docs = read(s, d, "supplier").select("s_suppkey", F.concat(F.lit("n"), F.col("s_nationkey"), F.lit(".example")).alias("d"), F.lit("old").alias("author_location_text"))
    out = lookups.source_places(docs, n, F.col("d"))
    known = F.col("location_author_geoid").isNotNull()
    return out.select("s_suppkey", F.when(known, F.col("author_location_text")).otherwise("kept").alias("author_location_text"), "location_author_geoid", lookups.source_country(F.col("location_author_geoid")).alias("country"))


@query("source_name_fallback", f"SELECT page_id, CASE WHEN {_HOST} LIKE 'www.%' THEN upper({_HOST}) ELSE regexp_replace({_HOST}, '\\.[^.]*$', '') END AS source_name FROM pages")
def source_name_fallback(s, d):
    x = read(s, d, "pages").select("page_id", urls.host(F.col("url")).alias("domain"))
    known = x.where(F.col("domain").startswith("www.")).select("domain", F.upper("domain").alias("sitio")).distinct()
    return lookups.source_name(x, known).select("page_id", "source_name")


@query(
    "unknown_sources_merge",
    f"""WITH p AS (SELECT {_HOST} AS domain, url FROM pages WHERE page_id % 3 <> 0), k AS (SELECT DISTINCT {_HOST} AS domain FROM pages WHERE page_id % 3 = 0)
      SELECT domain, min(url) AS url, CAST('seen' AS VARCHAR) AS source FROM p WHERE domain NOT IN (SELECT domain FROM k) GROUP BY domain""",
)
def unknown_sources_merge(s, d):
    x = read(s, d, "pages").select("page_id", urls.host(F.col("url")).alias("domain"), "url", F.lit("seen").alias("source"))
    return lookups.unknown_sources(x.where("page_id % 3 <> 0"), x.where("page_id % 3 = 0"))


def users(s, d):
    return read(s, d, "customer").select(F.concat(F.lit("https://s.example/u"), F.col("c_custkey"), F.lit("/")).alias("profile_url"), F.when(F.col("c_custkey") % 4 > 0, F.round(F.abs("c_acctbal") * 100).cast("long")).alias("website_visits"), F.col("c_name").alias("author_full_name"), F.col("c_custkey").alias("_ord"))


_VISITS = "CASE WHEN c_custkey % 4 > 0 THEN CAST(round(abs(c_acctbal) * 100) AS BIGINT) END"


@query(
    "user_stats_fill",
    f"""SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey ELSE {_VISITS} END AS website_visits, CASE WHEN {_VISITS} IS NOT NULL THEN c_name END AS author_full_name
      FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
)
def user_stats_fill(s, d):
    o = read(s, d, "orders").select("o_orderkey", F.concat(F.lit("https://s.example/u"), F.col("o_custkey")).alias("profile_url"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey")).alias("website_visits"), F.lit(None).cast("string").alias("author_full_name"))
    return lookups.fill_from_users(o, users(s, d)).select("o_orderkey", "website_visits", "author_full_name")


@query("user_stale_keys", f"SELECT 'https://s.example/u' || user_id AS profile_url FROM events GROUP BY user_id HAVING TIMESTAMP '{NOW}' - max(ts) > INTERVAL 3 DAYS")
def user_stale_keys(s, d):
    e = read(s, d, "events").select(F.concat(F.lit("https://s.example/u"), F.col("user_id")).alias("profile_url"), "ts")
    stored = e.groupBy("profile_url").agg(F.max("ts").alias("date_stats_updated"))
    return lookups.stale_profiles(e.withColumn("profile_url", F.concat("profile_url", F.lit("/"))), stored, F.lit(NOW).cast("timestamp"), 3)


@query(
    "user_upsert_stats",
    f"""SELECT 'https://s.example/u' || coalesce(c_custkey, s_suppkey) AS profile_url, CASE WHEN s_suppkey IS NULL THEN {_VISITS} WHEN s_suppkey % 2 = 0 THEN 7 END AS website_visits,
      coalesce(c_name, NULL) AS author_full_name, CASE WHEN s_suppkey IS NOT NULL THEN '{NOW}' END AS updated FROM customer FULL JOIN supplier ON c_custkey = s_suppkey""",
)
def user_upsert_stats(s, d):
    new = read(s, d, "supplier").select(F.concat(F.lit("https://s.example/u"), F.col("s_suppkey"), F.lit("/")).alias("profile_url"), F.when(F.col("s_suppkey") % 2 == 0, F.lit(7).cast("long")).alias("website_visits"))
    out = state.merge_user_stats(state.canonical_users(users(s, d)), new, F.lit(NOW))
    return out.select("profile_url", "website_visits", "author_full_name", F.col("date_stats_updated").alias("updated"))


@query(
    "user_upsert_location",
    """SELECT 'https://s.example/u' || coalesce(c_custkey, s_suppkey) AS profile_url, coalesce(CASE WHEN s_suppkey % 2 = 0 THEN s_name END, c_name) AS place FROM customer FULL JOIN supplier ON c_custkey = s_suppkey""",
)
def user_upsert_location(s, d):
    old = read(s, d, "customer").select(F.concat(F.lit("https://s.example/u"), F.col("c_custkey")).alias("profile_url"), F.col("c_name").alias("place"))
    new = read(s, d, "supplier").select(F.concat(F.lit("https://s.example/u"), F.col("s_suppkey"), F.lit("/")).alias("profile_url"), F.when(F.col("s_suppkey") % 2 == 0, F.col("s_name")).alias("place"))
    return state.merge_user_places(old, new)


@query(
    "profile_multi_key_join",
    """WITH k AS (SELECT c_custkey, c_mktsegment AS name FROM customer UNION ALL SELECT c_custkey, c_name FROM customer),
      f AS (SELECT name, min(c_custkey) AS c_custkey FROM k GROUP BY name)
      SELECT x.c_custkey AS post, f.c_custkey AS visits FROM customer x LEFT JOIN f ON f.name = CASE WHEN x.c_custkey % 3 = 0 THEN x.c_name WHEN x.c_custkey % 6 = 1 THEN x.c_mktsegment WHEN x.c_custkey % 6 = 4 THEN lower(x.c_mktsegment) ELSE 'nobody' END""",
)
def profile_multi_key_join(s, d):
    c = read(s, d, "customer")
    key = F.when(F.col("c_custkey") % 3 == 0, F.col("c_name")).when(F.col("c_custkey") % 6 == 1, F.col("c_mktsegment")).when(F.col("c_custkey") % 6 == 4, F.lower("c_mktsegment")).otherwise("nobody")
    prof = c.select(F.col("c_custkey").alias("_ord"), "c_name", "c_mktsegment", F.col("c_custkey").alias("visits"))
    return lookups.profiles_by_name(c.select(F.col("c_custkey").alias("post"), key.alias("author")), prof, ["c_name", "c_mktsegment"], "author", ("visits",)).select("post", "visits")


def comments(s, d):
    c = read(s, d, "conversations")
    return c.select(F.col("conv_id").alias("post_url"), F.col("turn").alias("_ord"), mappers.comment(F.col("text"), F.col("role"), F.lit(None), F.length("text")).alias("comment"))


@query("comments_group", "SELECT conv_id, count(*) AS n, string_agg(role || ':' || text, '|' ORDER BY turn) AS said FROM conversations WHERE turn < 15 GROUP BY conv_id")
def comments_group(s, d):
    g = lookups.grouped_comments(comments(s, d), most=15)
    line = F.transform("comments", lambda c: F.concat(c["comment_author"], F.lit(":"), c["comment_text"]))
    return g.select(F.col("post_url").alias("conv_id"), F.size("comments").cast("long").alias("n"), F.array_join(line, "|").alias("said"))


@query("comments_join", "SELECT doc_id, coalesce(n, 0) AS n_comments, coalesce(likes, 0) AS comment_likes FROM documents LEFT JOIN (SELECT conv_id, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS likes FROM conversations GROUP BY 1) ON conv_id = doc_id")
def comments_join(s, d):
    p = read(s, d, "documents").select("doc_id", F.col("doc_id").alias("url"))
    out = lookups.attach_comments(p, lookups.grouped_comments(comments(s, d)))
    return out.select("doc_id", F.size("comments").cast("long").alias("n_comments"), F.aggregate("comments", F.lit(0).cast("long"), lambda a, c: a + c["comment_likes"]).alias("comment_likes"))


@query("comment_id", "SELECT conv_id, turn, 'https://e.example/p/' || conv_id || '-' || substring(md5(role), 1, 8) || '-20240101' || lpad(CAST(turn % 24 AS VARCHAR), 2, '0') || '00' AS comment_id FROM conversations")
def comment_id(s, d):
    c = read(s, d, "conversations")
    at = F.timestamp_seconds(F.lit(1704067200) + (F.col("turn") % 24) * 3600)
    return c.select("conv_id", "turn", text.comment_id(F.concat(F.lit("https://e.example/p/"), F.col("conv_id")), F.col("role"), at).alias("comment_id"))


@query("dedupe_first_wins", "SELECT min(doc_id) AS doc_id FROM documents GROUP BY text")
def dedupe_first_wins(s, d):
    return lookups.dedupe_first_wins(read(s, d, "documents").select("doc_id", F.col("doc_id").alias("_ord"), F.sha2("text", 256).alias("url"))).select("doc_id")


@query(
    "likes_gate",
    "SELECT o_custkey FROM (SELECT o_custkey, count(*) AS likes, sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS n_comments FROM orders GROUP BY 1) WHERE likes > 10 AND n_comments > 0",
)
def likes_gate(s, d):
    g = read(s, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("likes"), F.sum(F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)).alias("n_comments"))
    return g.where(filters.over("likes", 10) & filters.over("n_comments", 0)).select("o_custkey")


def _steps(steps, last):
    return "CASE WHEN v IS NULL THEN NULL " + " ".join(f"WHEN v < {b} THEN {x}" for b, x in steps) + f" ELSE {last} END"


@query("source_tier_valuation", f"WITH c AS (SELECT c_custkey, {_VISITS} AS v FROM customer) SELECT c_custkey, {_steps(text.TIER_BELOW, 1)} AS tier, {_steps(text.VALUE_BELOW, 50000)} AS article_value FROM c")
def source_tier_valuation(s, d):
    return users(s, d).select(F.col("_ord").alias("c_custkey"), text.tier(F.col("website_visits")).alias("tier"), text.article_value(F.col("website_visits")).alias("article_value"))


_W = r"[\p{L}\p{M}\p{N}_]"


@query(
    "text_metrics",
    rf"""SELECT doc_id, CAST(len(list_filter(regexp_split_to_array(text, '[\s\x0b\x{{85}}\x{{a0}}\x{{2028}}\x{{3000}}]+'), lambda x: x <> '')) AS INTEGER) AS words,
      CAST(len(regexp_extract_all(text, '(^|[^\p{{L}}\p{{M}}\p{{N}}_])#{_W}')) AS INTEGER) AS hashtags, CAST(len(regexp_extract_all(text, '(^|[^\p{{L}}\p{{M}}\p{{N}}_])@{_W}')) AS INTEGER) AS mentions FROM documents""",
)
def text_metrics(s, d):
    t = F.col("text")
    return read(s, d, "documents").select("doc_id", text.word_count(t).alias("words"), text.hashtag_count(t).alias("hashtags"), text.mention_count(t).alias("mentions"))


def messages(s, d):
    """Posts with an engagement time; some lose what a message needs."""
    e = read(s, d, "events").select(F.col("event_id").alias("doc_id"), F.col("ts").alias("at"))
    p = posts(s, d).join(e, "doc_id", "left").withColumn("timestamp", F.when(F.col("doc_id") % 11 > 0, F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss'Z'")))
    bad = {"type": F.when(F.col("doc_id") % 13 == 0, "News").otherwise("facebook"), "url": F.when(F.col("doc_id") % 17 == 0, "not a url").otherwise(F.col("url"))}
    p = mappers.post_fallbacks(p.withColumns(bad | {"website_visits": F.col("likes") * 2}))
    return compiler(NOW).normalize(p, "News", keep=("doc_id",))


_ERR = "CASE WHEN doc_id % 11 = 0 OR event_id IS NULL THEN 'Missing required field: timestamp' WHEN doc_id % 13 = 0 THEN 'Invalid value in field: type' WHEN doc_id % 17 = 0 THEN 'Missing required field: url' END"


@query(
    "normalize_message",
    f"""WITH {POSTS}, x AS (SELECT posts.*, event_id, ts FROM posts LEFT JOIN events ON event_id = doc_id)
      SELECT doc_id, source, 'facebook' AS type, likes AS fb_likes, likes AS stats_likes, likes * 2 AS visits, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS at, '{NOW}' AS added, FALSE AS found, 0 AS n_media, url
      FROM x WHERE {_ERR} IS NULL""",
)
def normalize_message(s, d):
    good, _ = schema.split_rejects(messages(s, d))
    m, fmt = F.col("message"), "yyyy-MM-dd HH:mm:ss"
    return good.select(
        "doc_id", m["source"].alias("source"), m["type"].alias("type"), m["fb_likes"].alias("fb_likes"), m["source_extra"]["stats"]["likes"].alias("stats_likes"),
        m["source_extra"]["stats"]["website_visits"].alias("visits"), F.date_format(m["timestamp"], fmt).alias("at"), F.date_format(m["timestamp_added"], fmt).alias("added"),
        m["source_extra"]["__FOUND_SOURCE__"].alias("found"), F.size(m["media_urls"]).alias("n_media"), m["url"].alias("url"),
    )


@query("normalize_rejects", f"WITH {POSTS}, x AS (SELECT posts.*, event_id FROM posts LEFT JOIN events ON event_id = doc_id) SELECT doc_id, {_ERR} AS error FROM x WHERE {_ERR} IS NOT NULL")
def normalize_rejects(s, d):
    return schema.split_rejects(messages(s, d))[1].select("doc_id", "error")


@query(
    "flatten_record",
    """SELECT conv_id, 'turns.' || (turn + 1) || '.role' AS field, role AS value FROM conversations UNION ALL SELECT conv_id, 'turns.' || (turn + 1) || '.size', CAST(length(text) AS VARCHAR) FROM conversations
      UNION ALL SELECT conv_id, 'roles', string_agg(role, ' | ' ORDER BY turn) FROM conversations GROUP BY conv_id""",
)
def flatten_record(s, d):
    """The flat record of every conversation, one row per column that has a value."""
    c = read(s, d, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", F.length("text").alias("size")))).alias("t"))
    c = c.select("conv_id", F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["size"].alias("size"))).alias("turns"), F.transform("t", lambda x: x["role"]).alias("roles"))
    flat = schema.flatten(c)
    pairs = F.array(*[F.struct(F.lit(n).alias("field"), F.col(f"`{n}`").cast("string").alias("value")) for n in flat.columns if n != "conv_id"])
    return flat.select("conv_id", F.inline(pairs)).where("value IS NOT NULL")


@query(
    "expand_attached",
    f"WITH {POSTS} SELECT doc_id AS _ord, 0 AS _part, url FROM posts UNION ALL SELECT page_id, 1, url FROM pages WHERE page_id IN (SELECT doc_id FROM documents)",
)
def expand_attached(s, d):
    p = read(s, d, "pages").select("page_id", "url", F.col("html").alias("body"))
    return lookups.with_attached(lookups.attach_articles(posts(s, d), p, F.col("doc_id"), "page_id"), ["url"])


_TASKS = [
    {"task_id": "a", "actor_class": "google_news", "search_params": " x , y ,", "period": "W", "max_results": "5", "enabled": "yes", "not_keywords": "p| q |"},
    {"task_id": "", "actor_class": "twitter_keyword_search", "search_params": "k", "period": "year", "enabled": "no", "get_comments": "t", "theme": " Food "},
    {"task_id": "c", "actor_class": "google_news", "search_params": "z", "period": "d", "min_date": "2024-01-01"},
]


@query(
    "task_parse",
    """SELECT * FROM (VALUES ('a', 2, 'w', 5, TRUE, FALSE, 'p,q', CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR)), ('twitter_keyword_search:k', 1, NULL, 30, FALSE, TRUE, '', 'food', NULL),
      ('c', 1, 'd', 30, TRUE, FALSE, '', NULL, 'min_date and period are mutually exclusive')) t(task_id, n_params, period, max_results, enabled, get_comments, not_keywords, theme, error)""",
)
def task_parse(s, d):
    rows = s.createDataFrame([tuple(t.get(c) for c in tasks.COLUMNS) for t in _TASKS], ", ".join(f"{c} string" for c in tasks.COLUMNS))
    t = tasks.parse_tasks(rows)
    return t.select("task_id", F.size("search_params").alias("n_params"), "period", "max_results", "enabled", "get_comments", F.array_join("not_keywords", ",").alias("not_keywords"), "theme", "error")


@query("publish_json")
def publish_json(s, d):
    return sinks.bodies(messages(s, d))


def _raw(df, *cols):
    return df.select(F.col("doc_id").alias("_ord"), F.to_json(F.struct(*cols)).alias("raw"))


def _mapped(s, d, platform, *cols):
    return mappers.map_raw(_raw(read(s, d, "documents"), *cols), platform)


_MAP = "SELECT doc_id AS doc_id, {} FROM documents"


@query("map_news", _MAP.format("'https://n.example/' || doc_id AS url, substring(text, 1, 40) AS title, text AS body, CASE WHEN doc_id % 2 = 0 THEN 'https://i.example/' || doc_id ELSE '' END AS media, source, 'news' AS type"))
def map_news(s, d):
    i = F.col("doc_id")
    m = _mapped(s, d, "news", F.concat(F.lit("https://n.example/"), i).alias("link"), F.lit("https://other.example/").alias("url"), F.substring("text", 1, 40).alias("title"), F.col("text").alias("description"), F.when(i % 2 == 0, F.concat(F.lit("https://i.example/"), i)).alias("image"), "source")
    return m.select(F.col("_ord").alias("doc_id"), "url", "title", "body", F.array_join("media_urls", "|").alias("media"), "source", "type")


@query(
    "map_facebook",
    _MAP.format(
        """CASE WHEN doc_id % 3 = 0 THEN source ELSE 'page' || doc_id END AS author, CASE WHEN doc_id % 2 = 0 THEN 'Video' ELSE 'Photo' END AS post_type,
        'https://m.example/' || CASE WHEN doc_id % 2 = 0 THEN 'hd' ELSE 'pic' END || doc_id AS media, nullif(substring(text, 1, 80), '') AS title, n_chars AS likes,
        strftime(to_timestamp(1704067200 + doc_id) AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%S+00:00') AS at, 'https://www.facebook.com/' || CASE WHEN doc_id % 3 = 0 THEN source ELSE 'page' || doc_id END || '/' AS profile_url"""
    ),
)
def map_facebook(s, d):
    i = F.col("doc_id")
    at = lambda p: F.concat(F.lit(f"https://m.example/{p}"), i)
    media = F.array(
        F.struct(F.when(i % 2 == 0, "Video").otherwise("Photo").alias("__typename"), F.struct(at("pic").alias("uri")).alias("photo_image"), F.struct(at("sd").alias("browser_native_sd_url"), at("hd").alias("browser_native_hd_url")).alias("videoDeliveryLegacyFields"))
    )
    user = F.when(i % 3 == 0, F.struct(F.col("source").alias("name")))
    m = _mapped(s, d, "facebook", F.concat(F.lit("https://www.facebook.com/page"), i, F.lit("/posts/1")).alias("url"), "text", (i + 1704067200).alias("timestamp"), F.col("n_chars").alias("likes"), media.alias("media"), user.alias("user"))
    return m.select(F.col("_ord").alias("doc_id"), "author", "post_type", F.array_join("media_urls", "|").alias("media"), "title", "likes", F.col("timestamp").alias("at"), "profile_url")


@query(
    "map_facebook_search",
    _MAP.format("source AS author, text AS body, CASE WHEN doc_id % 2 = 0 THEN n_chars ELSE 0 END AS likes, CASE WHEN doc_id % 3 = 0 THEN 'Video' WHEN doc_id % 3 = 1 THEN 'Photo' ELSE 'Status' END AS post_type, 'https://p.example/' || doc_id AS url, CASE WHEN doc_id % 3 = 0 THEN 'v|i|hd' || doc_id WHEN doc_id % 3 = 1 THEN 'p|al|i' ELSE '' END AS media"),
)
def map_facebook_search(s, d):
    i = F.col("doc_id")
    m = _mapped(
        s, d, "facebook_search", F.struct(F.lit("").alias("name"), F.col("source").alias("full_name")).alias("author"), F.concat(F.lit("https://p.example/"), i).alias("permalink"), F.lit("").alias("message_rich"),
        F.col("text").alias("message"), F.when(i % 2 == 0, F.col("n_chars")).otherwise(0).alias("likes_count"), F.lit(9).alias("reactions_count"), F.when(i % 3 == 0, "v").alias("video_url"), F.when(i % 3 == 1, "p").alias("image"),
        F.when(i % 3 == 1, F.array(F.struct(F.lit("al").alias("image_file_uri")))).alias("album_preview"), F.when(i % 3 < 2, F.array(F.struct(F.lit("").alias("url"), F.lit("i").alias("src")))).alias("images"),
        F.when(i % 3 == 0, F.array(F.struct(F.concat(F.lit("hd"), i).alias("hd")))).alias("videos"),
    )
    return m.select(F.col("_ord").alias("doc_id"), "author", "body", "likes", "post_type", "url", F.array_join("media_urls", "|").alias("media"))


@query("map_instagram", _MAP.format("source AS author, 'https://www.instagram.com/u' || doc_id || '/' AS profile_url, 'd' || doc_id || '|i1|c' || doc_id || '|g' AS media, CASE WHEN doc_id % 2 = 0 THEN 5 ELSE n_chars END AS views, substring(text, 1, 80) AS title"))
def map_instagram(s, d):
    i = F.col("doc_id")
    grand = F.array(F.struct(F.lit("g").alias("displayUrl")))
    child = F.array(F.struct(F.concat(F.lit("c"), i).alias("displayUrl"), grand.alias("childPosts")))
    m = _mapped(s, d, "instagram", F.col("text").alias("caption"), F.concat(F.lit("u"), i).alias("ownerUsername"), F.col("source").alias("ownerFullName"), F.concat(F.lit("d"), i).alias("displayUrl"), F.array(F.lit("i1"), F.lit("")).alias("images"), child.alias("childPosts"), F.when(i % 2 == 0, 5).otherwise(0).alias("videoPlayCount"), F.col("n_chars").alias("igPlayCount"))
    return m.select(F.col("_ord").alias("doc_id"), "author", "profile_url", F.array_join("media_urls", "|").alias("media"), "views", "title")


@query("map_linkedin", _MAP.format("'Ann ' || source AS author, n_chars AS likes, 'm1|m1|doc' || doc_id AS media, CASE WHEN doc_id % 2 = 0 THEN 'Image' ELSE 'Document' END AS post_type, 12 AS website_visits"))
def map_linkedin(s, d):
    i = F.col("doc_id")
    media = F.array(F.struct(F.when(i % 2 == 0, "PHOTO").otherwise("other").alias("type"), F.lit("m1").alias("url")), F.struct(F.lit("other").alias("type"), F.lit("m1").alias("url")))
    author = F.struct(F.lit("Ann").alias("firstName"), F.col("source").alias("lastName"), F.lit(0).alias("followersCount"), F.lit(12).alias("connectionsCount"))
    m = _mapped(s, d, "linkedin", author.alias("author"), F.col("text").alias("content"), F.lit(0).alias("likesCount"), F.struct(F.lit(0).alias("numLikes"), F.col("n_chars").alias("total")).alias("reactions"), media.alias("media"), F.concat(F.lit("doc"), i).alias("documentUrl"), F.lit("m1").alias("imageUrl"))
    return m.select(F.col("_ord").alias("doc_id"), "author", "likes", F.array_join("media_urls", "|").alias("media"), "post_type", F.col("website_visits").cast("int").alias("website_visits"))


@query("map_x", _MAP.format("source AS source, 'https://x.com/' || source || '/status/' || doc_id AS url, CASE WHEN doc_id % 3 = 0 THEN 'Reply' WHEN doc_id % 3 = 1 THEN 'Quote' ELSE 'Tweet' END AS post_type, n_chars AS likes, lang AS language, 'a|b' AS media"))
def map_x(s, d):
    i = F.col("doc_id")
    m = _mapped(
        s, d, "x", F.struct(F.col("source").alias("screen_name")).alias("user"), i.cast("string").alias("id"), F.col("text").alias("full_text"), (i % 3 == 0).alias("isReply"), F.when(i % 3 == 1, "7").alias("quoted_status_id"),
        F.lit(0).alias("likeCount"), F.col("n_chars").alias("favorite_count"), "lang", F.array(F.struct(F.lit("a").alias("media_url_https"))).alias("media"), F.struct(F.array(F.struct(F.lit("a").alias("url")), F.struct(F.lit("b").alias("url"))).alias("media")).alias("entities"),
    )
    return m.select(F.col("_ord").alias("doc_id"), "source", "url", "post_type", "likes", "language", F.array_join("media_urls", "|").alias("media"))


@query(
    "analysis_meta_fields",
    r"""SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'Single Video' END AS post_format, CAST(len(regexp_extract_all(text, '(^|[^\p{L}\p{M}\p{N}_])#[\p{L}\p{M}\p{N}_]')) AS INTEGER) AS hashtags, CAST(CASE WHEN doc_id % 4 = 0 THEN 50.0 WHEN doc_id % 4 = 1 THEN 33.33 WHEN doc_id % 4 = 2 THEN 0.0 ELSE 200.0 END AS DOUBLE) AS emoji_pct FROM documents""",
)
def analysis_meta_fields(s, d):
    kind = F.when(F.col("doc_id") % 2 == 0, "Reel").otherwise("Text")
    m = analysis.meta_fields(F.col("text"), kind)
    k = F.col("doc_id") % 4
    faces = F.when(k == 0, F.lit("so \U0001f600")).when(k == 1, F.lit("a \u2600b c")).when(k == 2, F.lit("none")).otherwise(F.lit("\U0001f600\U0001f680"))
    return read(s, d, "documents").select("doc_id", m["post_format"].alias("post_format"), m["hashtag_count"].alias("hashtags"), text.emoji_percent(faces).alias("emoji_pct"))


@query("section_questions", "SELECT section, string_agg(no || '. q' || no, chr(10) ORDER BY k) AS questions FROM (SELECT 'plot' AS section, unnest([40, 41, 43, 45]) AS no, unnest([1, 2, 3, 4]) AS k UNION ALL SELECT 'comments', unnest([69, 70, 71]), unnest([1, 2, 3])) GROUP BY 1")
def section_questions(s, d):
    sheet = s.createDataFrame([(str(n), f"q{n}") for n in (40, 41, 43, 45, 69, 70, 71, 99)] + [("Total", "x")], "no string, question string")
    return lookups.section_questions(analysis.section_table(s), sheet)


@query("analysis_records")
def analysis_records(s, d):
    """Every post described by a stand-in model that fails on one section."""
    p = posts(s, d).withColumn("post_type", F.lit("Reel"))
    q = section_questions(s, d)
    return analysis.records(p, analysis.answered(analysis.prompts(p, q), _describe))


def _describe(prompt: str) -> dict:
    if prompt.startswith("Section: plot"):
        raise ValueError("no answer")
    return {"said": len(prompt)}


@query("parser_gap_fill", "SELECT page_id, CASE WHEN page_id % 2 = 0 THEN url ELSE 'second' END AS title FROM pages")
def parser_gap_fill(s, d):
    first = F.when(F.col("page_id") % 2 == 0, F.col("url")).otherwise("")
    return read(s, d, "pages").select("page_id", analysis.fill_gaps(first, F.lit("second")).alias("title"))


def flagship(s: SparkSession, d: str) -> DataFrame:
    """Map, filter, normalise, and count the messages by language and outcome."""
    c = pipeline.Context({"task_id": "t1", "not_keywords": KEYWORDS, "language": None}, Providers())
    kept = pipeline.process(posts(s, d), "google_news", c)
    e = read(s, d, "events").select(F.col("event_id").alias("doc_id"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("at"))
    kept = kept.join(e, "doc_id", "left").withColumn("timestamp", F.col("at"))
    n = compiler(NOW).normalize(mappers.post_fallbacks(kept), "News", keep=("language",))
    return n.groupBy("language", F.coalesce("error", F.lit("ok")).alias("outcome")).agg(F.count("*").alias("n"))


QUERIES["flagship"] = flagship
ORACLES["flagship"] = f"WITH {POSTS} SELECT language, CASE WHEN event_id IS NULL THEN 'Missing required field: timestamp' ELSE 'ok' END AS outcome, count(*) AS n FROM posts LEFT JOIN events ON event_id = doc_id WHERE {_NOT} GROUP BY ALL"

from medialoom.plans import catalogue_scans  # noqa: E402,F401  (adds its queries)
