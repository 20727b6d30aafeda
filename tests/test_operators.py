"""Mappers, schema compiler, filters, lookups, state and pipeline on invented rows."""

from __future__ import annotations

import json

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from medialoom.operators import filters, lookups, mappers, schema, state
from medialoom.operators.schemas import compiler
from medialoom.plans import pipeline, tasks
from medialoom.sources import readers, sinks
from medialoom.sources.providers import Providers, gazetteer_provider, model_provider
from medialoom.streaming import incremental


def mapped(spark, platform, *items):
    df = spark.createDataFrame([(i, json.dumps(x)) for i, x in enumerate(items)], "_ord long, raw string")
    return mappers.map_raw(df, platform).orderBy("_ord").collect()


def test_every_mapper_takes_an_empty_payload(spark):
    for p in mappers.MAPPERS:
        r = mapped(spark, p, {})[0]
        assert set(mappers.FIELDS) < set(r.asDict()) and r.media_urls == [] and r.comments == []


def test_facebook(spark):
    a, b, c = mapped(
        spark, "facebook",
        {"url": "https://www.facebook.com/page/posts/1", "text": "t" * 90, "timestamp": 1704067200, "likes": 0, "media": [{"__typename": "Photo", "thumbnail": "th"}]},
        {"url": "https://www.facebook.com/reel/9", "user": {"name": "U"}}, {"url": "https://www.facebook.com/watch/9", "timestamp": "x"},
    )
    assert (a.author, a.post_type, a.media_urls, a.timestamp, len(a.title), a.likes) == ("page", "Photo", ["th"], "2024-01-01T00:00:00+00:00", 80, 0)
    assert (b.author, b.post_type, b.profile_url, b.title) == ("U", "Reel", "https://www.facebook.com/U/", None)
    assert (c.author, c.source, c.timestamp) == (None, "Facebook", None)


def test_zero_counts(spark):
    assert mapped(spark, "facebook_search", {"likes_count": 0, "reactions_count": 5})[0].likes == 0  # null-coalesce keeps zero
    assert mapped(spark, "x", {"likeCount": 0, "favorite_count": 4})[0].likes == 4  # falsy-coalesce skips it
    assert mapped(spark, "x", {"likeCount": 0, "favorite_count": 0, "likes": 0})[0].likes == 0


def test_x_user_keys_that_differ_by_case(spark):
    r = mapped(spark, "x", {"author": {"userName": "A", "username": "b", "followers_count": 3}, "id": 7, "isQuote": True})[0]
    assert (r.source, r.url, r.website_visits, r.post_type) == ("A", "https://x.com/A/status/7", 3, "Quote")


def test_facebook_page_profile(spark):
    raw = [json.dumps(x) for x in ({"followers": 0, "likes": 9, "title": "T", "info": ["a", "b"], "current_city": "Lives in C", "pageUrl": "u/"}, {"likes": 9})]
    df = spark.createDataFrame([(x,) for x in raw], "raw string").select(F.from_json("raw", mappers.FACEBOOK_PAGE_RAW).alias("r"))
    a, b = df.select(*[c.alias(k) for k, c in mappers.facebook_page(F.col("r")).items()]).collect()
    assert (a.website_visits, a.author_profile_bio, a.author_location_text, a.profile_url) == (0, "a\nb", "C", "u") and b.website_visits == 9


def normal(spark, ddl, row, name="News"):
    return compiler("2024-02-01 00:00:00").normalize(spark.createDataFrame([row], ddl), name).first()


BASE = "body string, source string, timestamp string, title string, url string, type string"
OK = ("b", "s", "2024-01-01T00:00:00Z", "t", "https://a.com/x", "news")


def test_message_defaults_and_overlay(spark):
    r = normal(spark, BASE + ", likes long, source_extra struct<stats:struct<likes:int>>", (*OK, 5, None))
    assert r.error is None and r.message.source_extra.stats.likes == 5 and r.message.comments == [] and r.message.source_extra["__FOUND_SOURCE__"] is False
    r = normal(spark, BASE + ", likes long, shares long, source_extra struct<stats:struct<likes:int>>", (*OK, 5, 6, ((7,),)))
    assert (r.message.source_extra.stats.likes, r.message.source_extra.stats.shares) == (7, None)  # an explicit stats replaces the flat one whole
    r = normal(spark, BASE + ", lat string, lon string", (*OK, "1.5", "x"))
    assert tuple(r.message.location_author.coords) == (1.5, None)


def test_comments(spark):
    ddl = BASE + ", comments array<struct<comment_text:string,comment_author:string,comment_timestamp:string,comment_likes:string>>"
    r = normal(spark, ddl, (*OK, [(" hi ", "a", "2024-01-01T10:05:00Z", "3"), None, ("x", None, None, "many")]))
    c = r.message.comments
    assert (c[0].comment_text, c[0].comment_likes, c[2].comment_likes) == ("hi", 3, None)
    assert c[0].comment_id.startswith("https://a.com/x-") and c[0].comment_id.endswith("-202401011005") and c[2].comment_id.endswith("-")


@pytest.mark.parametrize(
    ("change", "error"),
    [
        ({}, None), ({0: " "}, "Missing required field: body"), ({2: "soon"}, "Missing required field: timestamp"), ({4: None}, "Missing required field: url"),
        ({4: None, 5: "impreso"}, None), ({4: "bad url", 5: "impreso"}, "Invalid URL in field: url"), ({5: "News"}, "Invalid value in field: type"), ({5: None}, None),
    ],
)
def test_validation(spark, change, error):
    assert normal(spark, BASE, tuple(change.get(i, v) for i, v in enumerate(OK))).error == error


def test_one_bad_media_url_rejects(spark):
    assert normal(spark, BASE + ", media_urls array<string>", (*OK, ["https://a.com/1", "bad"])).error == "Invalid URL in field: media_urls"


def test_source_record(spark):
    r = normal(spark, "domain string, urls string, website_visits long", ("reforma.com", "https://reforma.com", 20000), "Source")
    m = r.message
    assert r.error is None and (m.sitio, m.stats.tier, m.stats.article_value, m.depth, m.minutes_to_sleep) == ("reforma", 2, 20000, 2, 90)
    assert normal(spark, "domain string, urls string", (None, None), "Source").errors == ["Missing required field: domain", "Missing required field: urls"]


def python_int(v):
    try:
        return int(float(v.strip())) if v and v.strip() and "_" not in v else None
    except (ValueError, OverflowError):
        return None


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.text("0123456789.-+e ", max_size=8)), min_size=1, max_size=30))
def test_int_field_like_a_row_oracle(spark, values):
    df = spark.createDataFrame([(i, *OK, v) for i, v in enumerate(values)], f"i int, {BASE}, fb_likes string")
    got = [r.message.fb_likes for r in compiler().normalize(df, keep=("i",)).orderBy("i").collect()]
    want = [python_int(v) for v in values]
    assert got == [w if w is None or abs(w) < 2**63 else None for w in want]


def docs(spark, *rows):
    base = {"_ord": None, "doc": None, **dict.fromkeys(mappers.FIELDS)}
    df = spark.createDataFrame([(i, r.get("raw")) for i, r in enumerate(rows)], "_ord long, _raw string")
    case = {f: F.lit(None).cast(t) if not t.startswith("array") else F.array().cast(t) for f, t in mappers.FIELDS.items()}
    for f in mappers.FIELDS:
        for i, r in enumerate(rows):
            if f in r:
                v = F.array(*map(F.lit, r[f])).cast(mappers.FIELDS[f]) if isinstance(r[f], list) else F.lit(r[f]).cast(mappers.FIELDS[f])
                case[f] = F.when(F.col("_ord") == i, v).otherwise(case[f])
    assert base
    return df.select("_ord", "_raw", *[c.alias(f) for f, c in case.items()])


def ids(df):
    return sorted(r["_ord"] for r in df.select("_ord").collect())


def test_place_filter(spark):
    d = docs(spark, {}, {"location_ids": ["_001x"]}, {"location_ids": ["_002x", "_001y"]}, {"location_ids": ["_002x"]}, {"location_ids": ["77"]},
             {"author_location_id": "_001"}, {"author_location_id": "_002"}, {"author_location_id": "88"}, {"location_ids": ["77", "_002"], "author_location_id": "_001"})
    assert ids(filters.in_place(d, "_001")) == [0, 1, 2, 4, 5, 7] and ids(filters.in_place(d, None)) == list(range(9))


def test_language_filter_with_detector(spark):
    d = docs(spark, {"language": "es-MX"}, {"language": "en"}, {"body": "el perro y la casa"}, {"body": "zzz"}, {"language": "klingon"}, {})
    from medialoom.functions.python_text import detect_language

    assert ids(filters.in_language(d, "spanish", detect_language)) == [0, 2, 3, 4, 5]
    assert ids(filters.in_language(d, "klingon", detect_language)) == list(range(6))


def test_cache_skip_and_merge(spark):
    d = docs(spark, {"url": "a"}, {"url": "b"}, {"url": None}, {"url": "a"})
    cache = spark.createDataFrame([("t", "a", False), ("t", "b", True), ("u", "b", False)], "task_id string, url string, survived boolean")
    assert ids(filters.not_rejected_before(d, cache, "t")) == [1, 2]
    assert ids(filters.not_rejected_before(d, cache, "t", override=True)) == ids(filters.not_rejected_before(d, cache, None)) == [0, 1, 2, 3]
    kept = filters.not_rejected_before(d, cache, "t")
    new = state.merge_filter_cache(cache, state.filter_outcomes(d, kept, "t"))
    assert {(r.task_id, r.url): r.survived for r in new.collect()} == {("t", "a"): False, ("t", "b"): True, ("u", "b"): False}
    again = state.merge_filter_cache(new, state.filter_outcomes(d, kept, "t"))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, new.collect()))


def test_batches_follow_order_over_partitions(spark):
    d = spark.range(0, 95, 1, 7).select((94 - F.col("id")).alias("_ord"))
    got = {r["_ord"]: (r.batch_id, r.batch_index) for r in filters.batches(d).collect()}
    assert got == {i: (i // 20, i % 20 + 1) for i in range(95)}


def test_dedupe_and_null_keys(spark):
    d = spark.createDataFrame([(2, "p", "x"), (1, "p", "y"), (3, None, "y"), (4, None, None), (5, "", None)], "_ord long, post_url string, url string")
    assert ids(lookups.dedupe_first_wins(d)) == [1, 3, 4, 5]


def test_comment_grouping(spark):
    c = spark.createDataFrame([(0, "u", "b", None), (1, "u", "a", None), (2, None, "x", None), (3, "v", "y", "failed")], "_ord long, post_url string, comment string, error string")
    g = {r.post_url: r.comments for r in lookups.grouped_comments(filters.usable_comments(c)).collect()}
    assert g == {"u": ["b", "a"]}
    assert lookups.grouped_comments(c, most=1).where("post_url = 'u'").first().comments == ["b"]


def test_profiles_last_and_first(spark):
    p = spark.createDataFrame([("k", 1)], "key string, post int")
    prof = spark.createDataFrame([(0, "k", 5), (1, "k", 6)], "_ord long, key string, visits int")
    assert lookups.last_profiles(p, prof, "key", ("visits",)).first().visits == 6
    assert lookups.first_value_per(prof, "key", "_ord", "visits").first().visits == 5


def test_user_state(spark):
    users = spark.createDataFrame([(0, "u/a/", 1, "A"), (1, "u/a", 2, None)], "_ord long, profile_url string, website_visits int, author_full_name string")
    one = state.canonical_users(users)
    assert [tuple(r) for r in one.collect()] == [("u/a", 2, None)]
    new = spark.createDataFrame([("u/a/", None, "x"), ("u/b", 3, None)], "profile_url string, website_visits int, extra string")
    stats = {r.profile_url: r for r in state.merge_user_stats(one, new, F.lit("now")).collect()}
    assert stats["u/a"].website_visits is None and stats["u/a"].date_stats_updated == "now" and stats["u/b"].website_visits == 3
    assert {r.profile_url: r.website_visits for r in state.merge_user_places(one, new).collect()} == {"u/a": 2, "u/b": 3}


@pytest.mark.parametrize(("said", "stale"), [(None, True), ("bad", True), ("2024-01-31", False), ("2023-10-01", True), ("2023-11-03", False)])
def test_staleness(spark, said, stale):
    d = spark.createDataFrame([(said,)], "s string")
    assert d.select(filters.is_stale(F.col("s").try_cast("timestamp"), F.lit("2024-02-01").cast("timestamp"), 90).alias("x")).first().x is stale


def test_versioned_table(spark, tmp_path):
    t = state.VersionedTable(spark, f"file://{tmp_path}/users")
    assert t.read("a int").count() == 0
    t.write(spark.createDataFrame([(1,)], "a int"))
    t.write(t.read("a int").selectExpr("a + 1 AS a"))
    assert t.read("a int").first().a == 2


def test_orders_and_registry():
    assert pipeline.order_of("google_news") == "KDCLAGP12M" and pipeline.order_of("facebook_keyword_search").index("1") < pipeline.order_of("facebook_keyword_search").index("A")
    with pytest.raises(KeyError, match="google_news"):
        pipeline.order_of("nope")


def test_pipeline_with_providers(spark):
    d = docs(
        spark, {"url": "https://p.com/0", "type": "facebook", "body": "good news https://a.com/1", "language": "es", "raw": "{}"}, {"url": "https://p.com/1", "type": "facebook", "body": "BAD word", "language": "es"},
        {"url": "https://p.com/2", "type": "facebook", "body": "from Lima", "language": "es", "author_location_text": "Lima"}, {"url": "https://p.com/3", "type": "facebook", "body": "drop me", "language": "es"},
    )
    articles = spark.createDataFrame([("https://a.com/1", "article text", None)], "url string, body string, timestamp string")
    comments = spark.createDataFrame([(0, "https://p.com/0", ("hi", "x", None, 1, None))], "_ord long, post_url string, comment struct<comment_text:string,comment_author:string,comment_timestamp:string,comment_likes:bigint,comment_id:string>")
    keep = lambda prompt: json.dumps([i + 1 for i, line in enumerate(prompt.split("\n\n[")) if "drop" not in line])
    task = {"task_id": "t", "not_keywords": ["bad"], "language": "es", "llm_filter_condition": "c", "fetch_attached_url": True, "get_comments": True, "max_comments": 5}
    c = pipeline.Context(task, Providers(model=model_provider(keep, pause=0), geocode=gazetteer_provider({"Lima": "_051"})), articles=articles, comments=comments)
    kept, outcomes = pipeline.run_task(d, "facebook_page_posts", c)
    got = {r["_ord"]: r for r in kept.collect()}
    assert set(got) == {0, 2}
    assert got[0].body.endswith("attached_url_text: article text") and got[0].attached_news.url == "https://a.com/1" and len(got[0].comments) == 1
    assert got[2].location_ids == ["_051", "_051"] and got[2].location_author_geoid == "_051"
    assert {r.url: r.survived for r in outcomes.collect()} == {f"https://p.com/{i}": i in (0, 2) for i in range(4)}


def test_pure_filters_commute(spark):
    d = docs(spark, {"body": "a", "language": "es"}, {"body": "kw", "language": "es"}, {"body": "a", "language": "en"}, {"body": "a", "author_location_id": "_2"})
    f = [lambda x: filters.without_keywords(x, ["kw"]), lambda x: filters.in_language(x, "es"), lambda x: filters.in_place(x, "_1")]
    assert ids(f[0](f[1](f[2](d)))) == ids(f[2](f[1](f[0](d)))) == [0]


def test_cached_calls_send_each_request_once(spark):
    req = spark.createDataFrame([("a", "1"), ("b", "2"), ("b", "2")], "request string, prompt string")
    cache = spark.createDataFrame([("a", "old")], "request string, answer string")
    done, new = state.cached_call(req, cache, model_provider(lambda p: "new" + p, pause=0))
    assert sorted((r.request, r.answer) for r in done.collect()) == [("a", "old"), ("b", "new2"), ("b", "new2")] and [tuple(r) for r in new.collect()] == [("b", "new2")]


def test_tasks():
    assert tasks.search_terms(["#a", "two words", '"q"', "b", ""]) == {"hashtags": ["a"], "phrases": ["two words"], "keywords": ["q", "b"]}
    assert readers.scrape_request("google_news", ["k"], {"period": "w"})["timeframe"] == "7d"
    assert readers.scrape_request("twitter_keyword_search", ["k"], {"max_results": 5})["maxItems"] == 20
    assert readers.scrape_request("facebook_page_posts", ["u"], {"min_date": "2024-01-02 00:00:00"})["onlyPostsNewerThan"] == "2024-01-02"
    t = dict.fromkeys(tasks.COMMON) | {"actor_params": '{"max_results": 9}', "max_results": 1}
    assert tasks.arguments(t)["max_results"] == 9


def test_scraper_source(spark):
    readers.SCRAPERS["test"] = lambda r: [{"n": r["n"] * 10 + k} for k in range(2)]
    got = readers.scraped(spark, "test", [{"n": 1}, {"n": 2}])
    assert [json.loads(r.raw)["n"] for r in got.orderBy("_ord").collect()] == [10, 11, 20, 21]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, *OK), (2, None, *OK[1:])], "i int, " + BASE)
    n = compiler("2024-02-01 00:00:00").normalize(df, keep=("i",))
    body = json.loads(sinks.bodies(n).first().value)
    assert sinks.bodies(n).count() == 1 and body["type"] == "news" and body["message"]["title"] == "t" and body["message"]["lead"] is None
    sinks.run_file(n, f"file://{tmp_path}/run", by="i")
    with pytest.raises(Exception, match="exists"):
        sinks.run_file(n, f"file://{tmp_path}/run")
    sinks.rejects(n, f"file://{tmp_path}/rejects")
    assert spark.read.parquet(f"file://{tmp_path}/rejects").first().error == "Missing required field: body"
    log = tmp_path / "sent"
    log.mkdir()

    def connect():
        class Link:
            def send(self, b):
                if not list(log.iterdir()):
                    (log / "failed").write_text("")
                    raise ConnectionError
                (log / "ok").write_text(b)

            def close(self):
                pass

        return Link()

    sinks.publish(n, connect)
    assert json.loads((log / "ok").read_text())["type"] == "news"


def test_flatten(spark):
    d = spark.createDataFrame([(("x", ["p", "q"]), [(1,), (2,)])], "a struct<b:string,c:array<string>>, l array<struct<n:int>>")
    r = schema.flatten(d).first().asDict()
    assert r == {"a.b": "x", "a.c": "p | q", "l.1.n": 1, "l.2.n": 2}


def test_stream(spark, tmp_path):
    src = f"{tmp_path}/in"
    spark.createDataFrame([("u", "2024-01-01 00:00:00"), ("u", "2024-01-01 00:05:00"), ("v", "2024-01-01 00:00:00")], "url string, at string").selectExpr("url", "CAST(at AS timestamp) AS event_time", "'x' AS type").write.parquet(src)
    stream = spark.readStream.schema("url string, event_time timestamp, type string").parquet(src)
    got = []
    q = incremental.run_available(incremental.unseen(stream), lambda df, n: got.extend(r.url for r in df.collect()), f"{tmp_path}/ck")
    q.awaitTermination(60)
    assert sorted(got) == ["u", "v"]


def test_analysis_isolates_failed_sections(spark):
    from medialoom.operators import analysis

    d = docs(spark, {"url": "u", "body": "#a b", "post_type": "Reel", "n_comments": 3})
    q = spark.createDataFrame([("plot", "40. q"), ("character", "29. q")], "section string, questions string")

    def answer(prompt):
        if "character" in prompt:
            raise RuntimeError("down")
        return {"summary": "s"}

    r = analysis.records(d, analysis.answered(analysis.prompts(d, q), answer)).first()
    assert json.loads(r["plot"]) == {"summary": "s"} and r["characters"] == [] and r["character_count_label"] is None
    assert r["post_info"].meta.hashtag_count == 1 and r["comment_insights"].comment_count == 3


def test_pages_are_fetched_once_and_guarded(spark):
    from medialoom.sources.providers import page_provider

    def fetch(url):
        if url == "bad":
            raise OSError
        return ("x" * (11_000_000 if url == "big" else 3), url + "/final")

    got = {r.url: (r.final_url, r.html) for r in page_provider(fetch, pause=0)(spark.createDataFrame([("a",), ("a",), ("bad",), ("big",), (None,)], "url string")).collect()}
    assert got == {"a": ("a/final", "xxx"), "bad": (None, None), "big": ("big/final", None)}


def test_batches_over_uneven_partitions(spark):
    """Wide rows, several ranges, far more rows in some than in others: every row has its number."""
    n = 4000
    d = spark.range(n).selectExpr("CASE WHEN id % 10 = 0 THEN id * 1000 ELSE id END AS _ord", "repeat(cast(id AS string), 200) AS body", "id AS a", "id AS b")
    for c in (1, 7):
        out = filters.batches(d.repartition(c)).collect()
        order = sorted(out, key=lambda r: r._ord)
        assert [(r.batch_id, r.batch_index) for r in order] == [(k // 20, k % 20 + 1) for k in range(n)]
    assert filters.batches(d.limit(0)).count() == 0


def test_outcomes_tell_documents_of_one_url_apart(spark):
    d = spark.createDataFrame([(1, "u"), (2, "u"), (3, "v"), (4, None)], "_ord long, url string")
    got = {r.url: r.survived for r in state.filter_outcomes(d, d.where("_ord IN (1, 3)"), "t").collect()}
    assert got == {"u": False, "v": True}


def test_unsupported_flags_raise_before_anything_runs(spark):
    with pytest.raises(NotImplementedError, match="add_subtitles"):
        pipeline.process(spark.range(1), "facebook_page_posts", pipeline.Context({"add_subtitles": True}))


def test_state_is_left_for_the_caller(spark):
    """Places of authors and unknown sources, and one call for each request of two model passes."""
    from medialoom.sources.providers import Providers

    d = mappers.document(spark.createDataFrame([(1, "https://p/1", "in Lima"), (2, "https://p/2/", "nowhere")], "_ord long, u string, t string"), {"url": F.concat(F.lit("https://unknown.org/"), F.col("_ord")), "profile_url": F.col("u"), "body": F.col("t"), "type": F.lit("facebook")}, "_ord")
    users = spark.createDataFrame([("https://p/1", None, None)], "profile_url string, website_visits long, location_author_geoid string")
    place = "map<string,array<struct<geoid:string,formatted_name:string,precision_level:string>>>"
    geocode = lambda x: x.withColumn("groups", F.when(F.col("body").contains("Lima"), F.expr("map('2', array(struct('_001' AS geoid, 'Lima' AS formatted_name, '1' AS precision_level)))")).cast(place))
    calls = spark.sparkContext.accumulator(0)

    def answer(prompt):
        calls.add(1)
        return "[1, 2]"

    from medialoom.sources.providers import model_provider

    c = pipeline.Context({"llm_filter_condition": "x"}, Providers(model=model_provider(answer, pause=0), geocode=geocode), users=users)
    out = pipeline.process(d, "google_news", c)
    assert out.count() == out.count() == 2
    assert calls.value == 1  # both passes ask the same, and no plan asks twice
    saved = {r.profile_url: r.location_author_geoid for r in c.results["users"].collect()}
    assert saved["https://p/1"] == "_001" and c.results["answers"].count() == 1


def test_fetching_keeps_what_pages_lack(spark):
    from medialoom.operators import enrich

    news = mappers.document(spark.createDataFrame([(1, "a"), (2, "b")], "_ord long, u string"), {"url": F.col("u"), "title": F.lit("old"), "media_urls": F.array(F.lit("m"))}, "_ord")
    pages = spark.createDataFrame([("a", "c", "<x>"), ("b", None, None)], "url string, final_url string, html string")
    extract = lambda p: p.select("url", F.lit("new").alias("title"), F.array().cast("array<string>").alias("media_urls"))
    got = {r._ord: (r.url, r.title, r.media_urls) for r in enrich.fetched(news, pages, extract).collect()}
    assert got == {1: ("c", "new", ["m"]), 2: ("b", "old", ["m"])}


def test_shared_folder_of_a_local_session_without_one():
    from types import SimpleNamespace

    from medialoom.operators.stored import shared_dir

    def session(master, folder=None):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: folder), sparkContext=SimpleNamespace(master=master))

    own = shared_dir(session("local[2]"))
    assert own.startswith("file://") and shared_dir(session("local[2]")) == own
    assert shared_dir(session("yarn", "hdfs://x/y/")) == "hdfs://x/y"
    for master in ["yarn", "spark://h:7077", "local-cluster[2,1,1024]"]:
        with pytest.raises(ValueError):
            shared_dir(session(master))


def test_pages_that_share_a_url_attach_once(spark, tmp_path):
    from medialoom.plans import catalogue

    texts = [(k, f"text {k}", "en", "s", 6) for k in range(4)]
    spark.createDataFrame(texts, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, "http://a/1", "x"), (2, "http://a/1", "y"), (3, "http://a/3", "z"), (9, "http://a/9", "w")], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted(tuple(r) for r in catalogue.attach_article(spark, str(tmp_path)).collect())
    tag = "\n\n attached_url_text: "
    assert got == [(0, f"text 0{tag}x", "http://a/1"), (1, "text 1", None), (2, f"text 2{tag}y", "http://a/1"), (3, f"text 3{tag}z", "http://a/3")]
    got = sorted(tuple(r) for r in catalogue.expand_attached(spark, str(tmp_path)).collect())
    assert got == sorted([(k, 0, f"https://s.example.com/doc/{k}") for k in range(4)] + [(0, 1, "http://a/1"), (2, 1, "http://a/1"), (3, 1, "http://a/3")])
