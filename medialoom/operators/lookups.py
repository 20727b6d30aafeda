"""Keyed lookups as joins: sources, author profiles, comments, articles, media files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from medialoom.functions import urls
from medialoom.functions.coerce import falsy
from medialoom.functions.text import without_place_prefix  # noqa: F401  (used by callers that map profiles)
from medialoom.functions.text import with_article

STATS = ("website_visits", "author_full_name", "author_profile_bio", "author_location_text")
PLACE = ("author_location_text", "author_location_id", "location_author_formatted_name", "location_author_geoid", "location_author_coords", "location_author_precision_level") + tuple(
    f"location_author_level_{k}{s}" for k in (1, 2, 3) for s in ("", "_id")
)


def first_per(df: DataFrame, key: list[str], order: list[Column | str], keep_null: str | None = None) -> DataFrame:
    """One row per key, the first in order; rows whose ``keep_null`` column is null all stay.

    Null keys never enter the window, so they do not meet in one task.
    """
    w = W.partitionBy(*key).orderBy(*order)
    if keep_null is None:
        return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
    nulls = df.where(F.col(keep_null).isNull())
    return df.where(F.col(keep_null).isNotNull()).withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n").unionByName(nulls)


def first_value_per(df: DataFrame, key: str, order: str, *values: str) -> DataFrame:
    """Like ``first_per`` for a few columns, but combined before the shuffle: safe for hot keys."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min_by(F.struct(*values), order).alias("v")).select(key, "v.*")


def last_value_per(df: DataFrame, key: str, order: str, *values: str) -> DataFrame:
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*values), order).alias("v")).select(key, "v.*")


def dedupe_first_wins(df: DataFrame, order: str = "_ord", keys: tuple[str, ...] = ("post_url", "url")) -> DataFrame:
    """The first row of each key; combined before the shuffle, so that a hot key is one row a task."""
    key = F.coalesce(*[falsy(F.col(k)) for k in keys if k in df.columns])
    keyed = df.withColumn("_key", key)
    firsts = keyed.where("_key IS NOT NULL").groupBy("_key").agg(F.min_by(F.struct(*df.columns), order).alias("v")).select("v.*")
    return firsts.unionByName(keyed.where("_key IS NULL").drop("_key"))


def source_places(docs: DataFrame, sources: DataFrame, domain: Column | None = None, only: Column | None = None) -> DataFrame:
    """News take their source's place, nulls included, where the source is known.

    ``only``: which rows are news; others keep what they have.
    """
    d = urls.registrable_domain(F.col("url")) if domain is None else domain
    fields = [c for c in sources.columns if c != "domain"]
    s = sources.select(F.col("domain").alias("_domain"), *[F.col(c).alias("_s_" + c) for c in fields], F.lit(True).alias("_known"))
    joined = docs.withColumn("_d", d if only is None else F.when(only, d)).join(s, F.col("_d") == F.col("_domain"), "left")
    fill = {c: F.when(F.col("_known"), F.col("_s_" + c)) if c in PLACE else F.coalesce(F.col(c), F.col("_s_" + c)) if c in docs.columns else F.col("_s_" + c) for c in fields}
    if only is not None:
        fill = {c: F.when(F.coalesce(only, F.lit(False)), v).otherwise(F.col(c)) if c in docs.columns else v for c, v in fill.items()}
    return joined.withColumns(fill).drop("_domain", "_known", "_d", *["_s_" + c for c in fields])


def source_country(geoid: Column) -> Column:
    return F.substring(geoid, 1, 4)


def source_name(docs: DataFrame, sources: DataFrame, domain: str = "domain") -> DataFrame:
    """The source's own name, else its domain without the last label."""
    s = sources.where(falsy(F.col("sitio")).isNotNull()).select(F.col("domain").alias("_domain"), F.col("sitio").alias("_sitio"))
    joined = docs.join(s, F.col(domain) == F.col("_domain"), "left")
    return joined.withColumn("source_name", F.coalesce("_sitio", urls.without_last_label(F.col(domain)))).drop("_domain", "_sitio")


def unknown_sources(seen: DataFrame, known: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """Domains that are not known, one row each: those recorded before come first."""
    rows = seen.select("domain", "url", "source", F.lit(1).alias("_age"))
    if before is not None:
        rows = before.select("domain", "url", "source", F.lit(0).alias("_age")).unionByName(rows)
    rows = rows.where(falsy(F.col("domain")).isNotNull())
    new = rows.join(known.select("domain").distinct(), "domain", "left_anti")
    return new.groupBy("domain").agg(F.min(F.struct("_age", "url", "source")).alias("v")).select("domain", "v.url", "v.source")


def fill_from_users(docs: DataFrame, users: DataFrame, fields: tuple[str, ...] = STATS, needs: str = "website_visits", only: Column | None = None) -> DataFrame:
    """Fills nulls from the author's stored profile, found by the profile URL without its final slash.

    ``only``: which rows are filled.
    """
    u = users.where(F.col(needs).isNotNull()).select(urls.without_final_slash(F.col("profile_url")).alias("_u"), *[F.col(f).alias("_u_" + f) for f in fields if f in users.columns])
    key = urls.without_final_slash(F.col("profile_url"))
    joined = docs.withColumn("_key", key if only is None else F.when(only, key)).join(u, F.col("_key") == F.col("_u"), "left")
    fill = {f: F.coalesce(F.col(f), F.col("_u_" + f)) for f in fields if f in users.columns}
    return joined.withColumns(fill).drop("_u", "_key", *["_u_" + f for f in fill])


def stale_profiles(docs: DataFrame, users: DataFrame, now: Column, days: int = 90) -> DataFrame:
    """Distinct profile URLs that need a new scrape."""
    from medialoom.operators.filters import is_stale

    keys = docs.where(falsy(F.col("profile_url")).isNotNull()).select(urls.without_final_slash(F.col("profile_url")).alias("profile_url")).distinct()
    u = users.select(urls.without_final_slash(F.col("profile_url")).alias("profile_url"), "date_stats_updated")
    return keys.join(u, "profile_url", "left").where(is_stale(F.col("date_stats_updated").cast("timestamp"), now, days)).select("profile_url")


def profiles_by_name(posts: DataFrame, profiles: DataFrame, names: list[str], post_key: str, fields: tuple[str, ...]) -> DataFrame:
    """A profile is known under several names, as they are written; of profiles with one name the first counts."""
    keyed = profiles.select("_ord", F.explode(F.array_compact(F.array(*[falsy(F.col(n)) for n in names]))).alias("_name"), *fields)
    one = first_value_per(keyed, "_name", "_ord", *fields).select("_name", *[F.col(f).alias("_p_" + f) for f in fields])
    joined = posts.join(one, F.col(post_key) == F.col("_name"), "left")
    return joined.withColumns({f: F.coalesce(F.col(f), F.col("_p_" + f)) if f in posts.columns else F.col("_p_" + f) for f in fields}).drop("_name", *["_p_" + f for f in fields])


def last_profiles(posts: DataFrame, profiles: DataFrame, key: str, fields: tuple[str, ...]) -> DataFrame:
    """By user name or profile URL; of several profiles with one key the last counts."""
    one = last_value_per(profiles, key, "_ord", *fields).select(F.col(key).alias("_k"), *[F.col(f).alias("_p_" + f) for f in fields])
    joined = posts.join(one, F.col(key) == F.col("_k"), "left")
    return joined.withColumns({f: F.coalesce(F.col(f), F.col("_p_" + f)) if f in posts.columns else F.col("_p_" + f) for f in fields}).drop("_k", *["_p_" + f for f in fields])


def grouped_comments(comments: DataFrame, url: str = "post_url", order: str = "_ord", most: int | None = None) -> DataFrame:
    """(url, comments): each post's comments in order of arrival.

    ``most`` is applied before grouping, so a post with very many comments is cut down
    where they are, not after they have been gathered.
    """
    c = comments
    if most is not None:
        c = c.withColumn("_n", F.row_number().over(W.partitionBy(url).orderBy(order))).where(F.col("_n") <= most)
    items = F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col("comment").alias("c"))))
    return c.groupBy(url).agg(F.transform(items, lambda x: x["c"]).alias("comments"))


def last_comments(items: DataFrame, url: str = "post_url") -> DataFrame:
    """Where items bring their comments along, the last item of a URL counts."""
    return last_value_per(items, url, "_ord", "comments")


def attach_comments(posts: DataFrame, comments: DataFrame, url: str = "post_url", keep_unmatched: bool = False) -> DataFrame:
    """Posts without comments get an empty list, or keep what they have."""
    c = comments.select(F.col(url).alias("_c_url"), F.col("comments").alias("_c"))
    joined = posts.join(c, F.col("url") == F.col("_c_url"), "left")
    other = F.col("comments") if keep_unmatched and "comments" in posts.columns else F.array().cast(c.schema["_c"].dataType)
    return joined.withColumn("comments", F.coalesce("_c", other)).drop("_c_url", "_c")


def attach_articles(posts: DataFrame, articles: DataFrame, link: Column, key: str = "url") -> DataFrame:
    """Adds the linked article's text and fills null places from it.

    ``articles``: url, body, timestamp and place fields, one row per ``key``, which
    ``link`` names.  Where several pages share a URL, the key is their id.
    """
    place = [f for f in PLACE if f in articles.columns]
    a = articles.select(F.col(key).alias("_a_url"), F.struct(*articles.columns).alias("attached_news"))
    joined = posts.withColumn("_link", link).join(a, F.col("_link") == F.col("_a_url"), "left")
    got = F.col("attached_news")
    if "timestamp" in articles.columns:
        # withField on a null struct stays null
        joined = joined.withColumn("attached_news", got.withField("timestamp", F.coalesce(got["timestamp"], F.col("timestamp"))))
    fill = {f: F.coalesce(F.col(f), got[f]) for f in place if f in posts.columns}
    return joined.withColumns({"body": with_article(F.col("body"), got["body"]), **fill}).drop("_link", "_a_url")


def article_link(raw_link: Column, body: Column, own_url: Column) -> Column:
    return F.coalesce(falsy(raw_link), urls.first_external_url(body, own_url))


def attach_media_files(posts: DataFrame, files: DataFrame) -> DataFrame:
    f = files.select(urls.without_final_slash(F.col("url")).alias("_f_url"), F.col("filename").alias("_f"))
    joined = posts.join(f, urls.without_final_slash(F.col("url")) == F.col("_f_url"), "left")
    return joined.withColumn("video_filename", F.coalesce("_f", F.col("video_filename"))).drop("_f_url", "_f")


def with_attached(docs: DataFrame, columns: list[str]) -> DataFrame:
    """Each document, followed by its attached article if it has one."""
    own = docs.select("_ord", F.lit(0).alias("_part"), *columns)
    news = docs.where(F.col("attached_news").isNotNull())
    have = docs.schema["attached_news"].dataType.names
    art = news.select("_ord", F.lit(1).alias("_part"), *[F.col("attached_news")[c].alias(c) if c in have else F.lit(None).cast(docs.schema[c].dataType).alias(c) for c in columns])
    return own.unionByName(art)


def geocoded(docs: DataFrame) -> DataFrame:
    """Applies a ``groups`` map (context group -> places): ids of all, author's place from group 2."""
    all_ids = F.transform(F.flatten(F.map_values("groups")), lambda x: x["geoid"])
    place = F.get(F.try_element_at("groups", F.lit("2")), F.lit(0))
    names = docs.schema["groups"].dataType.valueType.elementType.names
    fill = {f"location_author_{n}": F.coalesce(F.col(f"location_author_{n}"), place[n].cast(docs.schema[f"location_author_{n}"].dataType)) for n in names if f"location_author_{n}" in docs.columns}
    return docs.withColumns({"location_ids": F.coalesce(all_ids, F.col("location_ids")), **fill}).drop("groups")


def author_places(docs: DataFrame, users: DataFrame, order: str = "_ord") -> DataFrame:
    """(profile_url, place fields that users have) of authors whose place was found, the first of each."""
    fields = [f for f in PLACE if f in users.columns and f in docs.columns]
    rows = docs.where(F.col("location_author_geoid").isNotNull()).withColumn("profile_url", urls.without_final_slash(falsy(F.col("profile_url"))))
    return first_value_per(rows, "profile_url", order, *fields)


def section_questions(sections: DataFrame, questions: DataFrame) -> DataFrame:
    """(section, questions): the texts of a section's known questions, in its own order."""
    s = sections.select("section", F.posexplode("numbers").alias("at", "no"))
    items = F.sort_array(F.collect_list(F.struct("at", "no", "question")))
    return s.join(questions.where(F.col("no").try_cast("int").isNotNull()).select(F.col("no").cast("int").alias("no"), "question"), "no").groupBy("section").agg(
        F.array_join(F.transform(items, lambda x: F.concat(x["no"].cast("string"), F.lit(". "), x["question"])), "\n").alias("questions")
    )
