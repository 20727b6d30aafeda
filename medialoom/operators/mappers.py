"""Raw payloads of the platforms as projections onto the intermediate schema.

A payload is a JSON text, read with a fixed schema per platform; keys that a platform
may lack are simply null.  Chains of alternatives skip null, '' and 0 where the rule is
"first that counts", and only null where it is "first that is there".
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from medialoom.functions.coerce import falsy, first_truthy
from medialoom.functions.text import ARTICLE_TAG, without_place_prefix
from medialoom.functions.urls import page_slug

_TEXT, _INT, _LIST = "string", "bigint", "array<string>"
#: The intermediate document: 34 fields, every one nullable.
FIELDS: dict[str, str] = {
    "timestamp": _TEXT, "source": _TEXT, "title": _TEXT, "body": _TEXT, "url": _TEXT, "media_urls": _LIST, "type": _TEXT, "author": _TEXT,
    "article_value": _INT, "website_visits": _INT, "likes": _INT, "shares": _INT, "views": _INT, "n_comments": _INT, "profile_url": _TEXT,
    "post_type": _TEXT, "author_full_name": _TEXT, "author_profile_bio": _TEXT, "author_location_text": _TEXT, "author_location_id": _TEXT,
    "location_author_formatted_name": _TEXT, "location_author_geoid": _TEXT, "location_author_coords": "struct<lat:double,lon:double>",
    "location_author_precision_level": _INT, "location_author_level_1": _TEXT, "location_author_level_1_id": _TEXT, "location_author_level_2": _TEXT,
    "location_author_level_2_id": _TEXT, "location_author_level_3": _TEXT, "location_author_level_3_id": _TEXT, "location_ids": _LIST, "language": _TEXT,
    "comments": "array<struct<comment_text:string,comment_author:string,comment_timestamp:string,comment_likes:bigint,comment_id:string>>", "video_filename": _TEXT,
}


def empty_document() -> dict[str, Column]:
    return {f: F.array().cast(t) if t.startswith("array") else F.lit(None).cast(t) for f, t in FIELDS.items()}


def document(df: DataFrame, filled: dict[str, Column], *keep: str) -> DataFrame:
    """The intermediate row of each input row: ``filled`` fields, the others empty."""
    cols = empty_document() | {f: F.coalesce(c.cast(FIELDS[f]), F.array().cast(FIELDS[f])) if FIELDS[f].startswith("array") else c.cast(FIELDS[f]) for f, c in filled.items()}
    return df.select(*keep, *[c.alias(f) for f, c in cols.items()])


def _head(c: Column, size: int = 80) -> Column:
    return F.nullif(F.substring(c, 1, size), F.lit(""))


def _epoch_iso(seconds: Column) -> Column:
    return F.date_format(F.to_utc_timestamp(F.timestamp_seconds(seconds), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def _listed(*cols: Column) -> Column:
    return F.filter(F.array(*cols), lambda x: x.isNotNull() & (x != ""))


def _present(array: Column) -> Column:
    return F.filter(F.coalesce(array, F.array().cast(_LIST)), lambda x: x.isNotNull() & (x != ""))


NEWS_RAW = "title string, url string, link string, source string, publishedAt string, timestamp string, image string, description string"


def news(r: Column) -> dict[str, Column]:
    return {
        "url": first_truthy(r["link"], r["url"]), "title": r["title"], "body": r["description"], "media_urls": _listed(r["image"]),
        "timestamp": first_truthy(r["publishedAt"], r["timestamp"]), "source": r["source"], "type": F.lit("news"),
    }


FACEBOOK_RAW = (
    "url string, text string, timestamp bigint, likes bigint, shares bigint, comments bigint, link string, facebookUrl string, pageName string, user struct<name:string>, "
    "media array<struct<__typename:string,thumbnail:string,photo_image:struct<uri:string>,videoDeliveryLegacyFields:struct<browser_native_sd_url:string,browser_native_hd_url:string>,ocrText:string>>"
)


def facebook_kind(media: Column, url: Column) -> Column:
    has = lambda kind: F.coalesce(F.exists(media, lambda m: m["__typename"] == kind), F.lit(False))
    return F.when(url.contains("/reel/"), "Reel").when(has("Video"), "Video").when(has("Photo"), "Photo").otherwise("Status")


def facebook_media(media: Column) -> Column:
    def one(m: Column) -> Column:
        video = m["videoDeliveryLegacyFields"]
        photo = F.coalesce(falsy(m["photo_image"]["uri"]), falsy(m["thumbnail"]))
        return F.when(m["__typename"] == "Photo", photo).when(m["__typename"] == "Video", F.coalesce(falsy(video["browser_native_hd_url"]), falsy(video["browser_native_sd_url"]), falsy(m["thumbnail"])))

    return _present(F.transform(media, one))


def facebook(r: Column) -> dict[str, Column]:
    page = F.coalesce(falsy(r["user"]["name"]), falsy(r["pageName"]), page_slug(r["url"]))
    built = F.concat(F.lit("https://www.facebook.com/"), page, F.lit("/"))
    return {
        "timestamp": _epoch_iso(r["timestamp"]), "source": F.coalesce(page, F.lit("Facebook")), "body": F.coalesce(r["text"], F.lit("")), "title": _head(r["text"]),
        "url": r["url"], "media_urls": facebook_media(r["media"]), "type": F.lit("facebook"), "author": page, "likes": r["likes"], "shares": r["shares"],
        "n_comments": r["comments"], "profile_url": F.coalesce(falsy(r["facebookUrl"]), built), "post_type": facebook_kind(r["media"], F.coalesce(r["url"], F.lit(""))),
    }


_SEEN = "array<struct<url:string,src:string,hd:string,sd:string,image_file_uri:string>>"
FACEBOOK_SEARCH_RAW = (
    "author struct<name:string,full_name:string,profile_url:string,url:string>, page_name string, post_url string, url string, permalink string, message_rich string, message string, "
    "text string, content string, timestamp string, created_time string, posted_at string, likes_count bigint, reactions_count bigint, reactions struct<like:bigint,total:bigint>, "
    "shares_count bigint, shares bigint, reshare_count bigint, comments_count bigint, comments bigint, image string, image_url string, video string, video_url string, thumbnail string, "
    f"video_thumbnail string, album_preview {_SEEN}, images {_SEEN}, video_files {_SEEN}, videos {_SEEN}, external_url string"
)


def facebook_search_kind(r: Column) -> Column:
    some = lambda c: F.coalesce(F.size(c) > 0, F.lit(False))
    is_set = lambda c: falsy(c).isNotNull()
    video = is_set(r["video"]) | is_set(r["video_url"]) | some(r["video_files"]) | some(r["videos"])
    photo = is_set(r["image"]) | is_set(r["image_url"]) | some(r["images"]) | some(r["album_preview"])
    return F.when(video, "Video").when(photo, "Photo").otherwise("Status")


def facebook_search_media(r: Column) -> Column:
    pick = lambda arr, *keys: _present(F.transform(arr, lambda x: F.coalesce(*[falsy(x[k]) for k in keys])))
    clips = F.when(F.size(r["video_files"]) > 0, r["video_files"]).otherwise(r["videos"])
    single = _listed(*[r[k] for k in ("image", "image_url", "video", "video_url", "thumbnail", "video_thumbnail")])
    return F.concat(single, pick(r["album_preview"], "image_file_uri", "url"), pick(r["images"], "url", "src"), pick(clips, "url", "hd", "sd"))


def facebook_search(r: Column) -> dict[str, Column]:
    a = r["author"]
    name = F.coalesce(falsy(a["name"]), falsy(a["full_name"]), falsy(r["page_name"]))
    said = first_truthy(r["timestamp"], r["created_time"], r["posted_at"])
    body = F.coalesce(falsy(r["message_rich"]), falsy(r["message"]), falsy(r["text"]), falsy(r["content"]), F.lit(""))
    return {
        "timestamp": F.when(said.rlike(r"^-?\d+(\.\d+)?$"), _epoch_iso(said.try_cast("double").try_cast("bigint"))).otherwise(said),
        "source": F.coalesce(name, F.lit("Facebook")), "body": body, "title": _head(body), "url": first_truthy(r["post_url"], r["url"], r["permalink"]),
        "media_urls": facebook_search_media(r), "type": F.lit("facebook"), "author": name, "author_full_name": name,
        "likes": F.coalesce(r["likes_count"], r["reactions_count"], r["reactions"]["like"], r["reactions"]["total"]),
        "shares": F.coalesce(r["shares_count"], r["shares"], r["reshare_count"]), "n_comments": F.coalesce(r["comments_count"], r["comments"]),
        "profile_url": F.coalesce(falsy(a["profile_url"]), falsy(a["url"]), F.concat(F.lit("https://www.facebook.com/"), name, F.lit("/"))),
        "post_type": facebook_search_kind(r),
    }


#: Child posts repeat the shape; the schema holds this many levels, and payloads that nest deeper are walked by ``deep_media``.
CHILD_LEVELS = 2


def _instagram_media_ddl(level: int) -> str:
    own = "displayUrl:string,videoUrl:string,images:array<string>"
    return own + (f",childPosts:array<struct<{_instagram_media_ddl(level - 1)}>>" if level else "")


INSTAGRAM_RAW = (
    "type string, caption string, url string, commentsCount bigint, likesCount bigint, videoPlayCount bigint, igPlayCount bigint, reshareCount bigint, timestamp string, "
    "ownerFullName string, ownerUsername string, locationName string, locationId string, " + _instagram_media_ddl(CHILD_LEVELS).replace(":", " ", 3).replace(",childPosts:", ", childPosts ", 1)
)


def instagram_media(r: Column, level: int = CHILD_LEVELS) -> Column:
    own = F.concat(_listed(r["displayUrl"], r["videoUrl"]), _present(r["images"]))
    if not level:
        return own
    below = F.flatten(F.transform(r["childPosts"], lambda c: instagram_media(c, level - 1)))
    return F.concat(own, F.coalesce(below, F.array().cast(_LIST)))


def _media_of(post: dict) -> list[str]:
    """All media of a post and its children, depth first."""
    out, todo = [], [post]
    while todo:
        p = todo.pop()
        if isinstance(p, dict):
            out += [u for u in (p.get("displayUrl"), p.get("videoUrl"), *(p.get("images") or [])) if u]
            todo += reversed(p.get("childPosts") or [])
    return out


@F.pandas_udf(T.ArrayType(T.StringType()))
def deep_media(raw: pd.Series) -> pd.Series:
    return raw.map(lambda x: _media_of(json.loads(x)), na_action="ignore")


def instagram_all_media(r: Column, raw: Column) -> Column:
    """Native up to ``CHILD_LEVELS``; a payload that names child posts more often is walked whole."""
    deeper = F.regexp_count(raw, F.lit('"childPosts"')) > CHILD_LEVELS
    return F.coalesce(deep_media(F.when(deeper, raw)), instagram_media(r))


def instagram(r: Column) -> dict[str, Column]:
    return {
        "timestamp": r["timestamp"], "source": F.lit("Instagram"), "body": r["caption"], "title": F.substring(F.coalesce(r["caption"], r["ownerFullName"], F.lit("")), 1, 80),
        "url": r["url"], "media_urls": instagram_all_media(r, F.col("_raw")), "type": F.lit("instagram"), "author": first_truthy(r["ownerFullName"], r["ownerUsername"]),
        "likes": r["likesCount"], "shares": r["reshareCount"], "views": first_truthy(r["videoPlayCount"], r["igPlayCount"], kind="bigint"), "n_comments": r["commentsCount"],
        "profile_url": F.concat(F.lit("https://www.instagram.com/"), falsy(r["ownerUsername"]), F.lit("/")), "post_type": r["type"],
        "author_location_text": r["locationName"], "author_location_id": r["locationId"],
    }


LINKEDIN_RAW = (
    "author struct<name:string,fullName:string,firstName:string,lastName:string,linkedinUrl:string,url:string,publicIdentifierUrl:string,headline:string,about:string,summary:string,"
    "location:string,locationName:string,followersCount:bigint,connectionsCount:bigint>, content string, text string, postText string, reactions struct<numLikes:bigint,total:bigint>, "
    "likesCount bigint, numLikes bigint, postedAt string, postedAtTimestamp string, createdAt string, url string, postUrl string, linkedinUrl string, repostsCount bigint, numShares bigint, "
    "commentsCount bigint, numComments bigint, viewsCount bigint, numViews bigint, media array<struct<type:string,mediaType:string,url:string,mediaUrl:string,imageUrl:string,videoUrl:string>>, "
    "imageUrl string, videoUrl string, documentUrl string, articleImageUrl string, articleUrl string"
)


def linkedin_kind(r: Column) -> Column:
    kinds = F.coalesce(F.transform(r["media"], lambda m: F.lower(F.coalesce(falsy(m["type"]), m["mediaType"], F.lit("")))), F.array().cast(_LIST))
    has = lambda k: F.array_contains(kinds, k)
    return (
        F.when(has("video"), "Video").when(has("image") | has("photo"), "Image").when(falsy(r["documentUrl"]).isNotNull() | has("document"), "Document")
        .when(falsy(r["articleUrl"]).isNotNull() | has("article"), "Article").otherwise("Text")
    )


def linkedin_media(r: Column) -> Column:
    listed = _present(F.transform(r["media"], lambda m: F.coalesce(falsy(m["url"]), falsy(m["mediaUrl"]), falsy(m["imageUrl"]), falsy(m["videoUrl"]))))
    more = F.array_distinct(_listed(r["imageUrl"], r["videoUrl"], r["documentUrl"], r["articleImageUrl"]))
    return F.concat(listed, F.filter(more, lambda x: ~F.array_contains(listed, x)))


def linkedin(r: Column) -> dict[str, Column]:
    a = r["author"]
    joined = F.concat(F.coalesce(a["firstName"], F.lit("")), F.lit(" "), F.coalesce(a["lastName"], F.lit("")))
    name = F.nullif(F.trim(F.coalesce(falsy(a["name"]), falsy(a["fullName"]), joined)), F.lit(""))
    body = F.coalesce(falsy(r["content"]), falsy(r["text"]), falsy(r["postText"]), F.lit(""))
    n = lambda *c: first_truthy(*c, kind="bigint")
    return {
        "timestamp": first_truthy(r["postedAt"], r["postedAtTimestamp"], r["createdAt"]), "source": F.coalesce(name, F.lit("LinkedIn")), "body": body, "title": _head(body),
        "url": first_truthy(r["url"], r["postUrl"], r["linkedinUrl"]), "media_urls": linkedin_media(r), "type": F.lit("linkedin"), "author": name, "author_full_name": name,
        "author_profile_bio": first_truthy(a["headline"], a["about"], a["summary"]), "author_location_text": first_truthy(a["location"], a["locationName"]),
        "likes": n(r["likesCount"], r["numLikes"], r["reactions"]["numLikes"], r["reactions"]["total"]), "shares": n(r["repostsCount"], r["numShares"]),
        "n_comments": n(r["commentsCount"], r["numComments"]), "views": n(r["viewsCount"], r["numViews"]), "website_visits": n(a["followersCount"], a["connectionsCount"]),
        "profile_url": first_truthy(a["linkedinUrl"], a["url"], a["publicIdentifierUrl"]), "post_type": linkedin_kind(r),
    }


_USER = "map<string,string>"  # its keys differ only by case, which a struct cannot tell apart
_SHOWN = "array<struct<media_url_https:string,mediaUrl:string,url:string>>"
X_RAW = (
    f"author {_USER}, user {_USER}, id string, id_str string, tweet_id string, url string, twitterUrl string, text string, full_text string, fullText string, createdAt string, created_at string, "
    "likeCount bigint, favorite_count bigint, likes bigint, retweetCount bigint, retweet_count bigint, retweets bigint, viewCount bigint, view_count bigint, views bigint, replyCount bigint, "
    "reply_count bigint, replies bigint, lang string, isReply boolean, in_reply_to_status_id string, isQuote boolean, quoted_status_id string, isRetweet boolean, retweeted_status string, "
    f"media {_SHOWN}, extendedEntities struct<media:{_SHOWN}>, entities struct<media:{_SHOWN}>"
)


def x_kind(r: Column) -> Column:
    said = lambda flag, ref: F.coalesce(r[flag], F.lit(False)) | falsy(r[ref]).isNotNull()
    return F.when(said("isReply", "in_reply_to_status_id"), "Reply").when(said("isQuote", "quoted_status_id"), "Quote").when(said("isRetweet", "retweeted_status"), "Retweet").otherwise("Tweet")


def x_media(r: Column) -> Column:
    pick = lambda arr, *keys: _present(F.transform(arr, lambda m: F.coalesce(*[falsy(m[k]) for k in keys])))
    shown = pick(F.when(F.size(r["media"]) > 0, r["media"]).otherwise(r["extendedEntities"]["media"]), "media_url_https", "mediaUrl", "url")
    more = F.array_distinct(pick(r["entities"]["media"], "media_url_https", "url"))
    return F.concat(shown, F.filter(more, lambda u: ~F.array_contains(shown, u)))


def x(r: Column) -> dict[str, Column]:
    who = F.coalesce(r["author"], r["user"])
    u = {k: F.try_element_at(who, F.lit(k)) for k in ("userName", "screen_name", "username", "url", "name", "description", "location")}
    followers = [F.try_element_at(who, F.lit(k)).try_cast("bigint") for k in ("followersCount", "followers_count")]
    screen = F.coalesce(falsy(u["userName"]), falsy(u["screen_name"]), falsy(u["username"]))
    number = F.coalesce(falsy(r["id"]), falsy(r["id_str"]), falsy(r["tweet_id"]))
    body = F.coalesce(falsy(r["text"]), falsy(r["full_text"]), falsy(r["fullText"]), F.lit(""))
    n = lambda *c: first_truthy(*c, kind="bigint")
    return {
        "timestamp": first_truthy(r["createdAt"], r["created_at"]), "source": F.coalesce(screen, F.lit("X")), "body": body, "title": _head(body),
        "url": F.coalesce(falsy(r["url"]), falsy(r["twitterUrl"]), F.concat(F.lit("https://x.com/"), screen, F.lit("/status/"), number)), "media_urls": x_media(r),
        "type": F.lit("x"), "author": F.coalesce(falsy(u["name"]), screen), "author_full_name": u["name"], "author_profile_bio": u["description"], "author_location_text": u["location"],
        "likes": n(r["likeCount"], r["favorite_count"], r["likes"]), "shares": n(r["retweetCount"], r["retweet_count"], r["retweets"]),
        "views": n(r["viewCount"], r["view_count"], r["views"]), "n_comments": n(r["replyCount"], r["reply_count"], r["replies"]),
        "website_visits": n(*followers), "profile_url": F.coalesce(falsy(u["url"]), F.concat(F.lit("https://x.com/"), screen)),
        "post_type": x_kind(r), "language": r["lang"],
    }


MAPPERS = {"news": (NEWS_RAW, news), "facebook": (FACEBOOK_RAW, facebook), "facebook_search": (FACEBOOK_SEARCH_RAW, facebook_search), "instagram": (INSTAGRAM_RAW, instagram), "linkedin": (LINKEDIN_RAW, linkedin), "x": (X_RAW, x)}


def map_raw(df: DataFrame, platform: str, raw: str = "raw", keep: tuple[str, ...] = ()) -> DataFrame:
    """Intermediate documents of JSON payloads, with their payload and order columns."""
    ddl, rule = MAPPERS[platform]
    carried = [c for c in ("_ord", *keep) if c in df.columns]
    parsed = df.select(*carried, F.col(raw).alias("_raw"), F.from_json(raw, T._parse_datatype_string(ddl)).alias("_r"))
    return document(parsed, rule(F.col("_r")), *carried, "_raw")


FACEBOOK_PAGE_RAW = (
    "title string, categories array<string>, likes bigint, followers bigint, info array<string>, rating string, email string, phone string, address string, website string, pageUrl string, "
    "facebookUrl string, pageName string, current_city string, hometown string, personalProfile struct<name:string>"
)


def facebook_page(r: Column) -> dict[str, Column]:
    """A page profile: followers, or likes where they are null; a zero counts."""
    return {
        "profile_url": F.rtrim(first_truthy(r["pageUrl"], r["facebookUrl"]), F.lit("/")),
        "website_visits": F.coalesce(r["followers"], r["likes"]),
        "author_full_name": first_truthy(r["title"], r["personalProfile"]["name"]),
        "author_profile_bio": F.nullif(F.array_join(r["info"], "\n"), F.lit("")),
        "author_location_text": F.coalesce(falsy(r["address"]), without_place_prefix(falsy(r["current_city"])), without_place_prefix(falsy(r["hometown"]))),
        **{k: r[k] for k in ("categories", "rating", "email", "phone", "website")},
    }


def comment(text: Column, author: Column, at: Column, likes: Column) -> Column:
    return F.struct(text.alias("comment_text"), author.alias("comment_author"), at.cast("string").alias("comment_timestamp"), likes.cast("bigint").alias("comment_likes"), F.lit(None).cast("string").alias("comment_id"))


def post_fallbacks(df: DataFrame) -> DataFrame:
    """What a post's message needs where the post lacks it: body, title and its likes again."""
    said = lambda c: F.coalesce(c, F.lit("None"))
    df = df.withColumn("body", F.coalesce(falsy(F.col("body")), F.concat(said(F.col("author")), F.lit(" - "), said(F.col("url")))))
    short = F.trim(F.substring(F.replace(F.replace("body", F.lit("\n"), F.lit(" ")), F.lit(ARTICLE_TAG), F.lit("")), 1, 80))
    return df.withColumns({"title": F.coalesce(falsy(F.col("title")), short), "fb_likes": F.col("likes")})
