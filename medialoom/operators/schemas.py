"""The declared record schemas: the message, its parts, and the source record."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from medialoom.functions import text
from medialoom.functions.urls import is_valid_url
from medialoom.operators.schema import Compiler, Field

#: Platforms a message may name.
NEWS_TYPES = ("news", "x", "facebook", "impreso", "instagram", "linkedin", "radio", "tv")


def _now(root, context, level) -> Column:
    """The run's time: injectable, so that results are reproducible."""
    at = context.get("now")
    return F.current_timestamp() if at is None else F.lit(at).cast("timestamp")


def _url_fine(level, context) -> Column:
    return (F.lower(F.coalesce(level["type"], F.lit(""))) == "impreso") | is_valid_url(level["url"])


def _texts(names: str) -> dict[str, Field]:
    return {n: Field("text") for n in names.split()}


def _levels(n: int, prefix: str = "") -> dict[str, Field]:
    return {f"{prefix}level_{k}{s}": Field("text") for k in range(1, n + 1) for s in ("", "_id")}


_REACH = ("offline", "facebook", "instagram", "x", "tiktok", "online", "youtube")

SCHEMAS: dict[str, dict[str, Field]] = {
    "News": {
        "author": Field("list"),
        "body": Field("text", required=True),
        **_texts("body_links footnote highlights lead location media_pictures column_name column_author media_videos"),
        "fb_likes": Field("int"),
        "source": Field("text", required=True),
        **_texts("source_category source_comments source_related source_social_networks_shares source_tags"),
        "timestamp": Field("timestamp", required=True),
        "timestamp_added": Field("timestamp", default=_now),
        "title": Field("text", required=True),
        "type": Field("enum", default="news", enum=NEWS_TYPES),
        "url": Field("url", required=_url_fine),
        "media_urls": Field("urls"),
        "comments": Field("structs", of="Comment"),
        "location_ids": Field("list"),
        "location_author": Field("struct", of="LocationAuthor"),
        "source_extra": Field("struct", of="SourceExtra"),
        "supplier": Field("struct", of="Supplier"),
    },
    "Comment": {
        **_texts("comment_text comment_author"),
        "comment_timestamp": Field("timestamp"),
        "comment_likes": Field("int"),
        "comment_id": Field("text", default=lambda root, context, level: text.comment_id(root["url"], level["comment_author"], level["comment_timestamp"])),
    },
    "SourceExtra": {"stats": Field("struct", of="SourceExtraStats"), "__FOUND_SOURCE__": Field("bool", default=False)},
    "SourceExtraStats": {
        "at_date": Field("timestamp", default=_now),
        **{n: Field("int") for n in "article_value website_visits likes shares views n_comments".split()},
        **_texts("profile_url post_type author_full_name author_profile_bio video_filename"),
    },
    "LocationAuthor": {**_texts("formatted_name geoid"), "coords": Field("struct", of="LocationCoords"), "precision_level": Field("int"), **_levels(3)},
    "LocationCoords": {"lat": Field("float"), "lon": Field("float")},
    "Supplier": {"name": Field("text"), "creador": Field("int"), "opinion": Field("text")},
    "Source": {
        "minutes_to_sleep": Field("int", default=90),
        "domain": Field("text", required=True),
        "crawler_type": Field("text", default="not_local"),
        "sitio": Field("text", default=lambda root, context, level: text.site_name(level["domain"])),
        "depth": Field("int", default=2),
        "urls": Field("urls", required=True),
        "fecha_maxima": Field("int", default=14),
        "type": Field("text", default="site"),
        "crawl_strategy": Field("text", default="classic"),
        "date_added": Field("timestamp", default=_now),
        "stats": Field("struct", of="SourceStats"),
    },
    "SourceStats": {
        "stats_date_updated": Field("timestamp", default=_now),
        "source": Field("text"),
        "reuters_trust_pct": Field("float"),
        "tier": Field("int", default=lambda root, context, level: text.tier(level["website_visits"])),
        "extracted_news": Field("int"),
        "article_value": Field("int", default=lambda root, context, level: text.article_value(level["website_visits"])),
        "website_visits": Field("int"),
        **{f"reach_{n}": Field("int") for n in _REACH},
        "fraccion": Field("text"),
        **_texts("location_author_formatted_name location_author_geoid"),
        "location_author_coords": Field("struct", of="LocationCoords"),
        "location_author_precision_level": Field("int"),
        **_levels(7, "location_author_"),
    },
}


def compiler(now: str | None = None) -> Compiler:
    return Compiler(SCHEMAS, {"now": now})
