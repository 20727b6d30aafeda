"""Text functions as column expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

#: Language names by their ISO 639-1 code.
LANGUAGE_NAMES = {
    "arabic": "ar", "catalan": "ca", "chinese": "zh", "czech": "cs", "danish": "da", "deutsch": "de", "dutch": "nl", "english": "en", "español": "es",
    "finnish": "fi", "français": "fr", "french": "fr", "german": "de", "greek": "el", "hebrew": "he", "hindi": "hi", "hungarian": "hu", "indonesian": "id",
    "italian": "it", "italiano": "it", "japanese": "ja", "korean": "ko", "malay": "ms", "norwegian": "no", "polish": "pl", "portuguese": "pt",
    "português": "pt", "romanian": "ro", "russian": "ru", "spanish": "es", "swedish": "sv", "thai": "th", "turkish": "tr", "ukrainian": "uk", "vietnamese": "vi",
}
#: Days of a period, and upper bounds of visits with what they are worth.
PERIOD_DAYS = {"d": 1, "w": 7, "m": 30}
PERIOD_WORDS = {"d": "1d", "w": "7d", "m": "30d"}
POSTED_LIMITS = {"d": "24h", "w": "week", "m": "month"}
TIER_BELOW = ((15_000, 3), (30_000, 2))
VALUE_BELOW = ((1_000, 5_000), (10_000, 10_000), (20_000, 15_000), (50_000, 20_000), (100_000, 25_000), (250_000, 30_000), (1_000_000, 40_000))
POST_FORMATS = {"Image": "Static Image", "Reel": "Single Video", "Sidecar": "Image Carousel", "Story": "Single Video", "Video": "Single Video"}
ARTICLE_TAG = "attached_url_text: "
#: Fixed value: the ranges that count as emoji.
_EMOJI = r"[\x{1F300}-\x{1FAFF}\x{2600}-\x{27BF}\x{1F000}-\x{1F1FF}]"


def lookup(values: dict[str, object], key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for x in chain.from_iterable(values.items())]), key)


def normalize_language(raw: Column) -> Column:
    """Two-letter code of a code, a name, a locale or a region:locale pair; else null."""
    s = F.lower(F.regexp_replace(raw, r"(?U)^\s+|\s+$", ""))
    # a name wins over the pair rule at each colon; what follows the last colon is left
    tail = F.trim(F.regexp_replace(s, r"^.*:", ""))

    def plain(x: Column) -> Column:
        code = F.when((F.length(x) == 2) & x.rlike(r"^\p{L}+$"), x)
        locale = F.nullif(F.regexp_extract(x, r"^(\p{L}{2})-", 1), F.lit(""))
        under = F.when(~x.rlike(r"^\p{L}{2}-"), F.nullif(F.regexp_extract(x, r"^(\p{L}{2})_", 1), F.lit("")))
        return F.coalesce(code, lookup(LANGUAGE_NAMES, x), locale, under)

    return F.when(s.contains(":"), plain(tail)).otherwise(plain(s))


def collapse(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def snippet_head(body: Column, size: int = 250) -> Column:
    return collapse(F.substring(F.coalesce(body, F.lit("")), 1, size))


def prompt_line(index: Column, name: Column, location: Column, bio: Column, snippet: Column) -> Column:
    """``[i] user_name: .., user_location: .., user_bio: .. | snippet`` without absent parts."""
    part = lambda label, c: F.concat(F.lit(label), F.nullif(c, F.lit("")))
    meta = F.concat_ws(", ", part("user_name: ", name), part("user_location: ", location), part("user_bio: ", collapse(bio)))
    return F.concat(F.lit("["), index.cast("string"), F.lit("] "), F.when(meta != "", F.concat(meta, F.lit(" | "))).otherwise(""), snippet)


def reply_indices(reply: Column) -> Column:
    """The list of numbers in a model's reply; null where it is no list."""
    bare = F.trim(F.replace(F.replace(reply, F.lit("`"), F.lit("")), F.lit("json"), F.lit("")))
    return F.from_json(F.when(bare.rlike(r"^\s*\["), bare), "array<int>")


def word_count(c: Column) -> Column:
    return F.size(F.filter(F.split(c, r"(?U)\s+"), lambda w: w != ""))


def hashtag_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(r"(?U)(?<!\w)#\w+"))


def mention_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(r"(?U)(?<!\w)@\w[\w.]*"))


def emoji_percent(c: Column) -> Column:
    n = word_count(c)
    return F.when(n == 0, F.lit(0.0)).otherwise(F.round(F.regexp_count(c, F.lit(_EMOJI)) * 100.0 / n, 2))


def post_format(kind: Column) -> Column:
    return lookup(POST_FORMATS, kind)


def tier(visits: Column) -> Column:
    out = F.when(visits.isNull(), F.lit(None).cast("int"))
    for below, value in TIER_BELOW:
        out = out.when(visits < below, F.lit(value))
    return out.otherwise(F.lit(1))


def article_value(visits: Column) -> Column:
    out = F.when(visits.isNull(), F.lit(None).cast("int"))
    for below, value in VALUE_BELOW:
        out = out.when(visits < below, F.lit(value))
    return out.otherwise(F.lit(50_000))


def site_name(domain: Column) -> Column:
    """What stands before the first dot."""
    return F.regexp_replace(F.nullif(F.trim(domain), F.lit("")), r"\..*$", "")


def comment_id(post_url: Column, author: Column, at: Column) -> Column:
    digest = F.substring(F.md5(F.coalesce(author, F.lit(""))), 1, 8)
    return F.concat_ws("-", F.coalesce(post_url, F.lit("")), digest, F.coalesce(F.date_format(at, "yyyyMMddHHmm"), F.lit("")))


def without_place_prefix(c: Column) -> Column:
    return F.regexp_replace(c, r"^(Lives in |From )", "")


def cache_key(task: Column, url: Column) -> Column:
    return F.concat(F.lit("filtered:"), task, F.lit(":"), url)


def with_image_text(body: Column, texts: Column, generic_prefix: str) -> Column:
    """Body with the numbered texts found in its images; generic descriptions left out."""
    kept = F.filter(texts, lambda x: x.isNotNull() & (x != "") & ~x.startswith(generic_prefix))
    more = F.transform(kept, lambda x, i: F.concat(F.lit("\n\n image_text_"), (i + 1).cast("string"), F.lit(": "), x))
    return F.concat(F.coalesce(body, F.lit("")), F.coalesce(F.array_join(more, ""), F.lit("")))


def with_article(body: Column, article: Column) -> Column:
    return F.when(F.coalesce(article, F.lit("")) != "", F.concat(F.coalesce(body, F.lit("")), F.lit("\n\n " + ARTICLE_TAG), article)).otherwise(body)
