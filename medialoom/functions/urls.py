"""URL functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Hosts whose links are social, and hosts that are never articles.
SOCIAL_HOSTS = ("facebook.com", "instagram.com", "linkedin.com", "threads.net", "tiktok.com", "twitter.com", "x.com", "youtube.com")
NEVER_ARTICLES = ("facebook.com", "fb.com", "goo.gl", "instagram.com", "linkedin.com", "pinterest.com", "reddit.com", "t.me", "threads.net", "tiktok.com", "twitter.com", "wa.me", "whatsapp.com", "x.com", "youtu.be", "youtube.com")
NEVER_UNDER = {"google.com": ("/maps",)}
#: Second labels under which country domains register, and countries that have them.
SECOND_LABELS = "ac co com edu gob gov net org".split()
COUNTRIES = "ar au bd bo br cl cn co cr cu do ec eg es gt hk hn id il in jp ke kr mx my ng ni nz pa pe ph pk pr py sa sg sv th tr tw ua uk uy ve vn za".split()
MORE_SUFFIXES = ("blog.br", "go.jp", "go.kr", "govt.nz", "gub.uy", "jus.br", "ltd.uk", "me.uk", "ne.jp", "nom.co", "nom.es", "or.jp", "or.kr")
#: Public suffixes of more than one label that the default rule knows; ``suffixes_from`` reads a full list.
TWO_LABEL_SUFFIXES = tuple(sorted({f"{a}.{b}" for a in SECOND_LABELS for b in COUNTRIES} - {"ac.co", "co.co", "com.uk"}) ) + MORE_SUFFIXES


def host(url: Column) -> Column:
    """Lower-case host, without user, port and a final dot; null where there is none."""
    rest = F.regexp_replace(F.trim(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://|^//", "")
    name = F.regexp_replace(F.regexp_extract(rest, r"^([^/?#]*)", 1), r"^.*@|:\d*$", "")
    return F.nullif(F.lower(F.rtrim(name, F.lit("."))), F.lit(""))


def path(url: Column) -> Column:
    rest = F.regexp_replace(F.trim(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*", "")
    return F.regexp_extract(rest, r"^([^?#]*)", 1)


def suffixes_from(path: str) -> tuple[str, ...]:
    """Public suffixes of two labels from a public suffix list file, for ``registrable_domain``."""
    with open(path, encoding="utf-8") as f:
        lines = [x.split("//")[0].strip().lower() for x in f]
    return tuple(sorted(x for x in lines if x.count(".") == 1 and not x.startswith(("*", "!"))))


def registrable_domain(url: Column, suffixes: tuple[str, ...] = TWO_LABEL_SUFFIXES) -> Column:
    """The label before the public suffix, with it; null for addresses and bare suffixes."""
    h = host(url)
    labels = F.split(h, r"\.")
    n = F.size(labels)
    last = lambda k: F.array_join(F.slice(labels, n - k + 1, k), ".")
    named = h.isNotNull() & ~h.rlike(r"^\d+(\.\d+){3}$|^\[|[^a-z0-9.\-\x{80}-\x{10ffff}]") & (n >= 2)
    two = last(2).isin(*suffixes)
    return F.when(named & ~two, last(2)).when(named & two & (n >= 3), last(3))


def without_last_label(domain: Column) -> Column:
    return F.regexp_replace(domain, r"\.[^.]*$", "")


def is_valid_url(url: Column) -> Column:
    """A web address: http, https or no scheme; labels of a host; port of up to five digits; a path without spaces.

    The parts are cut out and judged one by one.  A query right after the host is no path.
    """
    u = F.regexp_replace(url, r"(?U)^\s+|\s+$", "")
    bare = F.when(u.startswith("https://"), F.substr(u, F.lit(9))).when(u.startswith("http://"), F.substr(u, F.lit(8))).otherwise(u)
    authority = F.substring_index(bare, "/", 1)
    rest = F.substr(bare, F.length(authority) + 1)
    host_port = F.split(authority, ":", -1)
    labels = F.split(F.get(host_port, F.lit(0)), r"\.", -1)
    port, top = F.get(host_port, F.lit(1)), F.element_at(labels, -1)
    inner = F.slice(labels, 1, F.size(labels) - 1)
    letters = lambda x: F.translate(F.lower(x), "abcdefghijklmnopqrstuvwxyz", "")
    sound = lambda x: x.between("!", "~") & F.length(x).between(1, 63) & (F.translate(letters(x), "0123456789-", "") == "") & ~x.startswith("-") & ~x.endswith("-")
    good_host = (F.size(labels) >= 2) & F.forall(inner, sound) & (letters(top) == "") & (F.length(top) >= 2) & (F.octet_length(top) == F.length(top))
    good_port = (F.size(host_port) == 1) | ((F.size(host_port) == 2) & F.length(port).between(1, 5) & (F.translate(port, "0123456789", "") == ""))
    return F.coalesce(good_host & good_port & (F.regexp_replace(rest, r"\s", "") == rest), F.lit(False))


def is_never_article(url: Column) -> Column:
    d, p = registrable_domain(url), path(url)
    hit = d.isin(*NEVER_ARTICLES)
    for name, starts in NEVER_UNDER.items():
        for s in starts:
            hit = hit | ((d == name) & p.startswith(s))
    return F.coalesce(hit, F.lit(False))


def is_social(domain: Column, exact: bool = False) -> Column:
    """Whether a domain is social; by default a host inside the name is enough."""
    if exact:
        return domain.isin(*SOCIAL_HOSTS)
    hit = F.lit(False)
    for s in SOCIAL_HOSTS:
        hit = hit | domain.contains(s)
    return hit


def first_external_url(text: Column, own_url: Column, exact: bool = False) -> Column:
    """The first link that is neither social nor on the document's own domain."""
    own = registrable_domain(own_url)
    links = F.transform(F.regexp_extract_all(text, F.lit(r"https?://\S+"), F.lit(0)), lambda u: F.rtrim(u, F.lit(".,;:!?)\"'")))
    found = F.transform(links, lambda u: F.struct(u.alias("u"), registrable_domain(u).alias("d")))
    kept = F.filter(found, lambda x: x["d"].isNotNull() & ~is_social(x["d"], exact) & F.coalesce(x["d"] != own, F.lit(True)))
    return F.get(kept, F.lit(0))["u"]


def url_hash(url: Column) -> Column:
    return F.substring(F.md5(url), 1, 12)


def media_path(folder: str, url: Column, extension: Column) -> Column:
    return F.concat(F.lit(folder.rstrip("/") + "/"), url_hash(url), F.lit("."), extension)


def page_slug(url: Column) -> Column:
    """First path segment of a page's URL, unless it names a kind of post."""
    first = F.get(F.filter(F.split(path(url), "/"), lambda x: x != ""), F.lit(0))
    return F.when(~first.isin("reel", "watch", "photo", "story"), first)


def without_final_slash(url: Column) -> Column:
    return F.rtrim(url, F.lit("/"))
