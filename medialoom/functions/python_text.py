"""Text functions that column expressions cannot carry, as Arrow-batched UDFs."""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

#: Elements that go with their content, ones of them that have none, elements whose tags go, attributes that stay.
DROPPED = frozenset("applet aside embed footer head header iframe math nav noscript object script style svg".split())
VOID_DROPPED = frozenset({"embed"})
TAGS_ONLY = frozenset(
    "article button dd details div dl dt figcaption figure form input li main menu menuitem ol section select span summary table tbody td textarea tfoot th thead tr ul".split()
)
KEPT_ATTRIBUTES = frozenset("alt content datetime href name property src".split())
#: Targets that share a page, and sources that show no picture.
SHARING = ("api.whatsapp.com", "facebook.com/sharer", "twitter.com/share", "linkedin.com/sharearticle")
PLACEHOLDERS = ("placeholder/svg", "data:image/svg")
_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(?P<raw>script|style)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)|<(?P<close>/?)(?P<tag>[a-z][^\s/>]*)(?P<more>(?:"[^"]*"|'[^']*'|[^>"'])*)>|(?P<text>[^<]+|<)""", re.I | re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))?)?""")
_INLINE_DATA = re.compile(r"data:[^;]+;base64,[a-z0-9+/=]+", re.I)


def _tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, tag, text or attributes): kinds are open, close and text; comments, declarations, scripts and styles are none."""
    for m in _TOKEN.finditer(page):
        if m["text"] is not None:
            yield "text", "", entities.unescape(m["text"])
        elif m["tag"]:
            yield "close" if m["close"] else "open", m["tag"].lower(), m["more"]


def _outside_dropped(tokens: Iterator[tuple[str, str, str]]) -> Iterator[tuple[str, str, str]]:
    """The tokens that are in no dropped element; one that is never closed takes the rest of the page."""
    depth: list[str] = []
    for kind, tag, rest in tokens:
        if tag in DROPPED:
            if kind == "open" and tag not in VOID_DROPPED:
                depth.append(tag)
            elif kind == "close" and depth and depth[-1] == tag:
                depth.pop()
        elif not depth:
            yield kind, tag, rest


def _leads_nowhere(target: str) -> bool:
    low = target.lower()
    return target == "#" or target.startswith("javascript:") or low.startswith("mailto:") or any(x in low for x in SHARING)


def _shows_nothing(source: str) -> bool:
    return not source or any(x in source.lower() for x in PLACEHOLDERS) or bool(_INLINE_DATA.search(source))


def _attributes(more: str) -> list[tuple[str, str | None]]:
    """Names and values; null where an attribute has no value."""
    return [(name.lower(), entities.unescape(double or single or bare) if said else None) for name, said, double, single, bare in _ATTRIBUTE.findall(more)]


def _written(tag: str, attributes: list[tuple[str, str | None]]) -> str:
    """A start tag with the attributes that say something."""
    stay = [(k, v) for k, v in attributes if k in KEPT_ATTRIBUTES and not (v and (_INLINE_DATA.search(v) or (k == "href" and _leads_nowhere(v))))]
    return "<" + "".join([tag, *(f" {k}" if v is None else f' {k}="{v}"' for k, v in stay)]) + ">"


#: Elements that go, by their attributes.
_UNWANTED = {"a": lambda given: _leads_nowhere(given.get("href") or ""), "img": lambda given: _shows_nothing(given.get("src") or "")}


def _without_empty_pairs(text: str) -> str:
    while True:
        shorter = re.sub(r"<(\w+)[^>]*>\s*</\1>", "", text)
        if shorter == text:
            return text
        text = shorter


def reduce_html(html: str | None, keep_orphans: bool = True) -> str | None:
    """HTML without what is not content.  ``keep_orphans``: keep the end tag of a removed link."""
    if html is None:
        return None
    out, open_links = [], 0
    for kind, tag, rest in _outside_dropped(_tokens(html)):
        if kind == "text":
            out.append(rest)
        elif tag in TAGS_ONLY:
            continue
        elif kind == "open":
            given = _attributes(rest)
            if tag in _UNWANTED and _UNWANTED[tag](dict(given)):
                open_links += tag == "a"
            else:
                out.append(_written(tag, given))
        elif tag == "a" and open_links and not keep_orphans:
            open_links -= 1
        else:
            out.append(f"</{tag}>")
    text = re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+", " ", "".join(out)))
    return re.sub(r"\n{3,}", "\n\n", _without_empty_pairs(text)).strip()


@F.pandas_udf(T.StringType())
def clean_html(html: pd.Series) -> pd.Series:
    return html.map(reduce_html, na_action="ignore")


def windows_around(body: str, keywords: list[str], size: int = 250, most: int = 4) -> str:
    """Up to ``most`` stretches around keyword hits, or the head of the text without a hit.

    Hits are taken keyword by keyword; one inside a stretch that is taken adds nothing.
    """
    low = body.lower()
    hits = [m.span() for word in keywords if word for m in re.finditer(re.escape(word.lower()), low)]
    chosen: list[slice] = []
    for start, end in hits:
        if len(chosen) < most and not any(c.start <= start <= c.stop for c in chosen):
            chosen.append(slice(max(0, start - size // 2), min(len(body), end + size // 2)))
    said = " ... ".join(body[c] for c in chosen) if chosen else body[:size]
    return " ".join(said.split())


def snippet(body: Column, keywords: list[str], size: int = 250) -> Column:
    """Snippet for a relevance prompt; without keywords it stays in the JVM."""
    from medialoom.functions.text import snippet_head

    if not keywords:
        return snippet_head(body, size)

    @F.pandas_udf(T.StringType())
    def around(s: pd.Series) -> pd.Series:
        return s.map(lambda x: windows_around(x or "", keywords, size))

    return around(body)


_STOPS = {
    "de": frozenset("der die das und ist nicht ein eine mit von zu".split()),
    "en": frozenset("the and of to is in that it for with".split()),
    "es": frozenset("el la los las de que y en un una por con".split()),
    "fr": frozenset("le la les des et est un une que dans pour".split()),
}


def guess_language(text: str | None) -> str | None:
    """Stop-word vote: a deterministic stand-in for a detection service."""
    words = (text or "").lower().split()
    votes = {code: sum(w in stops for w in words) for code, stops in _STOPS.items()}
    best = max(votes.values(), default=0)
    return min(c for c, v in votes.items() if v == best) if best else None


@F.pandas_udf(T.StringType())
def detect_language(text: pd.Series) -> pd.Series:
    return text.map(guess_language)
