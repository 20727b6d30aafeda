"""Functions on small cases, gaps of the catalogue's tables included."""

from __future__ import annotations

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from medialoom.functions import coerce, text, urls
from medialoom.functions.python_text import guess_language, reduce_html, windows_around


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def column_of(spark, values, f, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in df.select("i", f(F.col("v")).alias("x")).orderBy("i").collect()]


def test_int(spark):
    given_ = ["12.9", "-12.9", "1e3", " 7\n", "", None, "1,000", "inf", "nan", "1d", "1f", "true", "x", "+5", ".5"]
    assert column_of(spark, given_, coerce.to_int) == [12, -12, 1000, 7, None, None, None, None, None, None, None, 1, None, 5, 0]


def test_bool_and_text(spark):
    assert column_of(spark, ["Yes", "0", "1.0", " TRUE ", "n", None], coerce.to_bool) == [True, False, None, True, False, None]
    assert column_of(spark, [" a ", " ", "", None, "nan"], coerce.to_text) == ["a", None, None, None, "nan"]


def test_timestamps(spark):
    said = ["2026-03-28T14:30:00Z", "Sat Mar 28 14:30:00 +0000 2026", "1774708200", "1774708200000", "20260328", "03/28/2026", "28/03/2026", "soon", None]
    got = column_of(spark, said, lambda c: F.date_format(coerce.to_timestamp(c), "yyyy-MM-dd HH:mm"))
    assert got == ["2026-03-28 14:30"] * 4 + ["2026-03-28 00:00"] * 3 + [None, None]
    assert column_of(spark, ["2026-03-28T14:30:00-06:00"], lambda c: coerce.wall_clock(c).cast("string")) == ["2026-03-28 14:30:00"]


def test_lists(spark):
    assert column_of(spark, [None, "a", '["a","b"]'], coerce.to_list) == [[], ["a"], ["a", "b"]]
    assert column_of(spark, [[" a", "b", "a", "", None], None], coerce.url_list, "array<string>") == [["a", "b"], []]


@pytest.mark.parametrize(
    ("url", "ok"),
    [
        ("https://a.com", True), ("a.com/x", True), ("http://www.a.co.uk:80/x?y", True), ("https://a.com?x=1", False), ("1.2.3.4", False), ("http://u@a.com", False),
        ("a_b.com", False), ("nope", False), ("https://á.com", False), ("a.c1", False), ("a.com/x y", False), ("", False),
    ],
)
def test_valid_url(spark, url, ok):
    assert value(spark, urls.is_valid_url(F.lit(url))) is ok


def test_domains(spark):
    said = ["https://www.reforma.com/x", "http://a.b.co.uk", "https://blog.gob.mx", "co.uk", "http://1.2.3.4/x", "x", None, "https://User@A.Com:8/p", "https://a.com./"]
    assert column_of(spark, said, urls.registrable_domain) == ["reforma.com", "b.co.uk", "blog.gob.mx", None, None, None, None, "a.com", "a.com"]
    assert column_of(spark, ["https://www.facebook.com/page/posts/1", "https://www.facebook.com/reel/1", "https://www.facebook.com/"], urls.page_slug) == ["page", None, None]


def test_external_url(spark):
    f = lambda body, own=None: value(spark, urls.first_external_url(F.lit(body), F.lit(own).cast("string")))
    assert f("see https://a.com/x.") == "https://a.com/x"
    assert f("https://x.com/1 then https://b.org/y),") == "https://b.org/y"
    assert f("https://a.com/1 https://b.org/2", "https://www.a.com/own") == "https://b.org/2"
    assert f("https://netflix.com/1") is None  # a social host inside the name is enough
    assert value(spark, urls.first_external_url(F.lit("https://netflix.com/1"), F.lit(None).cast("string"), exact=True)) == "https://netflix.com/1"
    assert f("none") is None and f(None) is None


def test_snippets(spark):
    assert windows_around("a" * 300 + " key " + "b" * 300, ["KEY"], 20) == "a" * 9 + " key " + "b" * 9
    assert windows_around("no hit here", ["zzz"], 5) == "no hi"
    assert windows_around("", ["x"]) == ""
    assert windows_around("k " * 1000, ["k"], 10).count(" ... ") == 3
    assert value(spark, text.snippet_head(F.lit("a \n b"), 250)) == "a b"


@settings(max_examples=60, deadline=None)
@given(st.text("ab k.", max_size=120), st.lists(st.sampled_from(["a", "k", "ab"]), max_size=3))
def test_snippet_bounds(body, keywords):
    assert len(windows_around(body, keywords, 20)) <= 4 * (20 + 2) + 3 * 5


def test_prompt_and_replies(spark):
    n = F.lit(None).cast("string")
    assert value(spark, text.prompt_line(F.lit(1), n, n, n, F.lit("s"))) == "[1] s"
    assert value(spark, text.prompt_line(F.lit(2), F.lit("N"), F.lit(""), F.lit("a\n b"), F.lit("s"))) == "[2] user_name: N, user_bio: a b | s"
    assert column_of(spark, ["```json\n[1, 3]\n```", "[]", "no", None], text.reply_indices) == [[1, 3], [], None, None]


def test_metrics(spark):
    assert column_of(spark, ["#a b#c @x.y #", "", None], text.hashtag_count) == [1, 0, None]
    assert column_of(spark, ["@a.b c@d @"], text.mention_count) == [1]
    assert column_of(spark, ["a 😀 b", "", "😀😀"], text.emoji_percent) == [33.33, 0.0, 200.0]
    assert column_of(spark, ["Reel", "Story", "Text", None], text.post_format) == ["Single Video", "Single Video", None, None]


def test_body_parts(spark):
    got = value(spark, text.with_image_text(F.lit("b"), F.array(F.lit("May be an image"), F.lit("t1"), F.lit("t2")), "May be"))
    assert got == "b\n\n image_text_1: t1\n\n image_text_2: t2"
    assert column_of(spark, ["Lives in A", "From B", "C From D"], text.without_place_prefix) == ["A", "B", "C From D"]


def test_reduce_html():
    assert reduce_html("<head><meta name='x'></head><div><p class='c'>a  b</p><span></span></div>") == "<p>a b</p>"
    assert reduce_html("a<embed src='x'>b") == "ab"
    assert reduce_html("<script>x<p>y</p></script><p></p>z") == "z"
    assert reduce_html('<img src="data:image/png;base64,AAAA"><img src="/a.png" width=3>') == '<img src="/a.png">'
    assert reduce_html('<a href="mailto:x">m</a>') == "m</a>" and reduce_html('<a href="mailto:x">m</a>', keep_orphans=False) == "m"
    assert reduce_html('<a href="/x" onclick="y">l</a><!-- c -->') == '<a href="/x">l</a>'
    assert reduce_html(None) is None and reduce_html("") == ""


def test_guess_language():
    assert guess_language("der Hund und die Katze") == "de" and guess_language("zzz") is None and guess_language(None) is None
