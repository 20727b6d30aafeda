"""Line-first quality rules, in DataFrame functions only.

Each line with a word is judged by these rules, and fails by any of them: punctuation
(it does not end as a sentence does, so menus and lists of links fail item by item),
navigation (a third of its words are separators), symbols, shouting, and boilerplate
(short lines with a phrase of a notice; the phrases are a parameter, by language).
Failing lines are removed; a document is then rejected when it failed the base rules or
kept too little of its text.

Everything is computed inside the row with higher-order functions: there is no shuffle,
so neither a hot source nor a huge document moves any data.  ``_let`` binds an array to
a lambda variable, so that it is computed once however often it is used.

Defined cases: null text reads as a text without words, which fails the base rules;
rows repeat as given; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from medialoom.llm.common import WS_CHARS, WS_CLASS, table

MIN_WORDS, MAX_REPEAT_PERCENT, MIN_KEPT_PERCENT = 50, 50, 50
SYMBOLS = "#*$%&|<>"
NAV_MARKS = "|»›•·"
END_MARKS, CLOSING = ".!?;:…。！？", "\"'»”’)]"
SHORT = 200
#: Fixed phrases of notices that are not text, by language.
BOILERPLATE = {
    "en": (
        "accept cookies", "all rights reserved", "click here", "cookie policy", "enable javascript",
        "log in", "privacy policy", "read more", "share on", "sign in", "sign up", "subscribe",
        "terms of service", "terms of use",
    ),
    "de": ("alle rechte vorbehalten", "cookies akzeptieren", "datenschutzerklärung", "jetzt anmelden", "mehr lesen", "nutzungsbedingungen", "weiterlesen"),
    "es": ("aceptar cookies", "aviso legal", "haz clic aquí", "iniciar sesión", "leer más", "política de privacidad", "suscríbete", "todos los derechos reservados"),
    "fr": ("accepter les cookies", "conditions d'utilisation", "lire la suite", "mentions légales", "politique de confidentialité", "se connecter", "tous droits réservés"),
}
PHRASES = tuple(x for some in BOILERPLATE.values() for x in some)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, WS_CLASS + "+"), lambda w: w != "")


def repeat_words(words: Column) -> Column:
    """Words in 3-word windows found twice or more in the text, the first included."""

    def covered(at: Column) -> Column:  # ascending starts of repeated windows, each covering three words
        gaps = F.transform(F.slice(at, 2, F.greatest(F.size(at) - 1, F.lit(0))), lambda x, i: F.least(x - at[i], F.lit(3)))
        return F.aggregate(gaps, F.lit(3), lambda a, x: a + x)

    def by_sort(win: Column) -> Column:
        tagged = F.sort_array(F.transform(win, lambda x, i: F.struct(x.alias("w"), i.alias("i"))))
        at = _let(
            tagged,
            lambda s: F.array_sort(
                F.transform(
                    F.filter(
                        F.transform(s, lambda x, i: F.struct(x["i"].alias("i"), ((F.get(s, i - 1)["w"] == x["w"]) | (F.get(s, i + 1)["w"] == x["w"])).alias("r"))),
                        lambda x: x["r"],
                    ),
                    lambda x: x["i"],
                )
            ),
        )
        return _let(at, lambda a: F.when(F.size(a) == 0, F.lit(0)).otherwise(covered(a)))

    def counted(w: Column) -> Column:
        win = F.transform(F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))), lambda x, i: F.concat_ws(" ", x, w[i + 1], w[i + 2]))
        return _let(win, lambda v: F.when(F.size(F.array_distinct(v)) == F.size(v), F.lit(0)).otherwise(by_sort(v)))

    return _let(words, counted).cast("long")


def _without(text: Column, marks: str) -> Column:
    for m in marks:
        text = F.replace(text, F.lit(m), F.lit(""))
    return text


def _count(text: Column, marks: str) -> Column:
    return F.length(text) - F.length(_without(text, marks))


def _pattern(phrases: tuple[str, ...]) -> str:
    return r"(^|[^\p{L}\p{N}])(" + "|".join(phrases) + r")($|[^\p{L}\p{N}])"


_ENDED = f"[{END_MARKS}][{re.escape(CLOSING)}]*$"


def line_fails(line: Column, phrases: tuple[str, ...] = PHRASES) -> dict[str, Column]:
    """Why a trimmed line is no text: rule name -> true where it fails.

    Cheap tests come first, so that words are only counted and patterns only searched
    where they can decide.
    """
    size = F.length(line)
    tokens, marks = F.size(words_of(line)), _count(line, NAV_MARKS)
    return {
        "punctuation": ~F.substring(line, -4, 4).rlike(_ENDED),
        "navigation": (marks > 0) & (tokens > 3) & (3 * marks >= tokens),
        "symbols": 12 * _count(line, SYMBOLS) > size,
        "shouting": (F.upper(line) == line) & (F.lower(line) != line) & (tokens > 3),
        "boilerplate": (size <= SHORT) & F.lower(line).rlike(_pattern(phrases)),
    }


def judged(docs: DataFrame, *carried: str, phrases: tuple[str, ...] = PHRASES) -> DataFrame:
    """doc_id, the base figures, the line figures and the verdict, one row per row.

    Columns named in ``carried`` travel along unchanged.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("t"), *carried)
    words = words_of(F.col("t"))
    lines = F.filter(F.split(F.col("t"), "\n"), lambda x: F.btrim(x, F.lit(WS_CHARS)) != "")

    def passes(x: Column) -> Column:
        return _let(F.btrim(x, F.lit(WS_CHARS)), lambda y: ~reduce(or_, line_fails(y, phrases).values()))

    def chars_of(a: Column) -> Column:  # of lines: characters that belong to words
        return F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + F.length(_without(x, WS_CHARS)))

    def line_figures(ls: Column) -> Column:
        return _let(
            F.filter(ls, passes),
            lambda g: F.struct(
                (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
                F.size(ls).cast("long").alias("n_lines"),
                (F.size(ls) - F.size(g)).cast("long").alias("n_lines_removed"),
                F.array_join(g, "\n").alias("clean_text"),
                chars_of(g).alias("kept_chars"),
            ),
        )

    d = d.select(
        "doc_id",
        *carried,
        _let(words, lambda w: F.struct(F.size(w).cast("long").alias("n_words"), F.aggregate(w, F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("word_chars"), repeat_words(w).alias("n_repeat_words"))).alias("w"),
        _count(F.col("t"), SYMBOLS).cast("long").alias("n_symbols"),
        _let(lines, line_figures).alias("l"),
    )
    n, r = F.col("w.n_words"), F.col("w.n_repeat_words")
    failed = (n < MIN_WORDS) | (100 * r > MAX_REPEAT_PERCENT * n)
    left = F.col("l.kept_chars")
    return d.select(
        "doc_id", *carried, n.alias("n_words"), "w.word_chars", "n_symbols", "l.n_dup_lines", r.alias("n_repeat_words"),
        failed.alias("base_failed"), (~failed & (100 * left >= MIN_KEPT_PERCENT * F.col("w.word_chars"))).alias("kept"),
        "l.n_lines", "l.n_lines_removed", "l.kept_chars", "l.clean_text",
    )


def clean(docs: DataFrame) -> DataFrame:
    """The kept rows without their failing lines: the same columns, ``n_chars`` renewed.

    The old row travels along as a struct, so repeated and null ids need no join.
    """
    row = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["doc_id"].alias("doc_id"), docs["text"].alias("text"))
    new = {"text": F.col("clean_text"), "n_chars": F.length("clean_text").cast("long")}
    return judged(row, "row").where("kept").select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def op1(spark, sf_dir) -> DataFrame:
    return judged(table(spark, sf_dir, "documents")).drop("clean_text")


def _sql_count(column: str, marks: str) -> str:
    return f"(length({column}) - length(regexp_replace({column}, '[{marks}]', '', 'g')))"


_BARE = r"regexp_replace({0}, '[\x20\x09-\x0D]+', '', 'g')"
_TOKENS = r"len(list_filter(regexp_split_to_array(b, '[\x20\x09-\x0D]+'), lambda x: x <> ''))"
_QUOTED = [x.replace("'", "''") for x in (f"[{END_MARKS}][{re.escape(CLOSING)}]*$", _pattern(PHRASES))]
_FAILS = " OR ".join(
    [
        f"(NOT regexp_matches(right(b, 4), '{_QUOTED[0]}'))",
        f"({_TOKENS} > 3 AND 3 * {_sql_count('b', NAV_MARKS)} >= {_TOKENS})",
        f"(12 * {_sql_count('b', SYMBOLS)} > length(b))",
        f"({_TOKENS} > 3 AND upper(b) = b AND lower(b) <> b)",
        f"(length(b) <= {SHORT} AND regexp_matches(lower(b), '{_QUOTED[1]}'))",
    ]
)
ORACLE_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM d),
g AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w),
c AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(ws[i:i + 2], ' ')) AS n FROM g),
r AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 3)) AS p FROM c WHERE n > 1) GROUP BY doc_id),
l AS (SELECT doc_id, line, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS b FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)),
f AS (SELECT doc_id, line, {_FAILS} AS fails, length({_BARE.format('b')}) AS chars FROM l WHERE b <> ''),
a AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines, count(*) FILTER (WHERE fails) AS n_lines_removed, coalesce(sum(chars) FILTER (WHERE NOT fails), 0) AS kept_chars FROM f GROUP BY doc_id),
x AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length({_BARE.format('t')}) AS BIGINT) AS word_chars, CAST({_sql_count('t', SYMBOLS)} AS BIGINT) AS n_symbols,
  coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines, coalesce(n_lines_removed, 0) AS n_lines_removed, CAST(coalesce(kept_chars, 0) AS BIGINT) AS kept_chars
  FROM w LEFT JOIN a USING (doc_id) LEFT JOIN r USING (doc_id))
SELECT *, (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) AS base_failed,
  NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) AND 100 * kept_chars >= {MIN_KEPT_PERCENT} * word_chars AS kept
FROM x
"""
