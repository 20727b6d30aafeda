"""Primitive coercions as column expressions.

Each takes the raw value as text (or a typed column) and never raises: what cannot be
read is null.  White space is Unicode white space.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: A number as the int and float rules read it: no digit separators, no type suffixes.
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_SPECIAL = r"(?i)^[+-]?(inf|infinity|nan)$"
#: Timestamp shapes that are accepted, month first where day and month are ambiguous.
_FORMATS = ("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]XXX", "yyyy-MM-dd HH:mm:ss[.SSSSSS][.SSS]XXX", "yyyyMMdd", "MM/dd/yyyy HH:mm:ss", "MM/dd/yyyy", "dd/MM/yyyy")


def stripped(c: Column) -> Column:
    return F.regexp_replace(c.cast("string"), r"(?U)^\s+|\s+$", "")


def to_text(c: Column) -> Column:
    """Trimmed text; null if nothing is left."""
    return F.nullif(stripped(c), F.lit(""))


def to_float(c: Column) -> Column:
    s = stripped(c)
    special = F.lower(F.regexp_replace(s, r"^\+", ""))
    named = F.when(special.startswith("-"), F.lit("-Infinity")).when(special == "nan", F.lit("NaN")).otherwise(F.lit("Infinity"))
    return F.when(s.rlike(_NUMBER), s.try_cast("double")).when(s.rlike(_SPECIAL), F.when(special.isin("-nan", "nan"), F.lit("NaN")).otherwise(named).cast("double"))


def to_int(c: Column) -> Column:
    """Truncates toward zero; infinities and NaN are null, as are values beyond 64 bits."""
    s = stripped(c)
    return F.when(s.rlike(_NUMBER), s.try_cast("double").try_cast("bigint")).when(F.lower(s).isin("true", "false"), (F.lower(s) == "true").cast("bigint"))


def to_bool(c: Column) -> Column:
    s = F.lower(stripped(c))
    return F.when(s.isin("true", "1", "yes", "y"), F.lit(True)).when(s.isin("false", "0", "no", "n"), F.lit(False))


def to_timestamp(c: Column) -> Column:
    """An instant from ISO text, a few common shapes, X's own shape, or epoch s / ms."""
    s = stripped(c)
    epoch = s.rlike(r"^\d{10}(\.\d+)?$|^\d{13}$")
    seconds = F.when(F.length(s) == 13, s.try_cast("double") / 1000).otherwise(s.try_cast("double"))
    x_shape = F.try_to_timestamp(F.substring(s, 5, 40), F.lit("MMM dd HH:mm:ss Z yyyy"))
    iso = F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}"), s.try_cast("timestamp"))
    shaped = [F.try_to_timestamp(s, F.lit(f)) for f in _FORMATS[2:]]
    return F.when(epoch, F.timestamp_seconds(seconds)).otherwise(F.coalesce(iso, F.when(s.rlike(r"^[A-Z][a-z]{2} [A-Z][a-z]{2} "), x_shape), *shaped))


def wall_clock(c: Column) -> Column:
    """The date and time as written, its offset dropped, not shifted."""
    s = stripped(c)
    return F.coalesce(F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}"), s.try_cast("timestamp_ntz")), F.try_to_timestamp(s, F.lit("yyyyMMdd")).cast("timestamp_ntz"))


def to_list(c: Column) -> Column:
    """A text list: null gives an empty one, a JSON list its items, other text itself."""
    s = c.cast("string")
    parsed = F.from_json(F.when(s.rlike(r"^\s*\["), s), "array<string>")
    return F.when(s.isNull(), F.array().cast("array<string>")).otherwise(F.coalesce(parsed, F.array(s)))


def url_list(items: Column) -> Column:
    """Trimmed, without blanks, distinct in first-seen order; null gives an empty list."""
    kept = F.filter(F.transform(items, to_text), lambda x: x.isNotNull())
    return F.coalesce(F.array_distinct(kept), F.array().cast("array<string>"))


def is_missing(c: Column, kind: str) -> Column:
    return (c.isNull() | F.isnan(c)) if kind in ("double", "float") else c.isNull()


def falsy(c: Column, kind: str = "string") -> Column:
    """Null where the value counts as absent in a chain of alternatives: null, '' or 0."""
    return F.nullif(c, F.lit("") if kind == "string" else F.lit(0).cast(kind))


def first_truthy(*cols: Column, kind: str = "string") -> Column:
    """The first present value; when all are absent, the last one as it is."""
    return F.coalesce(*[falsy(c, kind) for c in cols[:-1]], cols[-1])


def first_not_null(*cols: Column) -> Column:
    return F.coalesce(*cols)
