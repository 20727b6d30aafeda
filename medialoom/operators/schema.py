"""A declared record schema compiled to column expressions.

One declaration gives the nested struct type, the coercions, the defaults and the error
columns.  Compilation has the passes structure, types, defaults and validation; each is
a projection, so Catalyst folds them into one whole-stage span without a shuffle.

A nested field is built from the flat columns of the same name; a field of an explicit
struct column wins over the flat one, and an explicit struct inside it replaces the
flat-built one as a whole.  Columns that the schema does not name are dropped.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from medialoom.functions import coerce
from medialoom.functions.urls import is_valid_url

#: kind -> Spark type of a leaf
LEAVES = {"text": "string", "int": "bigint", "float": "double", "bool": "boolean", "timestamp": "timestamp", "url": "string", "urls": "array<string>", "enum": "string", "list": "array<string>"}


@dataclass(frozen=True)
class Field:
    """``required`` may be a function of (level, context) giving a condition that holds
    when the field is fine; ``default`` a constant or a function of (root, context, level)."""

    kind: str
    required: bool | Callable = False
    default: object = None
    enum: tuple[str, ...] = ()
    of: str | None = None


@dataclass(frozen=True)
class Value:
    """A column with its type; ``None`` as type stands for an absent one."""

    col: Column
    type: T.DataType | None

    def field(self, name: str) -> Value:
        if isinstance(self.type, T.StructType) and name in self.type.names:
            return Value(self.col[name], self.type[name].dataType)
        return absent()


def absent() -> Value:
    return Value(F.lit(None).cast("string"), None)


def parsed(kind: str, v: Value) -> Column:
    """The type pass of one leaf."""
    if kind in ("urls", "list"):
        items = v.col.cast("array<string>") if isinstance(v.type, T.ArrayType) else coerce.to_list(v.col)
        return coerce.url_list(items) if kind == "urls" else F.coalesce(items, F.array().cast("array<string>"))
    if kind == "timestamp" and isinstance(v.type, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return v.col.cast("timestamp")
    if kind == "bool" and isinstance(v.type, T.BooleanType):
        return v.col
    if kind == "int" and isinstance(v.type, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        return v.col.cast("bigint")
    f = {"int": coerce.to_int, "float": coerce.to_float, "bool": coerce.to_bool, "timestamp": coerce.to_timestamp}
    return f.get(kind, coerce.to_text)(v.col)


class Compiler:
    def __init__(self, schemas: dict[str, dict[str, Field]], context: dict | None = None):
        self.schemas = schemas
        self.context = context or {}

    def struct_type(self, name: str) -> T.StructType:
        out = T.StructType()
        for f, spec in self.schemas[name].items():
            if spec.kind == "struct":
                out.add(f, self.struct_type(spec.of))
            elif spec.kind == "structs":
                out.add(f, T.ArrayType(self.struct_type(spec.of)))
            else:
                out.add(f, T._parse_datatype_string(LEAVES[spec.kind]))
        return out

    def level(self, name: str, root: dict[str, Value], given: Value | None, flat: bool, typed_root: dict[str, Column] | None = None) -> dict[str, Column]:
        """Typed and defaulted columns of one nesting level."""
        out: dict[str, Column] = {}
        for f, spec in self.schemas[name].items():
            own = given.field(f) if given is not None else None
            base = root.get(f) if flat else None
            if spec.kind == "struct":
                inner = None if own is None else own
                whole = self.struct(spec.of, root, inner, flat=False, typed_root=typed_root or out) if inner is not None and inner.type is not None else None
                built = self.struct(spec.of, root, base if base is not None and isinstance(base.type, T.StructType) else None, flat=True, typed_root=typed_root or out)
                out[f] = built if whole is None else F.when(inner.col.isNotNull(), whole).otherwise(built)
            elif spec.kind == "structs":
                v = own if own is not None and own.type is not None else base
                out[f] = self.structs(spec.of, v, typed_root or out)
            else:
                picked = [parsed(spec.kind, v) for v in (own, base) if v is not None and v.type is not None]
                if not picked:  # nothing to parse: keeps the plan of a wide schema small
                    picked = [(F.array() if spec.kind in ("urls", "list") else F.lit(None)).cast(LEAVES[spec.kind])]
                if spec.kind in ("urls", "list") and len(picked) > 1:
                    picked = [F.when(own.col.isNotNull(), picked[0]).otherwise(picked[1])]
                out[f] = picked[0] if len(picked) == 1 else F.coalesce(*picked)
        for f, spec in self.schemas[name].items():
            if spec.default is not None:
                d = spec.default(typed_root or out, self.context, out) if callable(spec.default) else F.lit(spec.default)
                out[f] = F.coalesce(out[f], d.cast(LEAVES[spec.kind]))
        return out

    def struct(self, name: str, root, given, flat: bool, typed_root) -> Column:
        cols = self.level(name, root, given, flat, typed_root)
        return F.struct(*[c.alias(f) for f, c in cols.items()])

    def structs(self, name: str, v: Value | None, typed_root) -> Column:
        if v is None or not isinstance(v.type, T.ArrayType):
            return F.array().cast(T.ArrayType(self.struct_type(name)))
        item = v.type.elementType
        made = F.transform(v.col, lambda x: self.struct(name, {}, Value(x, item), False, typed_root))
        return F.coalesce(made, F.array().cast(T.ArrayType(self.struct_type(name))))

    def errors(self, name: str, level: dict[str, Column]) -> list[Column]:
        """A message per field that is not in order, in schema order; null where it is."""
        out = []
        for f, spec in self.schemas[name].items():
            c = level[f]
            if spec.required:
                if callable(spec.required):
                    missing = ~spec.required(level, self.context)
                elif spec.kind in ("list", "urls", "structs"):
                    missing = F.size(c) == 0
                else:
                    missing = coerce.is_missing(c, LEAVES.get(spec.kind, ""))
                out.append(F.when(missing, F.lit(f"Missing required field: {f}")))
            if spec.kind == "url":
                out.append(F.when(c.isNotNull() & ~is_valid_url(c), F.lit(f"Invalid URL in field: {f}")))
            if spec.kind == "urls":
                out.append(F.when(~F.forall(c, is_valid_url), F.lit(f"Invalid URL in field: {f}")))
            if spec.kind == "enum":
                out.append(F.when(c.isNotNull() & ~c.isin(*spec.enum), F.lit(f"Invalid value in field: {f}")))
        return out

    def normalize(self, df: DataFrame, name: str = "News", keep: tuple[str, ...] = ()) -> DataFrame:
        """``keep`` columns, ``message``, ``errors`` (all) and ``error`` (the first or null)."""
        fields = [f for f in self.schemas[name]]
        root = {c.name: Value(df[c.name], c.dataType) for c in df.schema}
        level = self.level(name, root, None, True)
        tag = "_n_"
        typed = df.select(*[df[k] for k in keep], *[level[f].alias(tag + f) for f in fields])
        done = {f: F.col(tag + f) for f in fields}
        return typed.select(
            *keep,
            F.struct(*[c.alias(f) for f, c in done.items()]).alias("message"),
            F.array_compact(F.array(*self.errors(name, done))).alias("errors"),
        ).withColumn("error", F.get("errors", F.lit(0)))


def split_rejects(normalized: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows): nothing is lost and nothing half-valid goes on."""
    return normalized.where("error IS NULL"), normalized.where("error IS NOT NULL")


def envelope(normalized: DataFrame) -> DataFrame:
    return normalized.withColumn("envelope", F.struct(F.lit("news").alias("type"), F.col("message")))


def nested_author_location(df: DataFrame, prefix: str = "location_author_") -> DataFrame:
    """Flat prefixed columns as one struct; fields of an explicit struct win."""
    flat = {c[len(prefix) :]: df[c] for c in df.columns if c.startswith(prefix)}
    if "location_author" in df.columns:
        for f in df.schema["location_author"].dataType.names:
            own = F.col("location_author")[f]
            flat[f] = F.coalesce(own, flat[f]) if f in flat else own
    return df.withColumn("location_author", F.struct(*[c.alias(f) for f, c in flat.items()])) if flat else df


def flatten(df: DataFrame, separator: str = ".", join: str = " | ", items: dict[str, int] | None = None) -> DataFrame:
    """One scalar column per leaf: dotted paths, numbered list items, joined scalar lists.

    ``items`` fixes how many items of a list of structs become columns; lists that it
    does not name are measured with one aggregate.
    """
    items = dict(items or {})

    def lists(t: T.DataType, path: str, col: Column):
        if isinstance(t, T.StructType):
            for f in t:
                yield from lists(f.dataType, f"{path}{separator}{f.name}" if path else f.name, col[f.name] if path else F.col(f"`{f.name}`"))
        elif isinstance(t, T.ArrayType) and isinstance(t.elementType, T.StructType):
            yield path, col

    unknown = [(p, c) for p, c in lists(df.schema, "", None) if p not in items]
    if unknown:
        sizes = df.agg(*[F.max(F.size(c)).alias(str(k)) for k, (_, c) in enumerate(unknown)]).first()
        items |= {p: max(0, sizes[k] or 0) for k, (p, _) in enumerate(unknown)}

    def leaves(t: T.DataType, path: str, col: Column | None):
        if isinstance(t, T.StructType):
            for f in t:
                yield from leaves(f.dataType, f"{path}{separator}{f.name}" if path else f.name, F.col(f"`{f.name}`") if col is None else col[f.name])
        elif isinstance(t, T.ArrayType) and isinstance(t.elementType, T.StructType):
            for k in range(items.get(path, 0)):
                yield from leaves(t.elementType, f"{path}{separator}{k + 1}", F.get(col, F.lit(k)))
        elif isinstance(t, T.ArrayType):
            yield F.array_join(col.cast("array<string>"), join).alias(path)
        elif isinstance(t, (T.TimestampType,)):
            yield col.cast("timestamp_ntz").alias(path)
        else:
            yield col.alias(path)

    return df.select(*leaves(df.schema, "", None))
