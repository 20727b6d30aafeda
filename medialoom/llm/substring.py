"""Removal of word windows that repeat anywhere in the corpus.

A window is ``width`` consecutive words of one document.  Every word covered by a
window whose words also start earlier (smaller doc_id, or the same document and a
smaller start) is removed; windows are judged on the input.

1. Sketch: each task hashes all windows of its documents and emits, per block of
   ``BLOCK`` windows, sparse shards of a two-row count-min sketch with counters that
   saturate at two.  The shards are merged in a streaming pass; the result says for
   each counter whether its (over)estimate is two or more.  The sketch has three
   counters a window, up to ``MAX_COUNTERS`` a row: at most 128 MiB, broadcast.
2. Firsts: windows estimated as repeated - a superset of the repeated ones - are grouped
   by a 128-bit digest, made of two hashes of each word.  Each block sends one entry per
   digest, its earliest place; the entries are merged to the earliest place in the corpus.
3. Removal: a document's windows that are estimated as repeated and are not the first
   of their digest are exactly those to remove (a wrongly estimated window is its own
   first).  Firsts are joined to their documents by id; the text streams through Python
   in bounded batches and no document's neighbours are gathered with it.

Defined cases: null text reads as no words; a null doc_id sorts after all others; rows
with equal doc_id count as the same document, so equal windows at equal starts in them
are not earlier than one another; texts shorter than a window are left alone; an empty
table gives an empty result; other columns are carried along only by ``remove``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F, types as T

from medialoom.llm.common import batch_of, drop_path, materialise, release, released, table, texts_of

WIDTH = 20
BLOCK = 1 << 21
SHARD_BITS = 20
MAX_COUNTERS = 1 << 29
PART_BYTES = 3_000_000
SHARD_WINDOWS = 3_000_000
NO_ID, NULL_BIT = np.iinfo(np.int64).max, 1 << 31
NONE = np.empty(0, dtype="<u4")
_MULT = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


def window_hashes(words: np.ndarray, width: int, which: int) -> np.ndarray:
    """A 64-bit hash of each run of ``width`` word hashes, by doubling lengths."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    k = np.uint64(_MULT[which])
    level, size, done, out = _mixed(words ^ k), 1, 0, None
    while True:
        if width & size:
            part = level[done : done + n]
            out = part if out is None else _mixed(out * (k + np.uint64(2 * size)) + part)
            done += size
        if done == width:
            return out
        level = _mixed(level[:-size] * (k + np.uint64(4 * size)) + level[size:])
        size *= 2


def parts(batches: Iterator[pa.RecordBatch], width: int, digests: bool = False) -> Iterator[tuple]:
    """Documents in parts of bounded size: (ids, word lists, window documents, starts, hashes[, second hashes]).

    With ``digests`` a window has two hashes, each from word hashes of its own seed.
    """

    def made(ids, words):
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        ends = np.cumsum(sizes)
        n = int(ends[-1]) if len(ends) else 0
        flat = np.fromiter((h for w in words for h in map(xxhash.xxh3_64_intdigest, w)), dtype=np.uint64, count=n)
        more = np.fromiter((h for w in words for h in map(xxhash.xxh3_64_intdigest, w, repeat(1))), dtype=np.uint64, count=n) if digests else None
        h64 = window_hashes(flat, width, 0)
        doc = np.repeat(np.arange(len(words)), np.maximum(sizes - width + 1, 0))
        first = np.concatenate([[0], np.cumsum(np.maximum(sizes - width + 1, 0))])[:-1]
        start = np.arange(len(doc)) - first[doc] if len(doc) else np.empty(0, dtype=np.int64)
        at = (ends - sizes)[doc] + start
        return ids, words, doc, start, h64[at], window_hashes(more, width, 1)[at] if digests else None

    for b in batches:
        got = b.column(b.schema.get_field_index("doc_id")).to_pylist()
        ids, words, size = [], [], 0
        for i, t in zip(got, texts_of(b, "text"), strict=True):
            ids.append(i)
            words.append(t.split())
            size += len(t)
            if size > PART_BYTES:
                yield made(ids, words)
                ids, words, size = [], [], 0
        if ids:
            yield made(ids, words)


def counters(h64: np.ndarray, row: int, width: int) -> np.ndarray:
    return (_mixed(h64 * np.uint64(_MULT[row])) % np.uint64(width)).astype(np.int64)


def _pack(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x).tobytes())


def _unpack(x: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(x, max_output_size=1 << 31), dtype=kind)


def _pack_sorted(x: np.ndarray) -> bytes:
    return _pack(np.diff(x, prepend=0).astype(np.uint32).view(np.uint8).reshape(-1, 4).T)


def _unpack_sorted(x: bytes) -> np.ndarray:
    raw = _unpack(x, "u1").reshape(4, -1).T
    return np.cumsum(np.ascontiguousarray(raw).view("<u4").ravel(), dtype=np.int64)


def sketch(docs: DataFrame, width: int, counters_a_row: int) -> np.ndarray:
    """(2, bytes) bit rows: whether a counter's merged estimate is two or more."""
    size = 1 << SHARD_BITS
    shards = -(-counters_a_row // size)
    schema = T.StructType.fromDDL("shard int, once binary, twice binary")

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(held: list[np.ndarray]) -> pa.RecordBatch:
            h, out = np.concatenate(held), []
            for row in range(2):
                c = np.sort(counters(h, row, counters_a_row))
                new = np.concatenate([[True], c[1:] != c[:-1]])
                once, twice = c[new], np.unique(c[~new])
                edges = np.arange(shards + 1) * size
                for k, (a, b, x, y) in enumerate(zip(*(f for e in (np.searchsorted(once, edges), np.searchsorted(twice, edges)) for f in (e[:-1], e[1:])), strict=True)):
                    if b > a:
                        out.append((row * shards + k, _pack_sorted(once[a:b] - k * size), _pack_sorted(twice[x:y] - k * size)))
            return batch_of(schema, **dict(zip(schema.names, map(list, zip(*out, strict=True)), strict=True)))

        held, n = [], 0
        for *_, h64, _ in parts(batches, width):
            if len(h64):
                held.append(h64)
                n += len(h64)
            if n >= BLOCK:
                yield block(held)
                held, n = [], 0
        if n:
            yield block(held)

    merged_schema = T.StructType.fromDDL("shard int, twice binary")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, seen, twice = None, None, None
        for b in batches:
            for s, a, t in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                if s != now:
                    if now is not None:
                        yield batch_of(merged_schema, shard=[now], twice=[np.packbits(twice, bitorder="little").tobytes()])
                    now, seen, twice = s, np.zeros(size, dtype=bool), np.zeros(size, dtype=bool)
                p = _unpack_sorted(a)
                twice[p] |= seen[p]
                seen[p] = True
                twice[_unpack_sorted(t)] = True
        if now is not None:
            yield batch_of(merged_schema, shard=[now], twice=[np.packbits(twice, bitorder="little").tobytes()])

    merged = docs.mapInArrow(released(local), schema).repartition("shard").sortWithinPartitions("shard").mapInArrow(released(merge), merged_schema)
    merged, path = materialise(merged, "sketch")
    out = np.zeros((2, shards * size // 8), dtype=np.uint8)
    for r in merged.toLocalIterator():
        row, k = divmod(r.shard, shards)
        out[row, k * size // 8 : (k + 1) * size // 8] = np.frombuffer(r.twice, dtype=np.uint8)
    drop_path(docs.sparkSession, path)
    return out


def estimated_repeated(bits: np.ndarray, h64: np.ndarray, counters_a_row: int) -> np.ndarray:
    keep = np.ones(len(h64), dtype=bool)
    for row in range(2):
        c = counters(h64, row, counters_a_row)
        keep &= (bits[row, c >> 3] >> (c & 7).astype(np.uint8)) & 1 == 1
    return keep


def _least(h64, more, doc, start):
    """One entry per digest: its smallest (doc, start)."""
    o = np.lexsort((start, doc, more, h64))
    h64, more, doc, start = h64[o], more[o], doc[o], start[o]
    new = np.concatenate([[True], (h64[1:] != h64[:-1]) | (more[1:] != more[:-1])]) if len(o) else np.empty(0, dtype=bool)
    return h64[new], more[new], doc[new], start[new]


def places(ids: list, doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(id, start) of windows in their order: a null id is the greatest id with ``NULL_BIT`` in its starts."""
    null = np.array([i is None for i in ids], dtype=bool)
    known = np.array([NO_ID if i is None else i for i in ids], dtype=np.int64)
    return known[doc], start + np.where(null[doc], NULL_BIT, 0)


def bucket_of(doc: np.ndarray, buckets: int) -> np.ndarray:
    return (_mixed(doc.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def firsts(docs: DataFrame, width: int, bits, counters_a_row: int, groups: int) -> DataFrame:
    """(doc, starts): packed starts of a document's windows that are the first of a candidate digest, one row a document.

    Places travel packed, by shard of the digest and then by bucket of the document.
    """
    schema = T.StructType.fromDDL("shard int, h64 binary, more binary, doc binary, start binary")
    bucket_schema = T.StructType.fromDDL("bucket int, doc binary, start binary")
    out_schema = T.StructType.fromDDL("doc long, starts binary")

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(held) -> pa.RecordBatch:
            h64, more, doc, start = _least(*(np.concatenate(x) for x in zip(*held, strict=True)))
            shard = (h64 >> np.uint64(32)) % np.uint64(groups)
            o = np.lexsort((start, doc, shard))
            h64, more, doc, start, shard = h64[o], more[o], doc[o], start[o], shard[o]
            cut = np.searchsorted(shard, np.arange(groups + 1))
            rows = [(k, _pack(h64[a:b]), _pack(more[a:b]), _pack(np.diff(doc[a:b], prepend=0)), _pack(start[a:b].astype(np.uint32))) for k, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if b > a]
            return batch_of(schema, **dict(zip(schema.names, map(list, zip(*rows, strict=True)), strict=True)))

        held, n, b = [], 0, bits.value
        for ids, _, doc, start, h64, more in parts(batches, width, digests=True):
            k = estimated_repeated(b, h64, counters_a_row)
            if k.any():
                held.append((h64[k], more[k], *places(ids, doc[k], start[k])))
            n += int(k.sum())
            if n >= BLOCK:
                yield block(held)
                held, n = [], 0
        if held:
            yield block(held)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(held) -> Iterator[pa.RecordBatch]:
            *_, doc, start = _least(*(np.concatenate(x) for x in zip(*held, strict=True)))
            bucket = bucket_of(doc, groups)
            o = np.lexsort((start, doc, bucket))
            doc, start, bucket = doc[o], start[o], bucket[o]
            cut = np.searchsorted(bucket, np.arange(groups + 1))
            rows = [(k, _pack(np.diff(doc[a:b], prepend=0)), _pack(start[a:b].astype(np.uint32))) for k, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if b > a]
            for k in range(0, len(rows), 1000):
                yield batch_of(bucket_schema, **dict(zip(bucket_schema.names, map(list, zip(*rows[k : k + 1000], strict=True)), strict=True)))

        now, held, n, least = None, [], 0, 0
        for b in batches:
            for s, h64, more, doc, start in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
                if s != now:
                    if held:
                        yield from told(held)
                    now, held, n, least = s, [], 0, 0
                held.append((_unpack(h64, "<u8"), _unpack(more, "<u8"), np.cumsum(_unpack(doc, "<i8")), _unpack(start, "<u4").astype(np.int64)))
                n += len(held[-1][0])
                if n > 2 * least + BLOCK:  # keep one entry per digest, not one per block
                    held = [_least(*(np.concatenate(x) for x in zip(*held, strict=True)))]
                    n = least = len(held[0][0])
        if held:
            yield from told(held)

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(held) -> Iterator[pa.RecordBatch]:
            doc, start = (np.concatenate(x) for x in zip(*held, strict=True))
            null = start >= NULL_BIT
            o = np.lexsort((start, doc, null))
            doc, start, null = doc[o], start[o], null[o]
            new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (null[1:] != null[:-1])]))
            raw, ends = np.where(null, start - NULL_BIT, start).astype("<u4").tobytes(), np.append(new[1:], len(doc))
            for k in range(0, len(new), 10_000):
                some, stop = new[k : k + 10_000], ends[k : k + 10_000]
                yield batch_of(out_schema, doc=pa.array(doc[some], mask=null[some]), starts=[raw[4 * a : 4 * b] for a, b in zip(some.tolist(), stop.tolist(), strict=True)])

        now, held = None, []
        for b in batches:
            for k, doc, start in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                if k != now:
                    if held:
                        yield from told(held)
                    now, held = k, []
                held.append((np.cumsum(_unpack(doc, "<i8")), _unpack(start, "<u4").astype(np.int64)))
        if held:
            yield from told(held)

    by_bucket = docs.mapInArrow(released(local), schema).repartition("shard").sortWithinPartitions("shard").mapInArrow(released(merge), bucket_schema)
    return by_bucket.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(released(unpacked), out_schema)


def judge_with(bits, counters_a_row: int, width: int, with_text: bool):
    """Arrow function (doc_id, text, packed first starts) -> figures of a row[, its kept text]."""
    fields = "n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text

    def run(ids: pa.Array, texts: pa.Array, firsts: pa.Array) -> pa.Array:
        b, at_row, out = bits.value, 0, []
        own = [np.frombuffer(f, dtype="<u4") if f else NONE for f in firsts.to_pylist()]
        batch = pa.RecordBatch.from_arrays([ids, texts], names=["doc_id", "text"])
        for _, words, doc, start, h64, _ in parts([batch], width):
            hit = estimated_repeated(b, h64, counters_a_row)
            doc, start = doc[hit], start[hit]
            cut = np.searchsorted(doc, np.arange(len(words) + 1))
            for k, w in enumerate(words):
                at, kept = start[cut[k] : cut[k + 1]], w
                if len(at) and len(own[at_row]):
                    at = at[~np.isin(at, own[at_row])]
                if len(at):
                    cover = np.zeros(len(w) + 1, dtype=np.int32)
                    np.add.at(cover, at, 1)
                    np.subtract.at(cover, at + width, 1)
                    stay = np.cumsum(cover[:-1]) == 0
                    kept = [x for x, y in zip(w, stay.tolist(), strict=True) if y]
                text = b" ".join(kept)
                out.append((len(w), len(w) - len(kept), hashlib.sha256(text).hexdigest(), *([text if len(at) else None] if with_text else [])))
                at_row += 1
        names, types = ("n_words", "n_removed", "kept_sha256", "kept_text"), (pa.int64(), pa.int64(), pa.string(), pa.string())
        columns = list(zip(*out, strict=True)) or [()] * (3 + with_text)
        release()
        return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=False)], names=names[: len(columns)])

    run.__annotations__ = {"ids": pa.Array, "texts": pa.Array, "firsts": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, fields)


def with_removal(docs: DataFrame, width: int, with_text: bool) -> DataFrame:
    """(doc_id, text, other columns as ``_row``, _out): every row beside what is cut from it.

    The text crosses the shuffle once; only it and its first starts go to Python, in
    batches of bounded size, while the other columns stay behind.
    """
    spark = docs.sparkSession
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = plain.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    windows = max(1, size // 6)
    counters_a_row = min(MAX_COUNTERS, max(1 << SHARD_BITS, 3 * windows))
    bits = spark.sparkContext.broadcast(sketch(plain, width, counters_a_row))
    f = firsts(plain, width, bits, counters_a_row, max(1, round(windows / SHARD_WINDOWS)))
    f = f.withColumnRenamed("starts", "_firsts")
    rest = [docs[c].alias(f"c{k}") for k, c in enumerate(docs.columns) if c != "text"]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.struct(*rest).alias("_row"))
    met = rows.join(f, F.col("doc_id").eqNullSafe(F.col("doc")), "left").drop("doc")
    return met.withColumn("_out", judge_with(bits, counters_a_row, width, with_text)("doc_id", "text", "_firsts"))


def removed(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row."""
    return with_removal(docs.select("doc_id", "text"), width, False).select("doc_id", "_out.n_words", "_out.n_removed", "_out.kept_sha256")


def remove(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The documents with their repeated windows cut out: the same columns, ``n_chars`` renewed.

    Kept words are joined by one space.  A document of which nothing is left goes; one
    that nothing was cut from keeps its text as it was.
    """
    out = with_removal(docs, width, True).where("_out.n_removed < _out.n_words OR _out.n_removed = 0")
    out = out.withColumn("_new", F.coalesce(F.col("_out.kept_text"), F.col("text")))
    new = {"text": F.col("_new"), "n_chars": F.length("_new").cast("long")}
    return out.select(*[new.get(c, F.col(f"_row.c{k}")).alias(c) for k, c in enumerate(docs.columns)])


def op9(spark, sf_dir) -> DataFrame:
    return removed(table(spark, sf_dir, "documents"))


ORACLE_SQL = rf"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT doc_id, ws, unnest(range(1, len(ws) - {WIDTH - 2})) AS start FROM w),
r AS (SELECT doc_id, start, row_number() OVER (PARTITION BY array_to_string(ws[start:start + {WIDTH - 1}], ' ') ORDER BY doc_id, start) AS n FROM s),
gone AS (SELECT DISTINCT doc_id, unnest(range(start, start + {WIDTH})) AS p FROM r WHERE n > 1),
words AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(kept.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""
