"""Content-addressed WARC archive.

Two tables hold an archive: ``payloads`` has each distinct payload once under its
SHA-256, ``headers`` has the exact WARC header bytes of every record and the key of its
payload.  Joining them restores each record byte for byte; on reading, every payload's
digest is computed again and compared with both the key and the header.

Of records with equal payloads of at least ``min_bytes`` bytes that with the smallest
page_id is the response and the others revisit it; smaller ones are all responses.

A key may hold a third of all records.  ``listed`` therefore rebuilds only responses with
their payloads and gives revisits the verified size and digest of theirs.  Rows meet what
is known of their key in ``met_by_key``: keys with more than one in ``HOT_SHARE`` of all
records, of which there are fewer than ``HOT_SHARE``, are broadcast, the others shuffled.

Defined cases: a null html is the empty payload; a null url leaves out the target line;
CR, LF and per cent signs in a url are percent-encoded in the header; rows that repeat
both page_id and payload are responses alike and share the stored payload; a null
page_id sorts after all others; an empty table gives an empty archive.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from medialoom.llm.common import batch_of, materialise, scratch_path, table

#: Fixed values of the format.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
URN = "urn:medialoom:page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2026-01-01T00:00:00Z"
TAIL = b"\r\n\r\n"
REVISIT = b"WARC/1.1\r\nWARC-Type: revisit\r\n"

HOT_SHARE = 1000
#: Read with its schema, as an empty bucketed table has no files.
PAYLOADS = "key string, payload binary, first_id long, records long"


def base32_of_hex(hexed: Column) -> Column:
    """Upper-case base32 of 40 hex digits: each five of them give four characters."""
    out = []
    for k in range(8):
        v = F.conv(F.substring(hexed, 5 * k + 1, 5), 16, 10).cast("int")
        out += [F.lit(ALPHABET).substr(F.shiftright(v, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*out)


def records(pages: DataFrame) -> DataFrame:
    p = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"))
    return p.select("*", F.sha2("payload", 256).alias("key"), base32_of_hex(F.sha1("payload")).alias("sha1"), F.octet_length("payload").cast("long").alias("bytes"))


def payload_table(path: str) -> str:
    return "warc_" + hashlib.sha256(path.encode()).hexdigest()[:24]


def met_by_key(rows: DataFrame, spread: Column, known: DataFrame, hot: DataFrame) -> DataFrame:
    """``rows`` with the columns that ``known`` has, once, for each key.

    ``hot`` has the keys that are broadcast; their rows are shuffled by ``spread``, which
    meets no key, so that no task gets them all.
    """
    of_hot = F.broadcast(known.join(F.broadcast(hot), "key", "left_semi").select(F.col("key").alias("_hot_key"), F.struct(*[c for c in known.columns if c != "key"]).alias("_hot")))
    others = known.select(F.col("key").alias("_other_key"), F.struct(*[c for c in known.columns if c != "key"]).alias("_other"))
    met = rows.join(of_hot, F.col("key") == F.col("_hot_key"), "left")
    met = met.withColumn("_key", F.when(F.col("_hot_key").isNotNull(), F.concat(F.lit("-"), spread.cast("string"))).otherwise(F.col("key")))
    met = met.join(others, F.col("_key") == F.col("_other_key"), "left").withColumn("_known", F.coalesce("_hot", "_other"))
    return met.select(*rows.columns, "_known.*")


def hot_keys(payloads: DataFrame) -> DataFrame:
    """Keys with more than one in ``HOT_SHARE`` of all records: fewer than ``HOT_SHARE`` keys."""
    total = payloads.agg(F.sum("records")).first()[0] or 0
    return payloads.where(F.col("records") * HOT_SHARE > total).select("key")


def write_archive(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """Write ``path/headers`` and ``path/payloads``, the latter bucketed by key.

    Bucketing lets readers in this catalog join without moving the payloads again.
    """
    spark, r = pages.sparkSession, records(pages)
    # rows of one key have one payload, so any of them will do: payloads move once
    kept = r.groupBy("key").agg(F.any_value("payload").alias("payload"), F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("records"))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kept.write.bucketBy(buckets, "key").sortBy("key").option("path", f"{path}/payloads").saveAsTable(payload_table(path))
    stored = spark.read.schema(PAYLOADS).parquet(f"{path}/payloads")
    h = met_by_key(r.select("page_id", "url", "key", "sha1", "bytes"), F.xxhash64("page_id", "url"), stored.select("key", "first_id"), hot_keys(stored))
    revisit = (F.col("bytes") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    urn = lambda c: F.concat(F.lit(f"<{URN}"), F.coalesce(F.col(c).cast("string"), F.lit("null")), F.lit(">\r\n"))
    safe = F.replace(F.replace(F.replace("url", F.lit("%"), F.lit("%25")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "),
        F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "),
        urn("page_id"),
        F.coalesce(F.concat(F.lit("WARC-Target-URI: "), safe, F.lit("\r\n")), F.lit("")),
        F.lit(f"WARC-Date: {DATE}\r\nWARC-Payload-Digest: sha1:"),
        F.col("sha1"),
        F.lit("\r\n"),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), urn("first_id"), F.lit(f"WARC-Profile: {PROFILE}\r\n"))).otherwise(""),
        F.lit("Content-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.when(revisit, F.lit(0)).otherwise(F.col("bytes")).cast("string"),
        F.lit("\r\n\r\n"),
    )
    h.select("page_id", "key", F.encode(head, "UTF-8").alias("header")).write.parquet(f"{path}/headers")


def _parts(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Headers and payloads, the latter by buckets where this catalog knows them."""
    name = payload_table(path)
    p = spark.table(name) if spark.catalog.tableExists(name) else spark.read.schema(PAYLOADS).parquet(f"{path}/payloads")
    return spark.read.parquet(f"{path}/headers"), p.select("key", "payload")


def _restored(headers: DataFrame, payloads: DataFrame) -> DataFrame:
    block = F.when(F.startswith("header", F.lit(REVISIT)), F.lit(b"")).otherwise(F.col("payload"))
    return headers.join(payloads, "key").select("page_id", "key", F.concat("header", block, F.lit(TAIL)).alias("record"), "payload")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """page_id, key, record (the exact WARC record bytes), payload (in full, for revisits too)."""
    return _restored(*_parts(spark, path))


def parse_header(header: bytes) -> dict[str, str]:
    lines = header.decode("utf-8").split("\r\n")
    return {"version": lines[0]} | dict(x.split(": ", 1) for x in lines[1:] if x)


TOLD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, target string"


def _own(urn: str | None) -> int | None:
    return None if urn in (None, f"<{URN}null>") else int(urn[len(URN) + 1 : -1])


def told(header: bytes, size: int, digest: str) -> tuple:
    """What a header says of its record, once it agrees with its payload's digest."""
    h = parse_header(header)
    if h["WARC-Payload-Digest"] != f"sha1:{digest}":
        raise ValueError(f"payload of {h['WARC-Record-ID']} does not match its digest")
    if int(h["Content-Length"]) != (size if h["WARC-Type"] == "response" else 0):
        raise ValueError(f"record {h['WARC-Record-ID']} is not whole")
    url = h.get("WARC-Target-URI")
    url = url and url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
    return _own(h["WARC-Record-ID"]), size, digest, h["WARC-Type"], _own(h.get("WARC-Refers-To")), url


def _batch(schema: T.StructType, rows: list[tuple]) -> pa.RecordBatch:
    return batch_of(schema, **dict(zip(schema.names, map(list, zip(*rows, strict=True)) if rows else [[]] * len(schema), strict=True)))


def described(archive: DataFrame) -> DataFrame:
    """What each record says of itself, checked against its payload, and its key."""
    schema = T.StructType.fromDDL(TOLD + ", key string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for key, record, payload in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                header, _, rest = record.partition(TAIL)
                if hashlib.sha256(payload).hexdigest() != key:
                    raise ValueError(f"a payload under {key} does not match it")
                row = told(header, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode())
                if rest != (payload if row[3] == "response" else b"") + TAIL:
                    raise ValueError(f"record of page {row[0]} is not whole")
                out.append((*row, key))
            yield _batch(schema, out)

    return archive.select("key", "record", "payload").mapInArrow(run, schema)


def describe(archive: DataFrame) -> DataFrame:
    """What each record says of itself, checked against its payload."""
    return described(archive).drop("key")


def listed(spark: SparkSession, path: str) -> DataFrame:
    """``describe`` of a whole archive, in which payloads meet only their responses."""
    headers, payloads = _parts(spark, path)
    is_revisit = F.startswith("header", F.lit(REVISIT))
    responses, _ = materialise(described(_restored(headers.where(~is_revisit), payloads)), "warc-responses")
    verified = responses.groupBy("key").agg(F.any_value("payload_bytes").alias("size"), F.any_value("payload_digest").alias("digest"))
    schema = T.StructType.fromDDL(TOLD)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = zip(*(b.column(i).to_pylist() for i in range(3)), strict=True)
            out = []
            for header, size, digest in rows:
                if size is None:
                    raise ValueError(f"no response has the payload of {parse_header(header[: -len(TAIL)])['WARC-Record-ID']}")
                out.append(told(header[: -len(TAIL)], size, digest))
            yield _batch(schema, out)

    revisits = met_by_key(headers.where(is_revisit).select("key", "header"), F.xxhash64("header"), verified, hot_keys(spark.read.schema(PAYLOADS).parquet(f"{path}/payloads")))
    return responses.drop("key").unionByName(revisits.select("header", "size", "digest").mapInArrow(run, schema))


def op5(spark, sf_dir) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_archive(table(spark, sf_dir, "pages"), path)
    found = listed(spark, path)
    spark.sql(f"DROP TABLE IF EXISTS {payload_table(path)}")  # the files stay, and are read no more by bucket
    return found.drop("target")


def _sql_base32() -> str:
    return " || ".join(f"substr('{ALPHABET}', CAST((CAST('0x' || substr(h, {5 * k + 1}, 5) AS INT) >> {s}) & 31 AS INT) + 1, 1)" for k in range(8) for s in (15, 10, 5, 0))


ORACLE_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS n, sha1(html) AS h, min(page_id) OVER (PARTITION BY html) AS first_id FROM p)
SELECT page_id, n AS payload_bytes, {_sql_base32()} AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM d
"""
