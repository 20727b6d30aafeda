"""Log-likelihood of whole documents under a gated recurrent language model.

Tokens are words with A-Z folded, then one end.  The texts are read once:

1. Encoding.  Each task numbers the words it meets and writes its documents as numbers,
   in chunks with a vocabulary each (at most ``VOCABULARY`` words, ``CHUNK_TOKENS``
   tokens), with the vocabulary's counts in training documents.
2. Counts.  The vocabularies are grouped by word: exact counts of all words, from which
   the ``HEAD`` most frequent get a place each in the factored softmax of
   ``gated_network``; any other word shares the last place of a class, chosen by a hash
   of its ending, and has its smoothed unigram share of that place's mass.
3. Coding.  Counts and places are joined to the vocabularies (a word has one row per
   chunk, so a frequent word never meets in one task as often as it occurs), and each
   chunk's documents are written as codes.
4. Training.  Training documents are dealt by a hash of their id to units of about
   ``UNIT`` tokens and ``ROUNDS`` rounds.  In a round every unit trains a replica of the
   average so far; replicas are averaged, weighted by tokens, by partial sums in a tree.
   Units depend on the documents alone, so scores do not depend on the partitioning.
5. Scoring carries the state through every whole document.

Defined cases: null text reads as empty (one end token); a null doc_id is held out;
unknown words share one smoothing slot of their place; rows repeat as given; an empty
table gives an empty result, and without training rows the model is as it starts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F, types as T

from medialoom.llm import gated_network as net
from medialoom.llm.common import batch_of, drop_path, materialise, pick, table, texts_of

HEAD = net.CLASSES * (net.SLOTS - 1)
ALPHA = 0.1
VOCABULARY, CHUNK_TOKENS, BLOCK_TOKENS, SCORE_TOKENS = 1 << 19, 8_000_000, 1_000_000, 2_000_000
UNIT, ROUNDS = 250_000, 6
MOST_SUMS = 32
END = b"\n"  # no word holds white space


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 10 == 0


class Vocabulary(dict):
    """Numbers words in order of arrival."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def _pack(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(x.tobytes())


def _unpack(x: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(x, max_output_size=1 << 31), dtype=kind)


def encoded(docs: DataFrame) -> DataFrame:
    """Rows of two kinds by chunk: packed documents (ids, sizes, numbers), and the vocabulary with its training counts."""
    schema = T.StructType.fromDDL("kind string, chunk long, ids array<long>, sizes binary, numbers binary, words array<binary>, counts array<long>")

    def row(**given) -> pa.RecordBatch:
        return batch_of(schema, **{f: [given.get(f)] for f in schema.names})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunk = TaskContext.get().partitionId() << 32
        words, counts, n_chunk = Vocabulary({END: 0}), np.zeros(0, dtype=np.int64), 0
        ids, parts, n = [], [], 0

        def block() -> pa.RecordBatch:
            nonlocal counts, ids, parts, n
            seen = [p for i, p in zip(ids, parts, strict=True) if not held_out(i)]
            more = np.bincount(np.concatenate(seen), minlength=len(words)) if seen else np.zeros(len(words), dtype=np.int64)
            more[: len(counts)] += counts
            out = row(kind="documents", chunk=chunk, ids=ids, sizes=_pack(np.array(list(map(len, parts)), dtype="<i4")), numbers=_pack(np.concatenate(parts)))
            counts, ids, parts, n = more, [], [], 0
            return out

        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), texts_of(b, "text"), strict=True):
                w = t.lower().split()
                w.append(END)
                ids.append(i)
                parts.append(np.fromiter(map(words.__getitem__, w), dtype="<i4", count=len(w)))
                n += len(w)
                n_chunk += len(w)
                full = len(words) > VOCABULARY or n_chunk > CHUNK_TOKENS
                if n > BLOCK_TOKENS or full:
                    yield block()
                if full:
                    yield row(kind="words", chunk=chunk, words=list(words), counts=counts)
                    chunk, words, counts, n_chunk = chunk + 1, Vocabulary({END: 0}), np.zeros(0, dtype=np.int64), 0
        if ids:
            yield block()
        if n_chunk:
            yield row(kind="words", chunk=chunk, words=list(words), counts=counts)

    return docs.mapInArrow(run, schema)


def shared_place(word: Column) -> Column:
    """The code that a word outside the head has: the last place of a class of its ending."""
    return (F.pmod(F.xxhash64(F.substring(word, -3, 3)), F.lit(net.CLASSES)) * net.SLOTS + net.SLOTS - 1).cast("int")


def head(counts: DataFrame) -> list[bytes]:
    """The ``HEAD`` most frequent words; of equally frequent ones the smallest.

    A histogram of counts finds the cut, so only words of its last bin are compared.
    """
    size = F.floor(F.log2("c") * 16).cast("int")
    room, low, last = HEAD, None, None
    for r in sorted(counts.where("c > 0").groupBy(size.alias("bin")).count().collect(), key=lambda r: -r.bin):
        if r["count"] > room:
            last = r.bin
            break
        room, low = room - r["count"], r.bin
    found = counts.where((F.col("c") > 0) & (size >= low)).select("word", "c").collect() if low is not None else []
    if last is not None and room:
        found += counts.where((F.col("c") > 0) & (size == last)).select("word", "c").repartition(MOST_SUMS).orderBy(F.desc("c"), "word").limit(room).collect()
    return [bytes(r.word) for r in sorted(found, key=lambda r: (-r.c, bytes(r.word)))]


def place(rank: int) -> int:
    """Code of the word of a rank: neighbours in frequency are in different classes."""
    return rank % net.CLASSES * net.SLOTS + rank // net.CLASSES


def coded(blocks: DataFrame, places: DataFrame, mass: np.ndarray) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, counted (sum of log10 smoothed counts), shares (log10, inside shared places), codes."""
    schema = T.StructType.fromDDL("doc_id long, held_out boolean, n_tokens long, n_known long, counted double, shares double, codes binary")
    log_mass = np.log10(np.maximum(mass, ALPHA))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        n = right.num_rows
        count, code = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        at = right["at"].to_numpy()
        count[at], code[at] = right["c"].to_numpy(), right["code"].to_numpy()
        known, logs = (count > 0).astype(np.int64), np.log10(count + ALPHA)
        share = np.where(code % net.SLOTS == net.SLOTS - 1, logs - log_mass[code], 0.0)
        short, out = code.astype("<u2"), []
        for ids, sizes, numbers in zip(left["ids"].to_pylist(), left["sizes"].to_pylist(), left["numbers"].to_pylist(), strict=True):
            numbers, sizes = _unpack(numbers, "<i4"), _unpack(sizes, "<i4")
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
            sums = [np.add.reduceat(x[numbers], starts) for x in (known, logs, share)]
            codes = short[numbers]
            packed = [_pack(codes[a : a + m]) for a, m in zip(starts.tolist(), sizes.tolist(), strict=True)]
            out.append(batch_of(schema, doc_id=ids, held_out=list(map(held_out, ids)), n_tokens=sizes.astype(np.int64), n_known=sums[0], counted=sums[1], shares=sums[2], codes=packed))
        return pa.Table.from_batches(out, schema=out[0].schema if out else batch_of(schema, **{f: [] for f in schema.names}).schema)

    places = places.select(F.col("chunk").alias("of_chunk"), "at", "c", "code")
    return blocks.groupBy("chunk").cogroup(places.groupBy("of_chunk")).applyInArrow(run, schema)


def mean_of(replicas: DataFrame, partitions: int) -> np.ndarray | None:
    """Weighted mean of (tokens, p) rows, p summed already; partial sums in a tree leave at most ``MOST_SUMS`` for the driver."""
    schema = replicas.schema

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, total = 0.0, np.zeros(net.SIZE)
        for b in batches:
            for n, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                tokens += n
                total += np.frombuffer(p, dtype="<f8")
        if tokens:
            yield batch_of(schema, tokens=[tokens], p=[total.tobytes()])

    while partitions > MOST_SUMS:
        partitions = -(-partitions // MOST_SUMS)
        replicas = replicas.repartition(partitions).mapInArrow(add, schema)
    rows = sorted((r.tokens, bytes(r.p)) for r in replicas.collect())
    return sum(np.frombuffer(p, dtype="<f8") for _, p in rows) / sum(t for t, _ in rows) if rows else None


def train(docs: DataFrame, tokens: int, start: dict[str, np.ndarray], end: int) -> dict[str, np.ndarray]:
    """Rounds of replicas from the average of the round before; ``docs``: doc_id and codes of training documents."""
    schema = T.StructType.fromDDL("tokens double, p binary")
    spark = docs.sparkSession
    units = max(1, round(tokens / UNIT))
    dealt = docs.select(F.pmod(F.xxhash64("doc_id"), F.lit(units)).alias("unit"), "doc_id", "codes")
    now = start
    for k in range(min(ROUNDS, units)):
        sent = spark.sparkContext.broadcast(now)

        def learn(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            """The weighted sum of the replicas of a task's units, which arrive one after the other."""
            total, n, unit, own, held, size = np.zeros(net.SIZE), 0, None, None, [], 0
            for b in batches:
                for u, c in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
                    if u != unit or size > UNIT:  # a unit that is much larger, by repeated ids, is learned in pieces
                        if held:
                            own.learn(held, end)
                            held, size = [], 0
                        if u != unit:
                            if own:
                                total += net.flat(own.p) * float(own.tokens)
                                n += own.tokens
                            unit, own = u, net.Trainer(sent.value)
                    held.append(_unpack(c, "<u2").astype(np.int64))
                    size += len(held[-1])
            if own:
                own.learn(held, end)
                total += net.flat(own.p) * float(own.tokens)
                n += own.tokens
                yield batch_of(schema, tokens=[float(n)], p=[total.tobytes()])

        some = dealt.where(F.col("unit") % ROUNDS == k)
        n = min(-(-(units - k) // ROUNDS), 8 * spark.sparkContext.defaultParallelism)
        each = some.repartition(n, "unit").sortWithinPartitions("unit", "doc_id", "codes").mapInArrow(learn, schema)
        mean = mean_of(each, n)
        sent.unpersist()
        now = now if mean is None else net.unflat(mean)
    return now


def likelihoods(docs: DataFrame, model: dict[str, np.ndarray], end: int) -> DataFrame:
    """The rows of ``coded`` with like, the log10 probability of their codes, in place of the codes."""
    schema = T.StructType([*(f for f in docs.schema if f.name != "codes"), T.StructField("like", T.DoubleType())])
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            packed, sizes = b.column(b.schema.get_field_index("codes")).to_pylist(), b.column(b.schema.get_field_index("n_tokens")).to_numpy()
            group = (np.cumsum(sizes) - sizes) // SCORE_TOKENS
            for g in np.unique(group).tolist():
                at = np.flatnonzero(group == g)
                like = net.log_likelihood(sent.value, [_unpack(packed[k], "<u2").astype(np.int64) for k in at.tolist()], end) / np.log(10)
                rows = b.slice(int(at[0]), len(at))
                yield batch_of(schema, **{f: rows.column(b.schema.get_field_index(f)) for f in schema.names if f != "like"}, like=like)

    return docs.mapInArrow(run, schema)


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    spark = docs.sparkSession
    chunks, chunks_path = materialise(encoded(pick(docs, doc_id="long", text="string")), "encoded")
    again = spark.read.schema(chunks.schema).parquet(chunks_path)
    # an array of a vocabulary is bounded by VOCABULARY
    entries = chunks.where("kind = 'words'").select("chunk", F.posexplode(F.arrays_zip("words", "counts")).alias("at", "w")).select("chunk", "at", F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
    counts, counts_path = materialise(entries.groupBy("word").agg(F.sum("n").alias("c")).withColumn("shared", shared_place(F.col("word"))), "word-counts")
    total = counts.where("c > 0").agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    top = head(counts)
    if END not in top:
        top = [*top[: HEAD - 1], END]  # few words or no training rows: the end has a place whatever its count
    own = spark.createDataFrame([(w, place(k)) for k, w in enumerate(top)], "word binary, own int")
    placed = counts.join(F.broadcast(own), "word", "left").select("word", "c", F.coalesce("own", "shared").alias("code"))
    mass = np.zeros(net.CODES)
    for r in placed.where("c > 0").groupBy("code").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect():  # at most one row per code
        mass[r.code] = r.n + ALPHA * r.v
    mass[net.SLOTS - 1 :: net.SLOTS] += ALPHA
    end = place(top.index(END))
    mass[end] = max(mass[end], ALPHA)
    blocks = again.where("kind = 'documents'").select("chunk", "ids", "sizes", "numbers")
    found, found_path = materialise(coded(blocks, entries.join(placed, "word").select("chunk", "at", "c", "code"), mass), "coded")
    model = train(found.where("NOT held_out"), total.n, net.start(mass), end)
    norm = float(np.log10(total.n + ALPHA * (total.v + 1)))
    out, _ = materialise(likelihoods(found, model, end), "scored")
    for path in (chunks_path, counts_path, found_path):
        drop_path(spark, path)
    return out.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(total.n).cast("long").alias("train_tokens"),
        (F.col("counted") - F.col("n_tokens") * norm).alias("base_score"),
        (F.col("like") + F.col("shares")).alias("score"),
    )


def op2(spark, sf_dir) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
