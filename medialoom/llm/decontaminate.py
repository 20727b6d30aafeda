"""Benchmark passages in documents, found over edits of whole words.

An item of n words leaks where some stretch of a document is within floor(0.2 n) word
edits of it.  Item-sized windows go through CGK random-walk embeddings, which turn a
small edit distance into a small Hamming distance; per repetition some sampled positions
of the embedding form a key, and windows that share a key with an item are candidates.
Candidates are verified exactly by a bit-parallel edit distance over the stretch around
the window.

Items are handled in bands of like length: an item's key looks at the part of the walk
that the shortest item of its band has.  How many positions a key samples and how many
repetitions there are follows from ``RECALL``: per band, random strings with the most
edits allowed tell how often a position of the walk agrees (``agreement``), and the most
selective key is taken whose repetitions, at most ``MOST_REPEATS``, reach that recall.

A lossless bound keeps the work small.  With k edits, one of the at most k + 1 unedited
runs of an item holds ceil((n - k) / (k + 1)) words or more, so only windows around such
a run of an item are embedded.  Items are few against the corpus: they are the stated
query set, sent in blocks of ``BLOCK_WORDS`` words, whatever their number, with one scan
of the documents for each block.

Defined cases: null or empty items match nothing; null text reads as empty; repeated
items are reported under each id; a document is reported once per item, with its least
distance and first such stretch; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from medialoom.llm.common import batch_of, pick, released, table, texts_of
from medialoom.llm.substring import _mixed, window_hashes

EDIT_PERCENT = 20
RECALL, MOST_REPEATS, MOST_SAMPLES = 0.98, 64, 3
TRIALS = 60
BLOCK_WORDS = 200_000
GROUP_BYTES = 3_000_000
BAND = 1.4
_ODD = np.uint64(0x9E3779B97F4A7C15)


def edits_allowed(n: int) -> int:
    return n * EDIT_PERCENT // 100


def run_length(n: int) -> int:
    """Words that some unedited run of an item of n words has at least."""
    k = edits_allowed(n)
    return -(-(n - k) // (k + 1))


def word_hashes(text: bytes) -> np.ndarray:
    w = text.lower().split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, w), dtype=np.uint64, count=len(w))


def closest(item: list, text: list) -> tuple[int, int, int]:
    """Least word edits of ``item`` to a stretch of ``text``, and its start and end.

    Myers' bit-parallel automaton; on ties the first end, then the longest stretch.
    """

    def sweep(pattern, seq, free):
        m, masks = len(pattern), defaultdict(int)
        for i, c in enumerate(pattern):
            masks[c] |= 1 << i
        full, top = (1 << m) - 1, 1 << (m - 1)
        pv, mv, score = full, 0, m
        for j, c in enumerate(seq):
            eq = masks.get(c, 0)
            xv = eq | mv
            xh = (((eq & pv) + pv) ^ pv) | eq
            ph, mh = mv | (full & ~(xh | pv)), pv & xh
            score += bool(ph & top) - bool(mh & top)
            ph = (ph << 1) & full | (0 if free else 1)
            mh = (mh << 1) & full
            pv, mv = mh | (full & ~(xv | ph)), ph & xv
            yield j, score

    best, end = len(item), 0
    for j, s in sweep(item, text, True):
        if s < best:
            best, end = s, j + 1
    start = end
    for j, s in sweep(item[::-1], text[:end][::-1], False):
        if s == best:
            start = end - j - 1
    return best, start, end


def walk(flat: np.ndarray, start: np.ndarray, stop: np.ndarray, r: int, steps: int):
    """The symbols of repetition r's random walk over the strings flat[start:stop], step by step, with the places."""
    p, last = start.copy(), len(flat) - 1
    for j in range(steps):
        sym = np.where(p < stop, flat[np.minimum(p, last)], np.uint64(0))
        yield j, sym, p
        p = p + ((_mixed(sym + np.uint64((r * 4099 + j + 1) * 2654435761)) >> np.uint64(17)) & np.uint64(1)).astype(np.int64)


@functools.lru_cache(maxsize=256)
def agreement(n: int) -> float:
    """Share of the walk's first 2n positions in which a string of n words and one with the most edits allowed agree.

    A low quantile over ``TRIALS`` random pairs, so that most pairs agree more often.
    """
    r, a, b = np.random.default_rng(n), [], []
    for _ in range(TRIALS):
        s = r.integers(1, 1 << 62, n).tolist()
        t = list(s)
        for _ in range(edits_allowed(n)):
            how, at = r.integers(3), int(r.integers(max(1, len(t))))
            if how == 0 and t:
                t[at] = int(r.integers(1, 1 << 62))
            elif how == 1:
                t.insert(at, int(r.integers(1, 1 << 62)))
            elif t:
                del t[at]
        a.append((s + [0] * (2 * n))[: 2 * n])
        b.append((t + [0] * (2 * n))[: 2 * n])
    flat = np.array([*a, *b, [0] * (2 * n)], dtype=np.uint64).ravel()
    start = np.arange(2 * TRIALS, dtype=np.int64) * 2 * n
    same = np.zeros(TRIALS)
    for _, sym, p in walk(flat, start, start + 2 * n, 0, 2 * n):
        sym = np.where(p - start < n, sym, np.uint64(0))
        same += sym[:TRIALS] == sym[TRIALS:]
    return float(np.quantile(same / (2 * n), 0.2))


def plan(n: int) -> tuple[int, int]:
    """(positions a key, repetitions) that reach ``RECALL`` for items of about n words."""
    p = min(agreement(n), 1 - 1e-9)
    for samples in range(MOST_SAMPLES, 0, -1):
        repeats = 1 if edits_allowed(n) == 0 else int(np.ceil(np.log(1 - RECALL) / np.log1p(-(max(p, 1e-6) ** samples))))
        if repeats <= MOST_REPEATS:
            return samples, repeats
    return 1, MOST_REPEATS


class Index:
    """Hash tables of one block of items."""

    def __init__(self, items: list[tuple[int, bytes]]):
        self.ids = [i for i, _ in items]
        self.words = [word_hashes(t) for _, t in items]
        self.lists = [w.tolist() for w in self.words]
        self.sizes = np.array([len(w) for w in self.words])
        self.k = np.array([edits_allowed(n) for n in self.sizes])
        self.longest = int(self.sizes.max(initial=0))
        grams = defaultdict(list)
        for w in self.words:
            q = run_length(len(w))
            grams[q].append(window_hashes(w, q, 0))
        self.grams = {q: np.unique(np.concatenate(g)) for q, g in grams.items()}
        self.maps = {}
        for q, g in self.grams.items():  # one bit per hash remainder: most windows end here
            self.maps[q] = np.zeros(1 << 22, dtype=bool)
            self.maps[q][(g & np.uint64((1 << 22) - 1)).astype(np.int64)] = True
        self.bands: list[tuple[int, np.ndarray]] = []
        order = np.argsort(self.sizes, kind="stable")
        while len(order):
            low = int(self.sizes[order[0]])
            some = order[self.sizes[order] <= max(low, int(low * BAND))]
            self.bands.append((low, some))
            order = order[len(some) :]
        self.plans = [plan(low) for low, _ in self.bands]
        self.repeats = max((r for _, r in self.plans), default=0)
        rng = np.random.default_rng(11)
        #: positions by repetition and band; none for a band that has had its repetitions
        self.at = [[np.sort(rng.choice(max(n, 2 * low), n, replace=False)) if k < r else np.empty(0, dtype=np.int64) for (low, _), (n, r) in zip(self.bands, self.plans, strict=True)] for k in range(self.repeats)]
        self.tables = []
        flat = np.concatenate([*self.words, np.zeros(1, dtype=np.uint64)])
        start = np.concatenate([[0], np.cumsum(self.sizes)])[:-1]
        for r in range(self.repeats):
            keys = self.keys(flat, start, start + self.sizes, r)
            row = []
            for b, (_, some) in enumerate(self.bands):
                o = np.argsort(keys[b][some], kind="stable")
                row.append((keys[b][some][o], some[o]))
            self.tables.append(row)

    def keys(self, flat: np.ndarray, start: np.ndarray, stop: np.ndarray, r: int) -> list[np.ndarray]:
        """Per band, the key of repetition r of the strings flat[start:stop]."""
        out = [np.full(len(start), np.uint64(b + 1), dtype=np.uint64) for b in range(len(self.bands))]
        wanted = defaultdict(list)
        for b, at in enumerate(self.at[r]):
            for x in at.tolist():
                wanted[x].append(b)
        for j, sym, p in walk(flat, start, stop, r, max(wanted, default=-1) + 1):
            for b in wanted.get(j, ()):
                seen = np.where(p - start < self.bands[b][0], sym, np.uint64(0))  # windows and items of one length
                out[b] = _mixed(out[b] * _ODD + seen)
        return out

    def starts(self, flat: np.ndarray) -> np.ndarray:
        """Where a window may hold a leaking item: around any unedited run."""
        mark = np.zeros(len(flat) + 1, dtype=np.int32)
        slack = int(self.k.max(initial=0))
        for q, g in self.grams.items():
            h = window_hashes(flat, q, 0)
            hit = np.flatnonzero(self.maps[q][(h & np.uint64((1 << 22) - 1)).astype(np.int64)])
            if len(hit):
                at = np.minimum(np.searchsorted(g, h[hit]), len(g) - 1)
                hit = hit[g[at] == h[hit]]
                np.add.at(mark, np.maximum(hit - self.longest - slack, 0), 1)
                np.subtract.at(mark, hit + 1, 1)
        return np.flatnonzero(np.cumsum(mark[:-1]) > 0)

    def candidates(self, flat: np.ndarray, doc_end: np.ndarray, at: np.ndarray) -> set[tuple[int, int]]:
        """(start, item) that share a key."""
        out: set[tuple[int, int]] = set()
        for r in range(self.repeats):
            # a window is as long as the shortest item of the band it is compared with needs
            keys = self.keys(flat, at, doc_end, r)
            for b in range(len(self.bands)):
                if not len(self.at[r][b]):
                    continue
                table, items = self.tables[r][b]
                k = keys[b]
                i, j = np.searchsorted(table, k, "left"), np.searchsorted(table, k, "right")
                for x in np.flatnonzero(j > i).tolist():
                    for y in items[i[x] : j[x]].tolist():
                        out.add((int(at[x]), y))
        return out


def hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, distance, start_word, end_word (excluded) of every leak."""
    spark = docs.sparkSession
    schema = T.StructType.fromDDL("doc_id long, item_id long, distance int, start_word long, end_word long")
    docs = pick(docs, doc_id="long", text="string")
    blocks: list[list[tuple[int, bytes]]] = [[]]
    words = 0
    for r in pick(benchmark, item_id="long", text="string").where("text IS NOT NULL").toLocalIterator():
        t = r.text.encode()
        n = len(t.split())
        if n:
            if words + n > BLOCK_WORDS and blocks[-1]:
                blocks.append([])
                words = 0
            blocks[-1].append((r.item_id, t))
            words += n
    out = None
    for block in blocks:
        index = spark.sparkContext.broadcast(Index(block) if block else None)
        part = docs.mapInArrow(released(_scan(index, schema)), schema)
        out = part if out is None else out.unionByName(part)
    return out


def _scan(sent, schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value
        if index is None:
            return
        for b in batches:
            ids, texts, size = [], [], 0
            for i, t in zip(b.column(0).to_pylist(), texts_of(b, "text"), strict=True):
                ids.append(i)
                texts.append(t)
                size += len(t)
                if size > GROUP_BYTES:
                    yield from found(index, ids, texts)
                    ids, texts, size = [], [], 0
            if ids:
                yield from found(index, ids, texts)

    def found(index, ids, texts) -> Iterator[pa.RecordBatch]:
        each = [word_hashes(t) for t in texts]
        ends = np.cumsum([len(w) for w in each])
        flat = np.concatenate([*each, np.zeros(1, dtype=np.uint64)])
        at = index.starts(flat)
        at = at[at < ends[-1]] if len(ends) else at
        if not len(at):
            return
        doc = np.searchsorted(ends, at, "right")
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        done: dict[tuple[int, int], int] = {}
        for s, y in sorted(index.candidates(flat, ends[doc], at)):
            d, n, k = int(np.searchsorted(ends, s, "right")), int(index.sizes[y]), int(index.k[y])
            low = int(ends[d] - len(each[d]))
            if done.get((d, y), -1) >= s + k:  # the stretch verified before holds this one
                continue
            a, z = max(low, s - k), min(int(ends[d]), s + 2 * n + 2 * k)
            done[d, y] = z - n
            item, text = index.lists[y], flat[a:z].tolist()
            if sum(map(set(text).__contains__, item)) < n - k:  # each missing word costs an edit
                continue
            got, x, e = closest(item, text)
            if got <= k and ((d, y) not in best or got < best[d, y][0]):
                best[d, y] = (got, a - low + x, a - low + e)
        if best:
            rows = [(ids[d], index.ids[y], *v) for (d, y), v in sorted(best.items())]
            yield batch_of(schema, **dict(zip(schema.names, map(list, zip(*rows, strict=True)), strict=True)))

    return run


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no item leaks, whole rows as they were."""
    leaks = hits(docs, benchmark).select("doc_id").distinct()
    return docs.join(leaks, docs["doc_id"].eqNullSafe(leaks["doc_id"]), "left_anti")


def op7(spark, sf_dir) -> DataFrame:
    return hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
