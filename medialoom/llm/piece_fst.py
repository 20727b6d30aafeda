"""SentencePiece encoding and decoding as a weighted finite-state transducer.

A ``.model`` file is compiled into explicit machines, tables of states and arcs
(``Machine``), which are composed lazily with each input:

- the normaliser: one path per entry of the model's character map, the longest match
  wins; then extra spaces go if the model says so, and spaces become marks;
- the lexicon: one path per piece, weighted by minus its score;
- byte fallback: a path of byte pieces (or the unknown piece) for a character that no
  piece covers.

The encoding is the shortest path in the tropical semiring.  For a unigram model that is
all.  A BPE model has no additive weights, so the composition has one more factor, an
acceptor of piece bigrams: ``b`` may follow ``a`` (weight 0) only if merging ``a + b``
yields exactly ``a, b``; other arcs have infinite weight.  A piece sequence is the BPE
encoding exactly when all its neighbouring pairs are, so one path is finite.  The
acceptor's arcs are compiled when they are first met.

Where no piece holds a mark after another character, nor a line feed, the composition
falls apart at these places, and chunks met lately are kept: two generations of at most
``memo`` chunks and ``CHARS`` times as many characters.  Models with other pieces are
composed with whole texts.

Not compiled, so refused with ValueError: user-defined symbols, marks as suffixes, other
model types than unigram and BPE, and BPE models with unused pieces or with merges of
equal score (but those of runs of marks).

Defined cases: null text reads as empty; an empty text has no pieces; decoding is exact
for texts that the normaliser leaves alone, but for the mark character U+2581, which
decodes to a space; rows repeat as given; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from medialoom.llm.common import batch_of, pick, released, table, texts_of

MARK = "▁"
MEMO, CHARS, PAIRS = 400_000, 40, 2_000_000
GROUP_BYTES = 4_000_000
UNKNOWN_COST = 10.0  # fixed value: what an unknown character costs more than the worst piece
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")
INF = float("inf")


class Machine:
    """A deterministic transducer of strings: arcs by state and character, an output at final states."""

    SHIFT = 21  # bits of a character

    def __init__(self, paths: dict):
        self.arc: dict[int, int] = {}
        self.output: list = [None]
        for text, out in paths.items():
            at = 0
            for c in map(ord, text):
                to = self.arc.setdefault(at << self.SHIFT | c, len(self.output))
                if to == len(self.output):
                    self.output.append(None)
                at = to
            self.output[at] = out

    def longest(self, text: str, i: int):
        """(end, output) of the longest path from place i, or None."""
        at, found = 0, None
        for j in range(i, len(text)):
            at = self.arc.get(at << self.SHIFT | ord(text[j]))
            if at is None:
                break
            if self.output[at] is not None:
                found = (j + 1, self.output[at])
        return found


def character_map(blob: bytes) -> dict[str, str]:
    """Entries of a compiled character map: a double-array trie of UTF-8 bytes, then its values.

    A unit of the trie holds its label in the bits 0-7 and 31, whether a value hangs below
    in bit 8, and the offset of its children in the bits 10-30, shifted by 8 if bit 9 is set.
    """
    if not blob:
        return {}
    size = int.from_bytes(blob[:4], "little")
    units, values = np.frombuffer(blob, "<u4", size // 4, 4).astype(np.int64), blob[4 + size :]
    below = lambda u: (u >> 10) << ((u & 512) >> 6)
    labels, found = np.arange(1, 256), {}
    nodes, keys = np.array([below(units[0])]), [b""]
    while len(nodes):
        place = nodes[:, None] ^ labels
        unit = units[np.minimum(place, len(units) - 1)]
        row, col = np.nonzero((place < len(units)) & ((unit & 0x800000FF) == labels))
        unit = unit[row, col]
        nodes, keys = place[row, col] ^ below(unit), [keys[r] + bytes([c + 1]) for r, c in zip(row.tolist(), col.tolist(), strict=True)]
        for k in np.nonzero(unit & 256)[0].tolist():
            start = int(units[nodes[k]] & 0x7FFFFFFF)
            found[keys[k].decode()] = values[start : values.index(b"\0", start)].decode()
    return found


class Model:
    """The compiled machines; holds nothing but tables bounded by the vocabulary, and bounded memos."""

    def __init__(self, data: bytes):
        from sentencepiece import sentencepiece_model_pb2 as pb

        m = pb.ModelProto()
        m.ParseFromString(data)
        n, t = m.normalizer_spec, m.trainer_spec
        if not n.escape_whitespaces or t.treat_whitespace_as_suffix or t.model_type not in (1, 2):
            raise ValueError("only unigram and BPE models with marks before words are compiled")
        self.bpe, self.prefix, self.squeeze = t.model_type == 2, n.add_dummy_prefix, n.remove_extra_whitespaces
        self.score, self.ids, self.raw, self.byte = [], {}, [], {}
        self.unk = 0
        for i, p in enumerate(m.pieces):
            self.score.append(p.score)
            self.raw.append(p.piece.encode() if p.type == 1 else b"")
            if p.type == 1:
                self.ids[p.piece] = i
            elif p.type == 6:
                v = int(_BYTE.fullmatch(p.piece)[1], 16)
                self.byte[v] = i
                self.raw[i] = bytes([v])
            elif p.type == 2:
                self.unk = i
                self.raw[i] = t.unk_surface.encode()
            elif p.type == 4 or (p.type == 5 and self.bpe):
                raise ValueError("user-defined symbols and unused pieces of BPE are not compiled")
        self.byte = self.byte if t.byte_fallback else {}
        self.piece = {i: p for p, i in self.ids.items()}
        self.unknown_cost = UNKNOWN_COST - min((self.score[i] for i in self.piece), default=0.0)
        self.lexicon = Machine(self.ids)
        entries = character_map(n.precompiled_charsmap)
        self.normaliser = Machine(entries)
        self.first = re.compile("[" + "".join(map(re.escape, sorted({k[0] for k in entries}))) + "]") if entries else None
        if self.bpe:
            ties = Counter(self.score[i] for p, i in self.ids.items() if len(p) > 1 and p.strip(MARK))
            runs = {self.score[i] for p, i in self.ids.items() if len(p) > 1 and not p.strip(MARK)}
            if any(k > 1 for k in ties.values()) or ties.keys() & runs or not set().union(*self.ids) <= self.ids.keys():
                raise ValueError("merges of equal score, or pieces with characters that are not pieces")
        apart = not any(MARK in p.lstrip(MARK) or "\n" in p for p in self.ids)
        self.chunks = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n" if apart else r"(?s:.+)")
        self._forget()

    def _forget(self) -> None:
        self.memo: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.memo_chars = 0
        self.pairs: dict[int, dict[int, bool]] = {}
        self.n_pairs = 0

    def __getstate__(self):
        return self.__dict__ | {"memo": {}, "older": {}, "memo_chars": 0, "pairs": {}, "n_pairs": 0}

    # --- normaliser -------------------------------------------------------
    def mapped(self, text: str) -> str:
        """The text through the character map; what starts no entry is copied."""
        if self.first is None:
            return text
        out, at = [], 0
        while (m := self.first.search(text, at)) is not None:
            i = m.start()
            end, to = self.normaliser.longest(text, i) or (i + 1, text[i])
            out += (text[at:i], to)
            at = end
        return "".join([*out, text[at:]])

    def normalise(self, text: str) -> str:
        if not text:
            return ""
        text = self.mapped(text)
        if self.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
            if not text:
                return ""
        text = (MARK if self.prefix else "") + text.replace(" ", MARK)
        return text.rstrip(MARK) if self.squeeze else text

    # --- byte fallback ----------------------------------------------------
    def fallback(self, char: str) -> tuple[int, ...]:
        return tuple(self.byte[b] for b in char.encode()) if self.byte else (self.unk,)

    # --- bigram acceptor of BPE --------------------------------------------
    def merged(self, text: str) -> list[int]:
        """BPE by merging: best score first, leftmost of equals."""
        sym: list[str | None] = list(text)
        n = len(sym)
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        heap: list[tuple[float, int, int, str]] = []

        def offer(a: int, b: int) -> None:
            if a >= 0 and b >= 0 and (i := self.ids.get(both := sym[a] + sym[b])) is not None:
                heapq.heappush(heap, (-self.score[i], a, b, both))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, a, b, both = heapq.heappop(heap)
            if sym[a] is None or sym[b] is None or right[a] != b or sym[a] + sym[b] != both:
                continue
            sym[a], sym[b] = both, None
            right[a] = right[b]
            if right[b] >= 0:
                left[right[b]] = a
            offer(left[a], a)
            offer(a, right[a])
        return list(chain.from_iterable((self.ids[s],) if s in self.ids else self.fallback(s) for s in sym if s is not None))

    def follows(self, a: int, b: int) -> bool:
        """The acceptor's arc from piece a to piece b; a = -1: b starts a chunk or comes after fallback."""
        if self.n_pairs >= PAIRS:
            for known in self.pairs.values():
                known.clear()
            self.n_pairs = 0
        self.n_pairs += 1
        ok = self.pairs[a][b] = self.merged(self.piece.get(a, "") + self.piece[b]) == ([b] if a < 0 else [a, b])
        return ok

    # --- composition and shortest path --------------------------------------
    def shortest(self, text: str) -> tuple[int, ...]:
        """Shortest path through the composition with one chunk."""
        out = self.finite(text) if self.bpe else self.lightest(text)
        return tuple(chain.from_iterable((b,) if b >= 0 else self.fallback(text[end - 1]) for b, end in reversed(out)))

    def lightest(self, text: str) -> list[tuple[int, int]]:
        """Pieces and their ends of a unigram chunk, last first.

        A state is (place, state of the lexicon).  Arcs run forward, so one sweep over the
        places relaxes all; of equal paths the one whose last piece starts first is taken.
        """
        n, arc, output, score = len(text), self.lexicon.arc, self.lexicon.output, self.score
        codes = list(map(ord, text))
        weight, start, last = [0.0] + [INF] * n, [0] * (n + 1), [-1] * (n + 1)
        for i in range(n):
            w, at, single = weight[i], 0, False
            for j in range(i, n):
                at = arc.get(at << 21 | codes[j])
                if at is None:
                    break
                b = output[at]
                if b is not None:
                    single = single or j == i
                    if w - score[b] < weight[j + 1]:
                        weight[j + 1], start[j + 1], last[j + 1] = w - score[b], i, b
            if not single and w + self.unknown_cost < weight[i + 1]:  # byte fallback, a path of its own
                weight[i + 1], start[i + 1], last[i + 1] = w + self.unknown_cost, i, -1
        out, at = [], n
        while at:
            out.append((last[at], at))
            at = start[at]
        return out

    def finite(self, text: str) -> list[tuple[int, int]]:
        """Pieces and their ends of a BPE chunk, last first.

        A state is (place, state of the lexicon, last piece).  All arcs of finite weight
        weigh 0, so the first path found is the shortest: depth first, longest piece
        first.  A place is reached by one path at most, the encoding of that prefix, so
        no state is visited twice.
        """
        n, arc, output, pairs = len(text), self.lexicon.arc.get, self.lexicon.output, self.pairs
        codes = list(map(ord, text))
        i, a, path = 0, -1, None
        todo: list[tuple] = []
        while i < n:
            at = arc(codes[i])
            if at is None or output[at] is None:  # byte fallback: free to follow anything
                todo.append((i + 1, a, -1, path))
            for j in range(i + 1, n + 1):
                if at is None:
                    break
                if (b := output[at]) is not None:
                    todo.append((j, a, b, path))
                if j < n:
                    at = arc(at << 21 | codes[j])
            while todo:
                i, a, b, path = todo.pop()
                if b < 0:
                    break
                known = pairs.get(a)
                if known is None:
                    known = pairs[a] = {}
                ok = known.get(b)
                if self.follows(a, b) if ok is None else ok:
                    break
            else:
                raise ArithmeticError("no path of finite weight")
            a, path = b, (b, i, path)
        out = []
        while path is not None:
            out.append(path[:2])
            path = path[2]
        return out

    def encode(self, text: str, limit: int = MEMO) -> list[int]:
        parts = self.chunks.findall(self.normalise(text))
        memo = self.memo
        if len(memo) > limit or self.memo_chars > limit * CHARS:  # what is still in use moves on to the new generation
            self.older, self.memo, self.memo_chars = memo, (memo := {}), 0
        for p in set(parts):
            if p not in memo:
                memo[p] = self.older.get(p) or self.shortest(p)
                self.memo_chars += len(p)
        ids = list(chain.from_iterable(map(memo.__getitem__, parts)))
        if not self.byte and self.unk in ids:  # neighbouring unknown characters are one piece
            ids = [x for k, x in enumerate(ids) if x != self.unk or not k or ids[k - 1] != x]
        return ids

    def decode(self, ids: list[int]) -> bytes:
        out = b"".join(map(self.raw.__getitem__, ids)).replace(MARK.encode(), b" ")
        return out[1:] if self.prefix and out[:1] == b" " else out


_MODELS: dict[str, Model] = {}


def _own(sent) -> Model:
    """The worker's copy, with what it remembers of earlier tasks."""
    key, model = sent.value
    return _MODELS.setdefault(key, model)


def encoded(docs: DataFrame, path: str, with_ids: bool = True, memo: int = MEMO) -> DataFrame:
    """doc_id, n_bytes, n_tokens, ids_sha256 (of little-endian int32), round_trip[, ids].

    The model file is read on the driver; its tables (bounded by the vocabulary) are
    broadcast.  ``round_trip``: whether decoding the ids gives the text back.
    """
    with open(path, "rb") as f:
        data = f.read()
    sent = docs.sparkSession.sparkContext.broadcast((hashlib.sha256(data).hexdigest(), Model(data)))
    schema = T.StructType.fromDDL("doc_id long, n_bytes long, n_tokens long, ids_sha256 string, round_trip boolean" + ", ids array<int>" * with_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _own(sent)

        def told(rows: list[tuple], ids: list[np.ndarray]) -> pa.RecordBatch:
            cols = dict(zip(schema.names, map(list, zip(*rows, strict=True)), strict=False))
            if with_ids:
                at = np.concatenate([[0], np.cumsum(list(map(len, ids)))]).astype(np.int32)
                cols["ids"] = pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(ids))).cast(pa.list_(pa.int32()))
            return batch_of(schema, **cols)

        for b in batches:
            rows, held, size = [], [], 0
            for i, t in zip(b.column(0).to_pylist(), texts_of(b, "text"), strict=True):
                got = model.encode(t.decode(), memo)
                ids = np.array(got, dtype="<i4")
                rows.append((i, len(t), len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), model.decode(got) == t))
                held.append(ids)
                size += len(t)
                if size > GROUP_BYTES:
                    yield told(rows, held)
                    rows, held, size = [], [], 0
            if rows:
                yield told(rows, held)

    return pick(docs, doc_id="long", text="string").mapInArrow(released(run), schema)


def decoded(encodings: DataFrame, path: str) -> DataFrame:
    """doc_id, text of rows of (doc_id, ids); bytes that are no UTF-8 are replaced."""
    with open(path, "rb") as f:
        data = f.read()
    sent = encodings.sparkSession.sparkContext.broadcast((hashlib.sha256(data).hexdigest(), Model(data)))
    schema = T.StructType.fromDDL("doc_id long, text string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _own(sent)
        for b in batches:
            texts = [model.decode(x or []).decode("utf-8", "replace") for x in b.column(1).to_pylist()]
            yield batch_of(schema, doc_id=b.column(0), text=texts)

    return encodings.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>")).mapInArrow(run, schema)


def op6(spark, sf_dir) -> DataFrame:
    import public_tokenizers

    return encoded(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), with_ids=False)
