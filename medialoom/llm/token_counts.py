"""Exact token counts of whole texts, long ones by overlap resynchronisation.

A text longer than ``chunk`` characters is encoded as overlapping chunks with offsets.
Neighbouring chunks are spliced at a boundary proven stable: a token starts there in
both encodings and the character before is ASCII white space, which the normaliser and
the pre-tokenizer never join with anything.  When an overlap holds no such place, it is
doubled, up to the whole text.

The library's normaliser and pre-tokenizer take most of its time.  In a plain text (see
``LETTERS`` and ``MARKS``; no special string) the pieces that they give are known, so
each worker sends pieces to the library's model directly and keeps the counts of short
ones.

Other texts and chunks rest on the same boundary: their tokens are those of their words,
so each worker keeps the counts of short words that it has met (at most
``MEMO`` of them) and sends only new words, unless plain, to the library.  Chunks in which a
special string may be are encoded by the library as they are.

Defined cases: null text reads as empty (0 tokens); special strings in a text count as
the library's default has them; rows repeat as given; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from medialoom.llm.common import WS_CHARS, batch_of, pick, table, texts_of

CHUNK, OVERLAP, MEMO, LIMIT = 1 << 11, 1 << 7, 1 << 20, 2048
#: Longer pieces (characters) and words (bytes) are not kept: they rarely repeat, and the memos count entries.
KEPT = 64
_LOADED: dict[str, tuple] = {}

#: The normaliser and pre-tokenizer whose pieces ``PIECE`` finds in a plain text.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}
PRETOKENIZERS = [
    {"type": "Split", "pattern": SPLIT, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]
#: Letters (Latin, Greek, Cyrillic, Hebrew, Arabic, Hangul) that NFC leaves as they are and whose
#: lower case is one letter wherever they stand: not U+0130, not the capital sigma.
LETTERS = (
    r"A-Za-zÀ-ÖØ-öø-\u012f\u0131-\u017f\u0386\u0388-\u038a\u038c\u038e-\u03a1\u03a4-\u03ce"
    r"\u0400-\u045f\u05d0-\u05ea\u0621-\u063a\u0641-\u064a\uac00-\ud7a3"
)
#: What is neither letter, number nor white space: ASCII, Latin-1, Arabic, dashes and quotes, the euro.
MARKS = (
    r"!-/:-@\[-`{-~¡-©«-±´¶-¸»¿×÷"
    r"\u060c\u061b\u061f\u2010-\u2027\u20ac"
)
PLAIN = re.compile(f"[{WS_CHARS}0-9{MARKS}{LETTERS}]+")
#: White space too, which has no tokens, so that the pieces make up the text.
PIECE = re.compile(f"'(?:[stmd]|re|ve|ll)|[{LETTERS}]+|[{WS_CHARS}]+|[0-9]|[^{WS_CHARS}0-9{LETTERS}]+")
RUN = re.compile(f"[{WS_CHARS}]+|[^{WS_CHARS}]+")
#: The byte-level alphabet: printable bytes are themselves, the others follow U+0100.
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_LEVEL = dict(zip(sorted(set(range(256)) - set(_PRINTED)), range(256, 512)))


def load(path: str):
    """The tokenizer of a .json file, its memo of words and its pieces, once per worker."""
    if path not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        _LOADED[path] = (t, {}, plain_counter(t))
    return _LOADED[path]


class Pieces(dict):
    """Token counts of pieces by the model alone; called with a text, those of the text."""

    def __init__(self, model, known: bool):
        super().__init__()
        self.tokenize, self.known = model.tokenize, known

    def __missing__(self, piece: str) -> int:
        if piece[0] in WS_CHARS:
            n = 0
        else:
            n = len(self.tokenize(piece if piece.isascii() else piece.encode().decode("latin-1").translate(BYTE_LEVEL)))
        if len(piece) <= KEPT:
            if len(self) >= MEMO:
                self.clear()
            self[piece] = n
        return n

    def of(self, text: str) -> list[str] | None:
        """The pieces of a plain text; none where only the library's whole encoding tells."""
        if not self.known or "<|" in text or not PLAIN.fullmatch(text):  # a special string may be there
            return None
        return PIECE.findall(text.lower())

    def __call__(self, text: str) -> int | None:
        found = self.of(text)
        return None if found is None else sum(map(self.__getitem__, found))

    def encoded(self, text: str) -> Plain | None:
        found = self.of(text)
        return None if found is None else Plain([0, *accumulate(map(len, found))], [0, *accumulate(map(self.__getitem__, found))])


class Plain:
    """Encoding of a plain text: where its pieces start, and the tokens before each."""

    def __init__(self, starts: list[int], before: list[int]):
        self.starts, self.before = starts, before

    def __len__(self) -> int:
        return self.before[-1]

    def token_at(self, s: int) -> int | None:
        k = bisect_left(self.starts, s)
        if k + 1 < len(self.starts) and self.starts[k] == s and self.before[k] < self.before[k + 1]:
            return self.before[k]
        return None


def plain_counter(tok) -> Pieces:
    """The pieces of a tokenizer; none are known to one that normalises or splits in another way."""

    def parts(x) -> dict:
        return {} if x is None else json.loads(x.__getstate__())

    known = parts(tok.normalizer).get("normalizers") == NORMALIZERS and parts(tok.pre_tokenizer).get("pretokenizers") == PRETOKENIZERS
    return Pieces(tok.model, known)


def splices(tok, text: str, chunk: int = CHUNK, overlap: int = OVERLAP, pieces: Pieces | Words | None = None) -> Iterator[tuple]:
    """The tokens of a text, from overlapping chunks: (encoding, its start, first token, token behind the last)."""

    def encode(a: int, b: int) -> tuple:
        e = None if pieces is None else pieces.encoded(text[a:b])
        return tok.encode(text[a:b], add_special_tokens=False) if e is None else e, a

    def place(e, a: int, s: int) -> int | None:
        """The first token that starts at s."""
        if isinstance(e, Plain):
            return e.token_at(s - a)
        i = e.char_to_token(s - a)
        if i is None or e.token_to_chars(i)[0] != s - a:
            return None
        while i and e.token_to_chars(i - 1)[0] == s - a:  # of no width
            i -= 1
        return i

    left, at, first, end = encode(0, chunk), 0, 0, min(chunk, len(text))
    while end < len(text):
        wide = min(overlap, end - at)
        while True:
            start = end - wide
            nxt_end = min(len(text), start + wide + chunk)
            right = encode(start, nxt_end)
            for s in range(end - 1, start, -1):
                if text[s - 1] in WS_CHARS and (i := place(*left, s)) is not None and (j := place(*right, s)) is not None:
                    yield *left, first, i
                    left, at, first, end = right, s, j, nxt_end
                    break
            else:
                if wide < end - at:
                    wide = min(2 * wide, end - at)
                    continue
                # no stable place in all of what is left: double it instead
                end = min(len(text), 2 * end - at)
                left, first = encode(at, end), 0
            break
    yield *left, first, len(left[0])


def spliced(tok, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[tuple[int, int]]:
    """(id, start offset) of the tokens of a text, from overlapping chunks."""
    return [(x, a + s) for e, a, i, j in splices(tok, text, chunk, overlap) for x, (s, _) in zip(e.ids[i:j], e.offsets[i:j], strict=True)]


def word_counts(path: str, words: set[bytes]) -> dict[bytes, int]:
    """The memo, with at least these words in it."""
    tok, memo, plain = load(path)
    new = [w for w in words if w not in memo]
    if len(memo) + len(new) > MEMO:
        memo.clear()
        new = list(words)
    odd = []
    for w in new:
        n = plain(w.decode())
        if n is None:
            odd.append(w)
        else:
            memo[w] = n
    for k in range(0, len(odd), 4096):
        part = odd[k : k + 4096]
        memo.update(zip(part, (len(e.ids) for e in tok.encode_batch_fast([w.decode() for w in part], add_special_tokens=False)), strict=True))
    return memo


class Words:
    """Encodes chunks by pieces if plain, by counts of words if no special string may be there."""

    def __init__(self, path: str):
        self.path, self.pieces = path, load(path)[2]

    def encoded(self, text: str) -> Plain | None:
        e = self.pieces.encoded(text)
        if e is not None or "<|" in text:
            return e
        runs = RUN.findall(text)
        words = [w.encode().lower() for w in runs]
        new = {w for w in words if not w.isspace()}
        memo = word_counts(self.path, new)
        before = [0, *accumulate(0 if w.isspace() else memo[w] for w in words)]
        drop_long(memo, new)
        return Plain([0, *accumulate(map(len, runs))], before)


def drop_long(memo: dict[bytes, int], words: set[bytes]) -> None:
    for w in words:
        if len(w) > KEPT:
            del memo[w]


def fold(text: bytes) -> list[bytes]:
    """Words; A-Z folded, as the normaliser does, unless a special string may be there."""
    return (text if b"<|" in text else text.lower()).split()


def count(path: str, texts: list[bytes]) -> list[int]:
    tok, _, pieces = load(path)
    by_words = Words(path)
    out: list[int | None] = [None] * len(texts)
    group: list[tuple[int, list[bytes]]] = []
    size = 0

    def flush() -> None:
        words = set().union(*(w for _, w in group))
        memo = word_counts(path, words)
        for i, w in group:
            out[i] = sum(map(memo.__getitem__, w))
        drop_long(memo, words)
        group.clear()

    for i, t in enumerate(texts):
        s = t.decode()
        if len(s) > CHUNK:
            out[i] = sum(end - first for *_, first, end in splices(tok, s, pieces=by_words))
            continue
        out[i] = pieces(s)
        if out[i] is None:
            group.append((i, fold(t)))
            size += len(t)
        if size > 4_000_000:
            flush()
            size = 0
    flush()
    return out


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit."""
    schema = T.StructType.fromDDL("doc_id long, n_bytes long, n_tokens long, over_limit boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = texts_of(b, "text")
            n = count(path, texts)
            yield batch_of(schema, doc_id=b.column(0), n_bytes=list(map(len, texts)), n_tokens=n, over_limit=[x > limit for x in n])

    return pick(docs, doc_id="long", text="string").mapInArrow(run, schema)


def op8(spark, sf_dir) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
