"""Operators on single texts: quality rules, token counts, transducer, language model, chat."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import zlib

import pytest

pt = pytest.importorskip("public_tokenizers")

from medialoom.llm import chat, gated_network as net, piece_fst, quality, recurrent_lm, token_counts  # noqa: E402

WORD = re.compile("[^\x20\x09-\x0d]+")
ODD = [None, "", " \t\n\x0b\x0c\r", "a", "a b c a b c a b c", "x y z é\n\né\n", "<|endoftext|> <|ENDOFTEXT|> a'll 123", "### $$$ | < >\n### $$$ | < >", "日本 😀 ▁ \x00", "w " * 30000, "one two three. " * 40]


def odd_docs(spark):
    rows = [(i if i != 3 else None, t, "z") for i, t in enumerate(ODD)] + [(5, ODD[5], "z")]
    return spark.createDataFrame(rows, "doc_id long, text string, words string")


def by_text(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def base(text):
    w = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    tri = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    c = collections.Counter(tri)
    cover = {i + k for i, g in enumerate(tri) if c[g] > 1 for k in range(3)}
    return len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in text or ""), len(lines) - len(set(lines)), len(cover), len(w) < 50 or 100 * len(cover) > 50 * len(w)


def test_quality_figures(spark):
    got = quality.judged(odd_docs(spark))
    rows = [(r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got.collect()]
    assert collections.Counter(rows) == collections.Counter([base(t) for t in ODD] + [base(ODD[5])])
    assert quality.judged(odd_docs(spark).limit(0)).count() == 0


def test_quality_rules(spark):
    prose = " ".join(f"Word{i} stands{i} here, with others{i}." for i in range(30))
    nav = "Home | About | News | Shop | Login | Help"
    texts = {1: prose, 2: prose + "\n" + nav, 3: "\n".join([nav + str(i) for i in range(30)]), 4: " ".join(f"w{i}### x{i}$$$" for i in range(60)), 5: " ".join(f"LOUD{i}!!" for i in range(60)), 6: prose + "\nSign in to read more."}
    d = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    r = {x.doc_id: x for x in quality.judged(d).collect()}
    assert [r[i].kept for i in range(1, 7)] == [True, True, False, False, False, True]
    assert r[2].n_lines_removed == r[6].n_lines_removed == 1 and r[2].clean_text == prose
    kept = {x.doc_id: x for x in quality.clean(d.selectExpr("doc_id", "text", "length(text) AS n_chars", "'q' AS row")).collect()}
    assert set(kept) == {1, 2, 6} and kept[2].text == prose and kept[2].n_chars == len(prose) and kept[1].row == "q"


def fails(line):
    """The rules, one line at a time."""
    tokens = len(WORD.findall(line))
    marks = sum(x in quality.NAV_MARKS for x in line)
    ended = re.search(f"[{quality.END_MARKS}][{re.escape(quality.CLOSING)}]*$", line[-4:])
    phrase = any(re.search(rf"(^|[^\\w]|_){p}($|[^\\w]|_)", line.lower()) for p in quality.PHRASES)
    return not ended or (tokens > 3 and 3 * marks >= tokens) or 12 * sum(x in quality.SYMBOLS for x in line) > len(line) or (tokens > 3 and line.upper() == line != line.lower()) or (len(line) <= 200 and phrase)


def test_quality_verdict_against_plain_rules(spark):
    r = random.Random(12)
    ends = [".", "!", "", ".”", "?)", " |", "…", "。", ";'", ".\"') x"]
    parts = ["Some words stand here", "HOME AGAIN HERE NOW", "a | b | c | d", "Read More", "### $$$", "x\ty\x0bz", "log  in", "logging in to it", "Iniciar Sesión ahora", "prose\u00a0with\u3000other spaces", "é" * 30, "_subscribe_"]
    texts = ["\n".join(" ".join(r.choice(parts) for _ in range(r.randint(1, 12))) + r.choice(ends) + r.choice(["", " ", "\r"]) for _ in range(r.randint(0, 14))) for _ in range(300)]
    menu = "\n".join(f"Item number {i}" for i in range(60))
    d = spark.createDataFrame(list(enumerate([*texts, menu, *ODD])), "doc_id long, text string")
    for x in d.join(quality.judged(d), "doc_id").collect():
        lines = [y.strip(" \t\n\x0b\x0c\r") for y in (x.text or "").split("\n")]
        lines = [y for y in lines if y]
        good = [y for y in lines if not fails(y)]
        chars = sum(len(w) for y in good for w in WORD.findall(y))
        failed = base(x.text)[-1]
        assert (x.n_lines, x.n_lines_removed, x.kept_chars) == (len(lines), len(lines) - len(good), chars), x.text
        assert x.kept == (not failed and 100 * chars >= 50 * x.word_chars)
        assert x.text != menu or (x.n_lines_removed == 60 and not x.kept)


def test_quality_is_native(spark):
    plan = quality.judged(odd_docs(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


@pytest.fixture(scope="module")
def bpe():
    return pt.path("word_bpe_49k.json")


def test_token_counts(spark, bpe):
    tok = token_counts.load(bpe)[0]
    want = sorted((len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False).ids)) for t in [*ODD, ODD[5]])
    got = token_counts.token_counts(odd_docs(spark), bpe).collect()
    assert sorted((r.n_bytes, r.n_tokens) for r in got) == want and all(r.over_limit == (r.n_tokens > 2048) for r in got)
    assert token_counts.token_counts(odd_docs(spark).limit(0), bpe).count() == 0


def test_splicing_equals_whole_encoding(bpe):
    tok, r = token_counts.load(bpe)[0], random.Random(5)
    for _ in range(60):
        s = "".join(r.choice(["a", "b'll", " ", "  ", "é", "\n", "123", "<|endoftext|>", "x" * 50, "　", "-_-"]) for _ in range(r.randint(0, 200)))
        assert [i for i, _ in token_counts.spliced(tok, s, r.randint(5, 60), r.randint(1, 9))] == tok.encode(s, add_special_tokens=False).ids


def test_splices_count_what_they_yield(bpe):
    tok, r = token_counts.load(bpe)[0], random.Random(6)
    for _ in range(60):
        s = "".join(r.choice(["a", "İ", "e\u0301", "\u0301", " ", "\t\n", "क़", "12", "<|endoftext|>", "y" * 40, "日本", "\u3000", "'s"]) for _ in range(r.randint(0, 200)))
        parts = list(token_counts.splices(tok, s, r.randint(5, 60), r.randint(1, 9)))
        assert sum(j - i for *_, i, j in parts) == len(tok.encode(s, add_special_tokens=False).ids)


def test_pieces_of_plain_words_equal_library(bpe):
    tok, _, plain = token_counts.load(bpe)
    letters = [c for c in map(chr, range(0x21, 0x460)) if token_counts.PLAIN.fullmatch(c)]
    words = [w for c in letters for w in (c, f"a{c}b", f"A{c}.{c}1'", f"'{c}{c}", f"{c}'LL{c}--'s{c}12")]
    r = random.Random(7)
    words += ["".join(r.choices([*letters, "'", "'re", "-", "#", "9"], k=r.randint(1, 30))) for _ in range(3000)]
    words = [w for w in words if "<|" not in w]
    assert [plain(w) for w in words] == [len(e) for e in tok.encode_batch(words, add_special_tokens=False)]
    assert [plain(w) for w in ["<|endoftext|>", "İ", "e\u0301", "a\u00a0b", "½", "日", "\x1c", ""]] == [None] * 8


def test_library_encodes_few_new_words(bpe, monkeypatch):
    """Its normaliser and pre-tokenizer cost more than its model: plain words go to the model alone."""
    tok, _, plain = token_counts.load(bpe)
    sent = []

    class Counting:
        def encode_batch_fast(self, words, **how):
            sent.extend(words)
            return tok.encode_batch_fast(words, **how)

    monkeypatch.setitem(token_counts._LOADED, bpe, (Counting(), {}, plain))
    texts = ["Erste Wörter, l'été!! 12$", "Привет don't 日本 İstanbul", "<|endoftext|> A"]
    want = [len(tok.encode(t, add_special_tokens=False).ids) for t in texts]
    assert token_counts.count(bpe, [t.encode() for t in texts]) == want
    assert sorted(sent) == sorted(["日本", "İstanbul", "<|endoftext|>"])


def test_every_plain_character_is_split_as_the_library_splits_it(bpe):
    import unicodedata

    tok, _, plain = token_counts.load(bpe)
    known = [c for c in map(chr, [*range(0xD800), *range(0xE000, 0x10000)]) if token_counts.PLAIN.fullmatch(c)]
    texts = [w for c in known for w in (f"{c}.{c} {c}{c}", f"a{c}b{c}1'")]
    assert [plain(w) for w in texts] == [len(e) for e in tok.encode_batch(texts, add_special_tokens=False)]
    assert all(unicodedata.is_normalized("NFC", f"{a}{c}") for c in known for a in "aΑ가ا") and all(len(f"A{c}".lower()) == 2 for c in known)
    assert token_counts.PLAIN.fullmatch("\u03a3") is None and plain("ΑΣ.") is None


def test_plain_and_other_chunks_splice(bpe):
    """Chunks of pieces, chunks of the library and both beside each other give the library's count."""
    tok, _, pieces = token_counts.load(bpe)
    r, kinds = random.Random(8), collections.Counter()
    plain = ["a", "B'LL", " ", "  ", "\r\n", "été", "ÉTÉ.", "x" * 50, "--", "12", "don't", "“q”", "가나", "Ж"]
    odd = ["日本", "\u0301", "<|endoftext|>", "<|", "\u3000", "½", "ΑΣ", "\x1c"]
    for n in range(300):
        s = "".join(r.choice(odd if r.random() < (n % 3) / 20 else plain) for _ in range(r.randint(0, 200)))
        parts = list(token_counts.splices(tok, s, r.randint(5, 60), r.randint(1, 9), pieces))
        kinds.update(type(e).__name__ for e, *_ in parts)
        assert sum(j - i for *_, i, j in parts) == len(tok.encode(s, add_special_tokens=False).ids), s
    assert min(kinds["Plain"], kinds["Encoding"]) > 300


def test_texts_over_a_chunk_are_spliced(bpe, monkeypatch):
    """Also of a few thousand characters, most of all text, not only the rarest."""
    tok, _, pieces = token_counts.load(bpe)
    texts = ["Erste Wörter, l'été!! 12$ " * 100, "日本 the " * 400, "x" * 5000, "kurz"]
    used, splices = [], token_counts.splices
    monkeypatch.setattr(token_counts, "splices", lambda tok, s, **how: used.append(len(s)) or splices(tok, s, **how))
    assert token_counts.count(bpe, [t.encode() for t in texts]) == [len(tok.encode(t, add_special_tokens=False).ids) for t in texts]
    assert used == [len(t) for t in texts[:3]]
    assert max(map(len, pieces)) <= token_counts.KEPT


def test_words_of_chunks_equal_library(bpe, monkeypatch):
    """One odd character does not send its chunk to the library, only its word."""
    tok, _, pieces = token_counts.load(bpe)
    memo, r = {}, random.Random(9)
    monkeypatch.setitem(token_counts._LOADED, bpe, (tok, memo, pieces))
    words = token_counts.Words(bpe)
    assert len(words.encoded("Plain words \U0001f600 and'll more")) == len(tok.encode("Plain words \U0001f600 and'll more", add_special_tokens=False).ids)
    assert words.encoded("a <| b 日") is None and "\U0001f600".encode() in memo
    kinds = ["a", "B'LL", " ", "  ", "\r\n", "ÉTÉ.", "x" * 50, "12", "日本", "\u0301", "<|endoftext|>", "<|", "\u3000", "\u00a0", "½", "ΑΣ", "\x1c", "\x85", "İ", "\U0001f600"]
    for n in range(300):
        s = "".join(r.choice(kinds if n % 2 else kinds[:10]) for _ in range(r.randint(0, 200)))
        parts = token_counts.splices(tok, s, r.randint(5, 60), r.randint(1, 9), words)
        assert sum(j - i for *_, i, j in parts) == len(tok.encode(s, add_special_tokens=False).ids), s
    assert max(map(len, memo)) <= token_counts.KEPT


def test_long_words_are_not_kept(bpe, monkeypatch):
    """Unspaced texts are words of up to a chunk, which would fill a worker's memory."""
    tok, _, pieces = token_counts.load(bpe)
    memo = {}
    monkeypatch.setitem(token_counts._LOADED, bpe, (tok, memo, pieces))
    texts = ["日本語" * 300, "日本 " + "語" * 40 + " 日本", "é́ " + "y" * 100, "日本語" * 300]
    assert token_counts.count(bpe, [t.encode() for t in texts]) == [len(tok.encode(t, add_special_tokens=False).ids) for t in texts]
    assert set(memo) == {"日本".encode(), "é́".encode()}


def test_unspaced_text_is_encoded_a_few_times_only(bpe):
    tok, done = token_counts.load(bpe)[0], []

    class Counting:
        def encode(self, text, **how):
            done.append(len(text))
            return tok.encode(text, **how)

    s = "日本語" * 4000 + " " + "x" * 3000
    assert sum(j - i for *_, i, j in token_counts.splices(Counting(), s, 64, 8)) == len(tok.encode(s, add_special_tokens=False).ids)
    assert sum(done) < 12 * len(s)


def test_other_tokenizers_know_no_pieces(bpe):
    from tokenizers import Tokenizer, normalizers

    tok = Tokenizer.from_file(bpe)
    assert token_counts.plain_counter(tok)("a") == 1
    tok.normalizer = normalizers.NFC()
    assert token_counts.plain_counter(tok)("a") is None


def test_transducer_equals_library():
    import sentencepiece

    path = pt.path("piece_bpe_32k.model")
    with open(path, "rb") as f:
        m = piece_fst.Model(f.read())
    sp, r = sentencepiece.SentencePieceProcessor(model_file=path), random.Random(2)
    pieces = [p.replace("▁", " ") for p in m.ids]
    for t in [x or "" for x in ODD if x is None or len(x) < 5000] + ["".join(r.choice(pieces) for _ in range(r.randint(1, 9))) for _ in range(3000)]:
        ids = m.encode(t)
        assert ids == sp.encode(t)
        assert m.decode(ids).decode() == t.replace("▁", " ")


def test_runs_of_marks_take_the_shortest_path():
    import sentencepiece

    path = pt.path("piece_bpe_32k.model")
    with open(path, "rb") as f:
        m = piece_fst.Model(f.read())
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    for k in range(52):
        for w in ["", "the", "!", "é", "\U0001f600", "hello!!", "▁a", "\n", "a" + " " * 17 + "b"]:
            assert m.encode(" " * k + w) == sp.encode(" " * k + w)


@pytest.mark.parametrize("rule", ["nfkc", "nmt_nfkc_cf"])
@pytest.mark.parametrize("bytes_of_unknown", [True, False])
@pytest.mark.parametrize("kind", [1, 2])
def test_character_maps_equal_library(rule, bytes_of_unknown, kind):
    """The same pieces under the library's own character maps, as a unigram and as a BPE model."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    r, m, n = random.Random(kind), pb.ModelProto(), pb.ModelProto()
    with open(pt.path("piece_bpe_32k.model"), "rb") as f:
        m.ParseFromString(f.read())
    n.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto())
    m.normalizer_spec.CopyFrom(n.normalizer_spec)
    m.normalizer_spec.remove_extra_whitespaces = kind == 1
    m.trainer_spec.byte_fallback, m.trainer_spec.model_type = bytes_of_unknown, kind
    pieces = [p for p in m.pieces if bytes_of_unknown or p.type != 6]
    del m.pieces[:]
    m.pieces.extend(pieces)
    for p in m.pieces if kind == 1 else []:
        p.score = -1 - 12 * r.random() if p.type == 1 else p.score
    x, lib = piece_fst.Model(m.SerializeToString()), sentencepiece.SentencePieceProcessor(model_proto=m.SerializeToString())
    norm = sentencepiece.SentencePieceNormalizer(model_proto=m.SerializeToString())
    pool = ["a", "e\u0301", "ﬁ", "①", "\u3000", "  ", " ", "¨", "Ａ", "ß", "\u200b", "\n", "\t", "\x01", "한", "\u1100\u1161", "😀", "the", "▁", "ｶﾞ", "İ"]
    for _ in range(800):
        t = "".join(r.choice(pool) for _ in range(r.randint(0, 12)))
        assert x.normalise(t) == norm.normalize(t)
        assert x.encode(t) == lib.encode(t)


def test_what_is_not_compiled_is_refused():
    from sentencepiece import sentencepiece_model_pb2 as pb

    def model(kind: int, pieces: list[tuple[str, float, int]]) -> bytes:
        m = pb.ModelProto()
        m.trainer_spec.model_type = kind
        for p, s, t in [("<unk>", 0, 2), ("a", -1, 1), ("b", -2, 1), *pieces]:
            m.pieces.add(piece=p, score=s, type=t)
        return m.SerializeToString()

    for bad in [model(3, []), model(1, [("<sep>", 0, 4)]), model(2, [("ab", -3, 1), ("ba", -3, 1)]), model(2, [("ab", -3, 5)])]:
        with pytest.raises(ValueError):
            piece_fst.Model(bad)


def test_very_long_text_without_spaces():
    import sentencepiece

    path = pt.path("piece_bpe_32k.model")
    with open(path, "rb") as f:
        m = piece_fst.Model(f.read())
    t = "".join(random.Random(9).choices("abcdefé٣", k=60_000))
    assert m.encode(t) == sentencepiece.SentencePieceProcessor(model_file=path).encode(t)


def test_transducer_in_spark(spark):
    path = pt.path("piece_bpe_32k.model")
    d = odd_docs(spark)
    e = piece_fst.encoded(d, path)
    assert e.count() == len(ODD) + 1
    back = by_text(piece_fst.decoded(e, path))
    assert back == sorted(((r.doc_id, (r.text or "").replace("▁", " ")) for r in d.collect()), key=str)
    assert piece_fst.encoded(d.limit(0), path).count() == 0


def test_unigram_model_takes_the_best_path(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    m.trainer_spec.model_type, m.normalizer_spec.add_dummy_prefix, m.normalizer_spec.remove_extra_whitespaces = 1, False, False
    for p, s, t in [("<unk>", 0, 2), ("a", -1, 1), ("b", -1, 1), ("ab", -1.5, 1), ("abb", -4, 1)]:
        m.pieces.add(piece=p, score=s, type=t)
    x = piece_fst.Model(m.SerializeToString())
    assert x.encode("abb") == [3, 2] and x.encode("ba") == [2, 1]


def test_language_model(spark):
    r, en, fr = random.Random(1), ["the", "of", "and", "to", "in"], ["le", "la", "de", "et", "un"]
    texts = [" ".join(r.choice(en if i % 2 else fr) for _ in range(r.randint(5, 60))) for i in range(600)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "the x"), (700, None), (701, ""), (3, texts[3])]
    got = recurrent_lm.score(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    tok = {i: (t or "").lower().split() + ["\n"] for i, t in rows}
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0
    c = collections.Counter(w for i, t in rows if not held(i) for w in (t or "").lower().split() + ["\n"])
    n, v = sum(c.values()), len(c)
    assert len(got) == len(rows)
    for x in got:
        want = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tok[x.doc_id])
        assert x.held_out == held(x.doc_id) and x.n_tokens == len(tok[x.doc_id]) and x.train_tokens == n
        assert x.n_known == sum(c[w] > 0 for w in tok[x.doc_id]) and math.isclose(x.base_score, want, rel_tol=1e-9) and x.score < 0
    h = [x for x in got if x.held_out]
    assert sum(x.score for x in h) > sum(x.base_score for x in h)  # held-out text is likelier under the recurrent model


def naive_likelihood(p, codes, end):
    """One word after the other, in plain loops."""
    import numpy as np

    soft = lambda x: np.exp(x - x.max()) / np.exp(x - x.max()).sum()
    h, before, out = np.zeros(net.HIDDEN), end, 0.0
    for c in codes:
        a = np.tanh(p["E"][before] + h @ p["U"])
        keep = (1 + a[: net.HIDDEN]) / 2
        h = keep * h + (1 - keep) * a[net.HIDDEN :]
        k, s = divmod(int(c), net.SLOTS)
        out += math.log(soft(h @ p["Wc"] + p["bc"])[k]) + math.log(soft(h @ p["Ws"][k] + p["bs"][k])[s])
        before = c
    return out


def random_network(seed=0):
    import numpy as np

    r = np.random.default_rng(seed)
    return {k: (v + r.normal(0, 0.3, v.shape)).astype(np.float32) for k, v in net.start(np.ones(net.CODES)).items()}


def test_language_model_likelihood_is_that_of_plain_loops():
    import numpy as np

    r, p, end = np.random.default_rng(1), random_network(), 7
    docs = [np.append(r.integers(8, net.CODES, n), end) for n in (0, 1, 5, 40, 3 * net.STEPS + 5, 300, 0, 9)]
    got = net.log_likelihood(p, docs, end)
    assert all(math.isclose(x, naive_likelihood(p, d, end), rel_tol=1e-4) for x, d in zip(got, docs, strict=True))
    many = net.log_likelihood(p, docs * 60, end)  # several documents a lane: the state starts anew
    assert np.allclose(many, np.tile(got, 60), rtol=1e-4)
    every = [net.log_likelihood(p, [np.array([9, k])], end)[0] for k in range(net.CODES)]
    assert math.isclose(sum(math.exp(x - net.log_likelihood(p, [np.array([9])], end)[0]) for x in every), 1.0, rel_tol=1e-3)


def test_language_model_gradient():
    import numpy as np

    r, end = np.random.default_rng(3), 5
    p = random_network(2)
    docs = [np.append(r.integers(6, net.CODES, 12), end) for _ in range(3)]
    t, n = net.Trainer(p), sum(map(len, docs))
    before, want, doc, live = next(net.windows(docs, end))
    g, seen, rows, _ = t.gradient(before, want, doc >= 0, np.zeros((live, net.HIDDEN), dtype=np.float32), end)
    g["E"] = np.zeros_like(p["E"])
    g["E"][seen] = rows
    wide = {k: v.astype(np.float64) for k, v in p.items()}
    for k in p:
        at = np.unravel_index(np.argmax(np.abs(g[k])), p[k].shape)
        found = []
        for step in (1e-4, -1e-4):
            q = {m: v.copy() for m, v in wide.items()}
            q[k][at] += step
            found.append(sum(naive_likelihood(q, d, end) for d in docs))
        assert math.isclose(-(found[0] - found[1]) / 2e-4 / n, g[k][at], rel_tol=0.01), k


def test_language_model_score_and_partitions(spark, monkeypatch):
    """The score against a word-by-word evaluation of the trained model, whatever the partitions."""
    import numpy as np
    import xxhash

    monkeypatch.setattr(recurrent_lm, "UNIT", 400)
    monkeypatch.setattr(recurrent_lm, "VOCABULARY", 60)  # several vocabularies a task
    monkeypatch.setattr(recurrent_lm, "HEAD", 40)
    r = random.Random(11)
    rows = [(i, " ".join(f"w{min(int(r.paretovariate(0.6)), 90)}" for _ in range(r.randint(0, 60)))) for i in range(120)]
    models = []
    train = recurrent_lm.train
    monkeypatch.setattr(recurrent_lm, "train", lambda *a: models.append((train(*a), a[3])) or models[-1][0])
    scores = []
    for n in (1, 5):
        got = {x.doc_id: x for x in recurrent_lm.score(spark.createDataFrame(rows, "doc_id long, text string").repartition(n)).collect()}
        scores.append([got[i].score for i, _ in rows])
    assert np.allclose(scores[0], scores[1], rtol=1e-4)
    p, end = models[0]
    held = lambda i: zlib.crc32(str(i).encode()) % 10 == 0
    tok = {i: t.encode().split() + [b"\n"] for i, t in rows}
    c = collections.Counter(w for i in tok if not held(i) for w in tok[i])
    top = sorted(c, key=lambda w: (-c[w], w))[:40]
    signed = lambda h: h - 2**64 if h >= 2**63 else h
    code = {w: recurrent_lm.place(k) for k, w in enumerate(top)}
    for w in {w for ws in tok.values() for w in ws} - set(top):
        code[w] = signed(xxhash.xxh64_intdigest(w[-3:], 42)) % net.CLASSES * net.SLOTS + net.SLOTS - 1
    mass = collections.Counter()
    for w in c:
        if w not in top:
            mass[code[w]] += c[w] + 0.1
    for i, ws in tok.items():
        inside = sum(math.log10((c[w] + 0.1) / (mass[code[w]] + 0.1)) for w in ws if w not in top)
        assert math.isclose(scores[0][i], naive_likelihood(p, [code[w] for w in ws], end) / math.log(10) + inside, rel_tol=1e-4)


def test_language_model_empty(spark):
    assert recurrent_lm.score(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_chat_escapes():
    import re as _re

    java = lambda s: _re.sub(chat.ESCAPE[0], r"\1\\\2\3", s)
    r = random.Random(4)
    for _ in range(3000):
        s = "".join(r.choice(["<", "s>", "</s>", "[", "INST]", "/INST]", "\\", "a", "<s>", "[/INST]"]) for _ in range(r.randint(0, 8)))
        e = java(s)
        assert chat.unescape(e) == s and not _re.search(r"</?s>|\[/?INST\]", e)


def test_chat_tree(spark):
    rows = [(1, 1, None, "user", "hi", 1.0), (1, 2, 1, "assistant", "a</s>", 5.0), (1, 3, 1, "assistant", "b", 1.0), (1, 4, 2, "user", None, 0.0), (2, 1, None, None, "<s>", None), (None, 1, None, "user", "n", 0.0), (3, 5, 99, "user", "orphan", 0.0), (3, 5, 99, "user", "orphan", 0.0)]
    m = spark.createDataFrame(rows, "tree_id long, msg_id long, parent_id long, role string, text string, score double")
    got = {(r.tree_id, r.leaf_id): r for r in chat.format_trees(m).collect()}
    assert set(got) == {(1, 4), (1, 3), (2, 1), (None, 1), (3, 5)}
    assert chat.parse(got[1, 4].formatted) == [("user", "hi"), ("assistant", "a</s>"), ("user", "")]
    assert got[1, 4].path_rank == 1 and got[1, 3].path_rank == 2
    s = got[1, 4].loss[0]
    assert chat.unescape(got[1, 4].formatted[s["start"] : s["end"]]) == "a</s>" and len(got[1, 4].loss) == 1
    assert chat.parse(got[2, 1].formatted) == [("", "<s>")]
    assert {(r.tree_id, r.leaf_id) for r in chat.format_trees(m, best=1).where("tree_id = 1").collect()} == {(1, 4)}
    assert chat.format_trees(m.limit(0)).count() == 0


def test_chat_long_chain_and_read_back(spark):
    n = 70
    m = spark.range(1, n + 1).selectExpr("7L AS tree_id", "id AS msg_id", "CASE WHEN id > 1 THEN id - 1 END AS parent_id", "CASE WHEN id % 2 = 0 THEN 'assistant' ELSE 'user' END AS role", "concat('t', id) AS text", "0.0D AS score")
    r = chat.read_back(chat.format_trees(m)).first()
    said = "".join(f"{'assistant' if i % 2 == 0 else 'user'}\nt{i}\n" for i in range(1, n + 1))
    loss = "".join(f"t{i}" for i in range(2, n + 1, 2))
    assert (r.n_turns, r.turns_sha256) == (n, hashlib.sha256(said.encode()).hexdigest())
    assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_chat_cycle(spark):
    m = spark.createDataFrame([(1, 1, 2, "u", "a", 0.0), (1, 2, 1, "u", "b", 0.0)], "tree_id long, msg_id long, parent_id long, role string, text string, score double")
    chat.MAX_ROUNDS, old = 4, chat.MAX_ROUNDS
    try:
        with pytest.raises(ValueError, match="cycle"):
            chat.paths(m).count()
    finally:
        chat.MAX_ROUNDS = old
