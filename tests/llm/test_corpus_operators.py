"""Operators over the whole table, against brute force on small tables."""

from __future__ import annotations

import base64
import collections
import hashlib
import os
import random
import re

import duckdb
import numpy as np
import pytest
import xxhash

from medialoom.llm import chat, decontaminate, licenses, queries, simhash, substring, warc
from medialoom.llm.components import connected_components

from ..conftest import DATA


def groups_of(nodes, linked):
    parent = {n: n for n in nodes}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_components(spark):
    r = random.Random(1)
    pairs = [(r.randint(0, 60), r.randint(0, 60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 140)] + [(5, 5), (5, 5)]
    got = {x.node: x.label for x in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    both = {(a, b) for a, b in pairs} | {(b, a) for a, b in pairs}
    nodes = {n for a, b in pairs if a != b for n in (a, b)}
    assert got == groups_of(nodes, lambda a, b: (a, b) in both)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_fingerprint(text, width):
    w = (text or "").encode().lower().split()
    s = [b" ".join(w[i : i + width]) for i in range(len(w) - width + 1)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x, seed=42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(spark):
    r = random.Random(2)
    base = [" ".join(r.choice("abcdefghij") + r.choice("xyz") for _ in range(60)) for _ in range(6)]
    texts = [*base, base[0], base[1].upper(), base[2] + " more", None, "", " \n", "one", "one two", "É é"]
    for t in base[:3]:
        for _ in range(5):
            w = t.split()
            w[r.randrange(60)] = "new"
            texts.append(" ".join(w))
    rows = [(i * 3 + 7, t, i) for i, t in enumerate(texts)] + [(7, texts[0], -1)]
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, fp int"), width=3).collect()
    fp = {i: brute_fingerprint(t, 3) for i, t, _ in rows}
    want = groups_of(fp, lambda a, b: (fp[a] ^ fp[b]).bit_count() <= 2)
    assert len(got) == len(rows) and all(x.fp % 2**64 == fp[x.doc_id] and x.component_id == want[x.doc_id] for x in got)
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("dense", [0, 3, 32])
def test_simhash_links_on_planted_fingerprints(spark, dense):
    r = random.Random(3)
    center = r.getrandbits(64)
    fps = {center, 0, 2**64 - 1, 2**63} | {center ^ (1 << a) ^ (1 << b) ^ (1 << c) for a, b, c in ([r.randrange(64) for _ in range(3)] for _ in range(60))} | {r.getrandbits(64) for _ in range(60)}
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    fps |= {center ^ (b << 32) for b in (r.getrandbits(32) & r.getrandbits(32) & r.getrandbits(32) for _ in range(80))}  # one segment in common
    pairs = simhash.links(spark.createDataFrame([(signed(x),) for x in fps], "fp long"), dense)
    got = {x.node: x.label for x in connected_components(pairs).collect()}
    s = {signed(x) for x in fps}
    want = groups_of(s, lambda a, b: ((a ^ b) % 2**64).bit_count() <= 2)
    sizes = collections.Counter(want.values())
    assert got == {n: g for n, g in want.items() if sizes[g] > 1}
    assert all(0 < ((x.a ^ x.b) % 2**64).bit_count() <= 2 for x in pairs.collect())


def test_simhash_never_broadcasts_look_ups(spark):
    pairs = simhash.links(spark.createDataFrame([(k,) for k in range(50)], "fp long"))
    joins = re.findall(r"(\w+Join) \[([^\]]*)\]", pairs._jdf.queryExecution().sparkPlan().toString())
    by_value = {kind for kind, keys in joins if re.search(r"value#\d+L?", keys) and "mid" not in keys}
    assert by_value == {"SortMergeJoin"}


def test_simhash_keeps_one_of_a_group(spark):
    d = spark.createDataFrame([(3, "a b c d e f", "k"), (1, "a b c d e f", "k"), (2, "other words are here now yes", None), (None, "a b c d e f", "k")], "doc_id long, text string, component_id string")
    assert sorted((str(r.doc_id), r.component_id) for r in simhash.drop_near_duplicates(d).collect()) == [("1", "k"), ("2", None), ("None", "k")]


def brute_removed(rows, width):
    first = {}
    for i, t in rows:
        w = (t or "").encode().split()
        for k in range(len(w) - width + 1):
            key, at = tuple(w[k : k + width]), (float("inf") if i is None else i, k)
            first[key] = min(first.get(key, at), at)
    out = []
    for i, t in rows:
        w = (t or "").encode().split()
        gone = set()
        for k in range(len(w) - width + 1):
            if first[tuple(w[k : k + width])] < (float("inf") if i is None else i, k):
                gone |= set(range(k, k + width))
        kept = [x for k, x in enumerate(w) if k not in gone]
        out.append((i, len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("width", [1, 3, 20])
def test_substring(spark, width, monkeypatch):
    monkeypatch.setattr(substring, "BLOCK", 200)  # several blocks, so that merging is exercised
    r = random.Random(width)
    words = [f"w{k}" for k in range(40)]
    texts = [" ".join(r.choice(words) for _ in range(r.randint(0, 70))) for _ in range(40)]
    texts += [texts[3], texts[4] + " " + texts[4], None, "", " \t", "É é\nx  y", "same " * 60]
    rows = [(None if i == 11 else i * 7 - 60, t) for i, t in enumerate(texts)] + [(1, texts[9]), (1, texts[9])]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((tuple(x) for x in substring.removed(d, width).collect()), key=str)
    assert got == brute_removed(rows, width)


def test_substring_remove(spark):
    t = " ".join(f"w{k}" for k in range(30))
    d = spark.createDataFrame([(1, t, 5, "a"), (2, t, 5, "b"), (3, "x  y\n" + t, 5, "c"), (4, None, 5, "d")], "doc_id long, text string, n_chars long, bucket string")
    got = {r.doc_id: r for r in substring.remove(d).collect()}
    assert set(got) == {1, 3, 4} and got[1].text == t and got[3].text == "x y" and got[3].n_chars == 3 and got[3].bucket == "c"
    assert substring.removed(d.limit(0)).count() == 0


def test_sketch_never_underestimates(spark):
    r = random.Random(8)
    d = spark.createDataFrame([(i, " ".join(r.choice("abcdef") for _ in range(50))) for i in range(40)], "doc_id long, text string")
    n = 1 << substring.SHARD_BITS
    bits = substring.sketch(d, 3, n)
    h = np.concatenate([substring.window_hashes(np.fromiter((xxhash.xxh3_64_intdigest(w) for w in x.text.encode().split()), dtype=np.uint64), 3, 0) for x in d.collect()])
    value, count = np.unique(h, return_counts=True)
    assert substring.estimated_repeated(bits, value[count > 1], n).all() and (count > 1).any()


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row[-1]


def test_closest_stretch():
    r = random.Random(6)
    for _ in range(200):
        a, b = [r.randint(0, 3) for _ in range(r.randint(1, 9))], [r.randint(0, 3) for _ in range(r.randint(0, 14))]
        got, s, e = decontaminate.closest(a, b)
        assert got == min(edit_distance(a, b[i:j]) for i in range(len(b) + 1) for j in range(i, len(b) + 1)) == edit_distance(a, b[s:e])


def edited(words, k, r, vocab):
    v = list(words)
    for _ in range(k):
        how, p = r.random(), r.randrange(len(v))
        if how < 0.4:
            v[p] = r.choice(vocab)
        elif how < 0.7:
            v.insert(p, r.choice(vocab))
        else:
            del v[p]
    return v


def test_decontamination_recall_and_exactness(spark):
    r = random.Random(7)
    vocab = [f"w{k}" for k in range(400)]
    items = [(i, " ".join(r.choice(vocab) for _ in range(r.randint(8, 60)))) for i in range(60)] + [(90, "tiny item"), (91, None), (92, " "), (93, None)]
    docs, want = [], set()
    for i in range(240):
        w = [r.choice(vocab) for _ in range(r.randint(0, 120))]
        if i % 4 == 0:
            k, t = items[(i // 4) % 60]
            n = len(t.split())
            w[len(w) // 2 : len(w) // 2] = edited(t.split(), (i // 4) % 3 * decontaminate.edits_allowed(n) // 2, r, vocab)
        docs.append((i, " ".join(w).upper() if i % 8 == 0 else " ".join(w)))
    docs += [(900, None), (901, ""), (902, "x tiny ITEM y")]
    for i, t in docs:
        w = (t or "").lower().split()
        for k, u in items:
            if u and u.split() and decontaminate.closest(u.split(), w)[0] <= decontaminate.edits_allowed(len(u.split())):
                want.add((i, k))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = {(x.doc_id, x.item_id): x for x in decontaminate.hits(d, b).collect()}
    assert set(got) <= want and len(got) >= 0.97 * len(want) and (902, 90) in got
    for (i, k), x in got.items():
        w = (dict(docs)[i] or "").lower().split()
        assert edit_distance(dict(items)[k].split(), w[x.start_word : x.end_word]) == x.distance
    left = {x.doc_id for x in decontaminate.drop_contaminated(d, b).collect()}
    assert left == {i for i, _ in docs} - {i for i, _ in got}
    assert decontaminate.hits(d, b.limit(0)).count() == 0 and decontaminate.hits(d.limit(0), b).count() == 0


@pytest.mark.parametrize("low, high", [(10, 30), (31, 100), (101, 250), (251, 500)])
def test_decontamination_recall_by_length(low, high):
    """Items of each length band with as many edits as are allowed, inside other text."""
    r = random.Random(low)
    vocab = [f"w{k}" for k in range(3000)]
    items = [(i, " ".join(r.choice(vocab) for _ in range(r.randint(low, high)))) for i in range(40)]
    index = decontaminate.Index([(i, t.encode()) for i, t in items])
    found = due = 0
    for i, t in items:
        w = t.split()
        text = [r.choice(vocab) for _ in range(50)] + edited(w, decontaminate.edits_allowed(len(w)), r, vocab) + [r.choice(vocab) for _ in range(50)]
        if decontaminate.closest(w, text)[0] > decontaminate.edits_allowed(len(w)):
            continue
        due += 1
        flat = decontaminate.word_hashes(" ".join(text).encode())
        at = index.starts(np.append(flat, np.uint64(0)))
        at = at[at < len(flat)]
        found += any(y == i for _, y in index.candidates(np.append(flat, np.uint64(0)), np.full(len(at), len(flat)), at))
    print(f"recall at {low} to {high} words: {found}/{due}; positions and repetitions {index.plans}")
    assert found >= 0.95 * due


def test_decontamination_in_blocks(spark, monkeypatch):
    d = spark.createDataFrame([(1, "a b c d e f g h"), (2, "p q r s t u v w")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "b c d e f"), (2, "q r s t u")], "item_id long, text string")
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 5)
    assert sorted((x.doc_id, x.item_id) for x in decontaminate.hits(d, b).collect()) == [(1, 1), (2, 2)]


def test_warc_round_trip(spark, tmp_path):
    rows = [(3, "http://a/\r\nx%", "same"), (1, None, "same"), (2, "u", None), (4, "u", ""), (5, "http://a/WARC-Type: revisit", "é" * 2000), (5, "again", "é" * 2000), (None, "n", "same")]
    d = spark.createDataFrame([(*x, "clash") for x in rows], "page_id long, url string, html string, key string")
    path = f"file://{tmp_path}/w"
    warc.write_archive(d, path)
    a = warc.read_archive(spark, path)
    got = collections.Counter((x.page_id, x.payload_bytes, x.payload_digest, x.record_type, x.refers_to, x.target) for x in warc.describe(a).collect())
    digest = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    first = {"same": 1, "": 2, "é" * 2000: 5}
    want = collections.Counter()
    for i, u, t in rows:
        f = first[t or ""]
        want[i, len((t or "").encode()), digest(t), "response" if i == f else "revisit", None if i == f else f, u] += 1
    assert got == want
    assert spark.read.parquet(path + "/payloads").count() == 3
    raw = a.where("page_id = 5").first().record
    assert raw.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and raw.endswith(("é" * 2000).encode() + b"\r\n\r\n")
    warc.write_archive(d, path + "2", min_bytes=100)
    assert warc.describe(warc.read_archive(spark, path + "2")).where("record_type = 'revisit'").count() == 0
    warc.write_archive(d.limit(0), path + "3")
    assert warc.describe(warc.read_archive(spark, path + "3")).count() == 0
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target")
    for end in ("", "2", "3"):
        both = [collections.Counter(tuple(x[c] for c in columns) for x in y.collect()) for y in (warc.listed(spark, path + end), warc.describe(warc.read_archive(spark, path + end)))]
        assert both[0] == both[1]


def test_warc_hot_key(spark, tmp_path):
    """A third of all rows share one payload; the others, over a thousand, have their own."""
    rows = [(i, f"u{i}", "hot" if i % 3 == 0 else f"page {i // 2}" if i % 3 == 1 else f"own {i}") for i in range(4500)]
    path = f"file://{tmp_path}/hot"
    warc.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string"), path)
    hot = warc.hot_keys(spark.read.parquet(path + "/payloads")).collect()
    assert [x.key for x in hot] == [hashlib.sha256(b"hot").hexdigest()]
    first = {}
    for i, _, t in rows:
        first.setdefault(t, i)
    want = {i: (len(t), u, "response" if first[t] == i else "revisit", None if first[t] == i else first[t]) for i, u, t in rows}
    got = warc.listed(spark, path).collect()
    assert len(got) == len(rows) and {x.page_id: (x.payload_bytes, x.target, x.record_type, x.refers_to) for x in got} == want


def test_warc_false_payload_raises(spark, tmp_path):
    path = f"file://{tmp_path}/false"
    warc.write_archive(spark.createDataFrame([(1, "u", "a"), (2, "u", "a"), (3, "u", "b")], "page_id long, url string, html string"), path)
    spark.sql(f"DROP TABLE {warc.payload_table(path)}")
    p = spark.read.parquet(path + "/payloads").collect()
    spark.createDataFrame([(x.key, bytearray(b"c"), x.first_id, x.records) for x in p], "key string, payload binary, first_id long, records long").write.mode("overwrite").parquet(path + "/payloads")
    with pytest.raises(Exception, match="does not match"):
        warc.listed(spark, path)


def test_licenses(spark):
    apache, mit = "Licensed under the Apache License, Version 2.0.", "Released under the MIT License."
    rows = [("a/LICENSE", mit), ("a/b/x.txt", "plain prose of any kind"), ("a/b/LICENSE", apache), ("a/b/c/y.txt", None), ("a/z.txt", "text\n" + apache + "\nmore text"), ("q/n.txt", "nothing"), (None, ""), ("a/notLICENSE", "x"), ("LICENSE.md", "This work is licensed under the GNU General Public License, version 3."), ("a/z.txt", "text\n" + apache + "\nmore text")]
    d = spark.createDataFrame([(i, p, t) for i, (p, t) in enumerate(rows)], "doc_id long, path string, text string")
    got = {r.doc_id: (r.license, r.effective_license, r.inherited_from) for r in licenses.scan(d).collect()}
    assert got[0] == ("MIT", "MIT", None) and got[1] == (None, "Apache-2.0", "a/b") and got[3] == (None, "Apache-2.0", "a/b")
    assert got[4] == got[9] == ("Apache-2.0", "Apache-2.0", None) and got[5] == (None, "GPL-3.0", "") and got[6] == (None, None, None) and got[7] == (None, "MIT", "a")
    assert licenses.scan(d.limit(0)).count() == 0


def test_license_bound_is_lossless():
    r, s = random.Random(9), licenses.Scorer({}, 1000)
    words = [t.decode() for t in licenses.TERMS] + ["zzz", "qqq"]
    for _ in range(500):
        tf = licenses.terms(" ".join(r.choice(words) for _ in range(r.randint(1, 12))).encode())
        assert s.best(tf)[0] <= s.bound(tf) + 1e-9


def test_oracles(spark):
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{DATA}/{f}'")
    for name, sql in queries.oracles().items():
        want = con.sql(sql)
        got = queries.QUERIES[name](spark, DATA)
        assert sorted(got.columns) == sorted(want.columns)
        order = [got.columns.index(c) for c in want.columns]
        assert sorted((tuple(r[i] for i in order) for r in map(tuple, got.collect())), key=str) == sorted(want.fetchall(), key=str), name
    assert chat.ORACLE_SQL


def test_every_query_takes_the_whole_table(spark):
    n = spark.read.parquet(f"{DATA}/documents.parquet").count()
    for name, q in queries.QUERIES.items():
        if not name.startswith(("op5_", "op7_", "op10_")):
            assert q(spark, DATA).count() == n, name


def test_pipeline(spark):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    assert [k for k, _ in corpus_pipeline.STAGES] == ["quality rules", "near dedup", "substring dedup", "decontamination", "encoding"]
    left = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, left, DATA)
        assert out.columns == docs.columns
        left = spark.createDataFrame(out.collect(), docs.schema)
    want = left.count()
    got = corpus_pipeline.run(spark, DATA)
    assert got.count() == want < docs.count() and got.where("NOT round_trip").count() == 0


def test_pipeline_defined_cases(spark, tmp_path):
    """Nulls, empty texts, repeated rows, clashing extra columns, and empty tables."""
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    from medialoom.llm import quality

    good = [r.text for r in quality.clean(spark.read.parquet(f"{DATA}/documents.parquet")).where("length(text) > 1500").orderBy("doc_id").limit(5).collect()]
    rows = [(1, good[0], "en", "s", 1, "x", 7), (2, good[0], None, None, None, None, None), (3, None, "en", "s", 1, "x", 7), (4, "", "en", "s", 0, "x", 7)]
    rows += [(5, good[1], "en", "s", 1, "x", 7)] * 2 + [(None, good[2], None, None, None, None, None), (6, " \n ", None, "s", 1, "x", 7), (7, good[3], "en", "s", 1, "x", 7)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, row string, key long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(None, "nothing"), (1, None), (2, good[3])], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted({r.doc_id or 0 for r in got}) == [0, 1, 5]  # 2 copies 1, 3, 4 and 6 have no words, 7 leaks an item
    assert all(r.n_tokens for r in got)
    empty = tmp_path / "empty"
    spark.createDataFrame([], schema).write.parquet(f"{empty}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{empty}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(empty)).count() == 0
