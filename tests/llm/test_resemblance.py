"""Near dedup of the pipeline against brute force."""

from __future__ import annotations

import random

from medialoom.llm import resemblance, simhash

from .test_corpus_operators import groups_of


def brute_set(text, width=5):
    w = text.lower().split()
    return {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} or {tuple(w)}


def test_near_dedup_links_at_similarity(spark):
    r = random.Random(11)
    texts = []
    for _ in range(12):
        base = [f"w{r.randrange(5000)}" for _ in range(r.randint(60, 300))]
        texts.append(" ".join(base))
        for _ in range(4):
            w = list(base)
            for _ in range(r.randint(1, 6)):
                w[r.randrange(len(w))] = "new"
            texts.append(" ".join(w))
    texts += [texts[0].upper(), "one two", "One  Two", "one three"]
    r.shuffle(texts)
    sets = dict(enumerate(map(brute_set, texts)))
    want = groups_of(sets, lambda a, b: 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]))
    assert len(set(want.values())) < len(set(map(frozenset, sets.values())))
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {x.doc_id for x in simhash.drop_near_duplicates(d).collect()}
    assert got == set(want.values())
    assert simhash.drop_near_duplicates(d.limit(0)).count() == 0


def test_fingerprints_within_two_bits_are_candidates(spark, monkeypatch):
    """Without MinHash keys, what multi-index hashing finds is verified and dropped."""
    r, seen = random.Random(5), []
    monkeypatch.setattr(resemblance, "links", lambda fps: (seen.append({x.fp for x in fps.collect()}), simhash.links(fps))[1])
    texts = []
    for _ in range(6):
        base = [f"w{r.randrange(9000)}" for _ in range(1500)]
        texts += [" ".join(base), " ".join([*base, "end"]), " ".join(base[:900] + ["w" + str(r.random())] + base[901:])]
    texts += [texts[0].upper(), "one two", "one three", "", None]
    sets = [resemblance.shingles((t or "").encode(), 5) for t in texts]
    prints = [simhash.majority(s) % 2**64 for s in sets]
    want = groups_of(dict(enumerate(prints)), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    assert len({want[k] for k in range(18)}) < 18 and len(set(prints)) > len(set(want.values()))
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {x.doc_id for x in resemblance.gone_ids(d, bands=0).collect()}
    assert got == {k for k, g in want.items() if k != g}
    assert seen == [{x - 2**64 if x >= 2**63 else x for x in prints}]
