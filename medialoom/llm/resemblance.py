"""Groups of documents whose shingle sets have a Jaccard similarity of 0.8 or more.

Every distinct set of five-word shingles has a SimHash fingerprint, the majority bits of
its shingles.  Fingerprints within two bits are found by multi-index hashing (``simhash``:
segment tables, radius-1 balls, complete distances verified), and the component they are
in is a key of the set.  Near copies of similarity 0.8 lie up to 14 bits apart, beyond any
ball that can be enumerated, so each set has ``BANDS`` more keys of ``ROWS`` MinHash
values each: two sets of similarity 0.8 share none of these with a probability of
(1 - 0.8^5)^24, below 0.0001.  Sets that share a key are candidates.  Each key gives a
star of links, so no pairs are enumerated; the components of these links are dealt to
tasks, where every pair of a component that shares a key is linked only after its exact
similarity is found to be 0.8 or more.  Pairs that are in one group already are not
compared again.

A shingle is its 64-bit hash, a set is known by the 64-bit hash of its sorted shingles.
Defined cases: case does not count; a text of fewer words than ``width`` is one shingle
of all its words; texts without words are copies of each other; rows without an id are
in no group; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from medialoom.llm.common import batch_of, drop_path, materialise, pick, released, texts_of
from medialoom.llm.components import connected_components
from medialoom.llm.simhash import links, majority
from medialoom.llm.substring import window_hashes

#: At least SIMILAR[0] / SIMILAR[1] of the union is common.
SIMILAR = (4, 5)
BANDS, ROWS = 24, 5
BLOCK = 4096
_R = np.random.default_rng(42)
_A, _B = (_R.integers(0, 1 << 32, (BANDS * ROWS, 1), dtype=np.uint32) | np.uint32(1) for _ in range(2))


def shingles(text: bytes, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``width`` words."""
    words = text.lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    return np.unique(window_hashes(h, min(width, len(h)), 0))


def set_hash(s: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).view(np.int64))


def band_keys(s: np.ndarray) -> list[int]:
    """``BANDS`` keys of a set; none of an empty one, which has no similar sets."""
    if not len(s):
        return []
    low, high = s.astype(np.uint32), (s >> np.uint64(32)).astype(np.uint32)
    least = np.full(BANDS * ROWS, 0xFFFFFFFF, dtype=np.uint32)
    for k in range(0, len(s), BLOCK):
        least = np.minimum(least, (low[k : k + BLOCK] * _A + high[k : k + BLOCK] * _B).min(axis=1))
    raw, step = least.tobytes(), 4 * ROWS
    keys = [xxhash.xxh3_64_intdigest(raw[k * step : (k + 1) * step], k) for k in range(BANDS)]
    return np.array(keys, dtype=np.uint64).view(np.int64).tolist()


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    (num, den), n, m = SIMILAR, len(a), len(b)
    if den * min(n, m) < num * max(n, m):
        return False
    both = np.concatenate([a, b])
    both.sort()
    common = int(np.count_nonzero(both[1:] == both[:-1]))
    return den * common >= num * (n + m - common)


def grouped(sets: list[np.ndarray], keys: list[list[int]]) -> list[int]:
    """For each set the first member of its group, over similar pairs that share a key."""
    root = list(range(len(sets)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    met: dict[int, list[int]] = defaultdict(list)
    links = [0] * len(sets)
    for x in range(len(sets)):
        own = keys[x].tolist() if isinstance(keys[x], np.ndarray) else keys[x]
        others = {y for k in own for y in met[k]}
        for y in sorted(others, key=lambda y: (-links[y], y)):  # those that link most others first: one success spares a whole group
            if find(x) != find(y) and similar(sets[x], sets[y]):
                links[y] += 1
                a, b = find(x), find(y)
                root[max(a, b)] = min(a, b)
        for k in own:
            met[k].append(x)
    return [find(x) for x in range(len(sets))]


def gone_ids(docs: DataFrame, width: int = 5, bands: int = BANDS) -> DataFrame:
    """Each doc_id that is not the smallest of a group.

    ``bands``: MinHash keys a set; with none, only fingerprints give candidates.
    """
    spark = docs.sparkSession
    rows = pick(docs, doc_id="long", text="string").where("doc_id IS NOT NULL")
    schema = T.StructType.fromDDL("doc_id long, node long, fp long, keys array<long>")

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingles(t, width) for t in texts_of(b, "text")]
            yield batch_of(schema, doc_id=b.column(0), node=list(map(set_hash, sets)), fp=list(map(majority, sets)), keys=[band_keys(s)[:bands] for s in sets])

    signed, signed_path = materialise(rows.mapInArrow(released(sign), schema), "signed")
    prints, prints_path = materialise(signed.select("fp").distinct(), "distinct-fp")
    within = connected_components(links(prints)).select(F.col("node").alias("fp"), F.col("label").alias("print_group"))
    sets = signed.groupBy("node").agg(F.min("doc_id").alias("least_id"), F.any_value("fp").alias("fp"), F.any_value("keys").alias("keys")).join(within, "fp", "left")
    by_node, path = materialise(sets.select("node", "least_id", F.concat("keys", F.array(F.coalesce("print_group", "fp"))).alias("keys")), "shingle-sets")
    # many rows a set, of which Spark's estimate counts one
    keyed = by_node.select("node", F.explode("keys").alias("key")).hint("merge")
    met = keyed.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a <> z").select("key", "a")
    near = connected_components(keyed.join(met, "key").where("a <> node").select("a", F.col("node").alias("b")).distinct())

    members = by_node.join(near, "node").select("node", "label", "least_id", "keys")
    with_text = rows.join(members, rows["doc_id"] == members["least_id"]).select("label", "node", "least_id", "keys", "text")
    out_schema = T.StructType.fromDDL("node long, group_id long")

    def link(t: pa.Table) -> pa.Table:
        found = {}
        for b in t.to_batches(max_chunksize=1000):  # of the texts only their sets stay
            for node, least, keys, text in zip(*(b.column(b.schema.get_field_index(c)).to_pylist() for c in ("node", "least_id", "keys")), texts_of(b, "text"), strict=True):
                s = shingles(text, width)
                if node not in found and set_hash(s) == node:  # rows of one id can have several texts
                    found[node] = (s, np.array(keys, dtype=np.int64), least)
        nodes = sorted(found, key=lambda k: (found[k][2], k))
        first = grouped([found[k][0] for k in nodes], [found[k][1] for k in nodes])
        return pa.Table.from_batches([batch_of(out_schema, node=nodes, group_id=[found[nodes[x]][2] for x in first])])

    linked = with_text.groupBy("label").applyInArrow(link, out_schema)
    kept = by_node.join(linked, "node", "left").select(F.coalesce("group_id", "least_id").alias("doc_id"))
    # fewer than those that stay, so that they are broadcast longer and the texts not moved
    gone, _ = materialise(signed.select("doc_id").distinct().join(kept, "doc_id", "left_anti"), "gone-ids")
    for p in (signed_path, prints_path, path):
        drop_path(spark, p)
    return gone
