from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from wardlens.llm.components import connected_components
from wardlens.llm.simhash import (
    HierarchicalIndex,
    drop_near_copies,
    fingerprint,
    fingerprint_links,
    gray_rank,
    simhash_groups,
)


def plain_fingerprint(text, n):
    words = [w for w in (text or "").encode().lower().split()]
    shingles = [b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(rows, max_bits):
    """rows: (id, fingerprint); smallest reachable id of each row."""
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= max_bits:
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), key), key)
    return [least[find(i)] for i in range(len(rows))]


@pytest.mark.parametrize("text", ["", " \t\n", "one", "Ä b\x0bC d e F", "a b c d e f a b c d " * 50])
def test_fingerprint_equals_its_definition(text):
    for n in (1, 4, 5):
        assert fingerprint(text.encode(), n) == plain_fingerprint(text, n)


def test_hash_is_the_one_spark_has(spark):
    texts = ["a b c d", "é ñ", "x" * 100]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.xxhash64("t").alias("h")).collect()
    assert all(r.h % (1 << 64) == xxhash.xxh64_intdigest(r.t.encode(), 42) for r in rows)


def test_gray_rank_orders_neighbours_one_bit_apart(spark):
    codes = [i ^ i >> 1 for i in range(64)]
    got = spark.createDataFrame([(c,) for c in codes], "fp long").select(gray_rank(F.col("fp")).alias("r")).collect()
    assert [r.r for r in got] == list(range(64))


def test_whole_query_against_brute_force(small_docs):
    rows = [(r.doc_id, plain_fingerprint(r.text, 4)) for r in small_docs.select("doc_id", "text").collect()]
    expected = {k: (f, c) for (k, f), c in zip(rows, plain_groups(rows, 4))}
    got = {r.doc_id: (r.fp % (1 << 64), r.component_id) for r in simhash_groups(small_docs, words=4).collect()}
    assert got == expected


def near(base, bits, rng):
    for b in rng.sample(range(64), bits):
        base ^= 1 << b
    return base


def test_links_join_all_planted_neighbours(spark):
    rng = random.Random(5)
    fps = set()
    for _ in range(60):
        base = rng.getrandbits(64)
        fps |= {base} | {near(base, rng.randint(1, 6), rng) for _ in range(12)}
    dense = rng.getrandbits(64)
    fps |= {near(dense, rng.randint(1, 3), rng) for _ in range(3000)}  # a run long enough to be peeled
    fps = sorted(fps)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    edges = fingerprint_links(spark.createDataFrame(signed, "fp long"), 4)
    assert edges.count() < 15 * len(fps)
    root = {r.node % (1 << 64): r.root for r in connected_components(edges).collect()}
    arr = np.array(fps, np.uint64)
    label = list(range(len(fps)))

    def find(i):
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(arr[:i] ^ arr[i]) <= 4):
            label[find(i)] = find(int(j))
    expected = {}
    for i, f in enumerate(fps):
        expected.setdefault(find(i), set()).add(f)
    got = {}
    for f in fps:
        got.setdefault(root.get(f, f if f < 1 << 63 else f - (1 << 64)), set()).add(f)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, expected.values()))


def test_search_prunes_groups_but_loses_nothing():
    rng = np.random.default_rng(1)
    fps = np.sort(rng.integers(0, 1 << 63, 3000).astype(np.uint64))
    fps[1::50] = fps[::50] ^ np.uint64(0b101)
    index = HierarchicalIndex(fps, np.array([0]), 4)
    got = {(int(a), int(b)) for x, y in index.search(np.arange(len(fps))) for a, b in zip(x, y)}
    d = np.bitwise_count(fps[:, None] ^ fps[None, :])
    assert got == {(int(a), int(b)) for a, b in np.argwhere(d <= 4) if a != b}


def test_edge_cases(make_docs):
    docs = make_docs([(3, None), (7, ""), (5, " "), (None, "a b c d e f"), (9, "a b c d e f"), (9, "a b c d e f")])
    got = sorted(((r.doc_id, r.component_id) for r in simhash_groups(docs).collect()), key=repr)
    assert got == [(3, 3), (5, 3), (7, 3), (9, 9), (9, 9), (None, 9)]
    kept = drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 3, 9, 9]
    assert simhash_groups(make_docs([])).count() == 0


def test_components_of_a_long_chain(spark):
    chain = [(i, i + 1) for i in range(200)] + [(1000, 1001), (7, 7)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, 1000: 1000, 1001: 1000}


def test_an_id_with_several_texts_loses_only_the_near_copy(make_docs):
    text = " ".join(f"word{i}" for i in range(400))
    clean = " ".join(f"other{i}" for i in range(300))
    far = " ".join(f"third{i}" for i in range(300))
    docs = make_docs([(3, text), (5, clean), (5, text + " end"), (7, far), (7, text), (8, clean), (None, text)])
    got = sorted(((r.doc_id, r.text) for r in drop_near_copies(docs).collect()), key=repr)
    assert got == sorted([(3, text), (5, clean), (7, far), (None, text)], key=repr)


def test_clashing_names(make_docs):
    docs = make_docs([(1, "a b c d e"), (2, "a b c d e"), (2, "x")]).withColumnsRenamed({"lang": "fp", "source": "gone_id"})
    kept = drop_near_copies(docs)
    assert kept.columns == docs.columns and sorted((r.doc_id, r.text) for r in kept.collect()) == [(1, "a b c d e"), (2, "x")]
