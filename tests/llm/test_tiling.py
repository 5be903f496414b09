from __future__ import annotations

import random

import pytest

from wardlens.llm.tiling import Benchmark, decontaminate, drop_contaminated, tiles, words_of

BENCH = "item_id long, text string"


def plain_tiles(test, doc, least):
    """Greedy string tiling by its definition: the longest free match, over and over."""
    free_t, free_d, total = [True] * len(test), [True] * len(doc), []
    while True:
        best = (0, 0, 0)
        for i in range(len(test)):
            for j in range(len(doc)):
                n = 0
                while (
                    i + n < len(test) and j + n < len(doc) and test[i + n] == doc[j + n] >= 0
                    and free_t[i + n] and free_d[j + n]
                ):
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        if best[0] < least:
            return total
        n, i, j = best
        free_t[i : i + n] = free_d[j : j + n] = [False] * n
        total.append(n)


@pytest.mark.parametrize("seed", range(40))
def test_tiles_are_greedy_longest_first(seed):
    rng = random.Random(seed)
    letters = rng.choice([3, 8, 30])
    test = [rng.randrange(letters) for _ in range(rng.randint(1, 45))]
    doc = [rng.randrange(letters) for _ in range(rng.randint(1, 60))]
    for _ in range(3):
        a = rng.randrange(len(test))
        doc[rng.randrange(len(doc)) :] += test[a : a + rng.randint(1, 20)]
    got = tiles(test, doc, 3)
    assert all(test[i : i + n] == doc[j : j + n] for n, i, j in got)
    for place in (1, 2):
        used = [k for t in got for k in range(t[place], t[place] + t[0])]
        assert len(used) == len(set(used))
    # Ties may fall differently; the longest tile and the coverage of one greedy order are the measure.
    plain = plain_tiles(test, doc, 3)
    assert max((t[0] for t in got), default=0) == max(plain, default=0)
    assert abs(sum(t[0] for t in got) - sum(plain)) <= 3


def test_words_ignore_case_and_punctuation():
    assert words_of("Ab, (cD)\tÉ1!! x") == [b"ab", b"cd", "é1".encode(), b"x"]
    assert words_of(None) == words_of(" .,") == []


def test_seeds_find_every_pair_that_tiling_covers(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    items = [tuple(r) for r in bench.select("item_id", "text").collect()]
    texts = [r.text for r in docs.select("text").collect()]
    vocabulary: dict[bytes, int] = {}
    ids = [[vocabulary.setdefault(w, len(vocabulary)) for w in words_of(t)] for _, t in items]
    expected = {}
    for t, text in enumerate(texts):
        doc = [vocabulary.get(w, -1) for w in words_of(text)]
        for (item_id, _), test in zip(items, ids):
            found = tiles(test, doc, 5)
            if found:
                expected[t, item_id] = sum(n for n, _, _ in found) / len(test)
    got = {(t, i): c for t, i, c, _ in Benchmark(items, 5).covered(texts)}
    assert got == expected
    assert max(got.values()) > 0.5


def test_reordered_and_partial_passages(spark, make_docs):
    item = "one two three four five six. Seven eight nine ten eleven twelve; a b c d e f g."
    words = item.split()
    docs = make_docs(
        [
            (1, "x y " + item.upper() + " z"),
            (2, " ".join(words[12:]) + " zzz " + " ".join(words[:6]) + " qq " + " ".join(words[6:12])),
            (3, "zz " + " ".join(words[:7]) + " zz"),
            (4, None),
            (5, ""),
            (6, "nothing of it " * 20_000),
            (1, "clean"),
            (None, item),
            (7, item),
            (7, item),
        ]
    )
    bench = spark.createDataFrame([(11, item), (12, "short one"), (13, None), (14, "  "), (None, item)], BENCH)
    got = decontaminate(docs, bench)
    rows = sorted(((r.doc_id, r.contaminated, r.item_ids) for r in got.collect()), key=repr)
    assert rows == [
        (1, False, []), (1, True, [11]), (2, True, [11]), (3, False, []), (4, False, []), (5, False, []),
        (6, False, []), (7, True, [11]), (7, True, [11]), (None, True, [11]),
    ]
    assert sorted(r.doc_id for r in drop_contaminated(docs, bench).collect()) == [1, 3, 4, 5, 6]
    blocks = decontaminate(docs, bench, block_bytes=60)
    assert sorted(map(repr, blocks.collect())) == sorted(map(repr, got.collect()))


def test_short_item_must_occur_whole(spark, make_docs):
    bench = spark.createDataFrame([(1, "red green blue")], BENCH)
    docs = make_docs([(1, "a red, green blue b"), (2, "red green"), (3, "red x green blue")])
    assert [r.doc_id for r in decontaminate(docs, bench).filter("contaminated").collect()] == [1]


def test_empty_tables_and_clashing_columns(spark, make_docs):
    empty = spark.createDataFrame([], BENCH)
    docs = make_docs([(1, "a b c d e f")]).withColumnsRenamed({"lang": "coverage", "source": "item_id"})
    assert [r.contaminated for r in decontaminate(docs, empty).collect()] == [False]
    bench = spark.createDataFrame([(1, "a b c d e f")], BENCH)
    assert decontaminate(make_docs([]), bench).count() == 0
    assert drop_contaminated(docs, bench).columns == docs.columns
    assert decontaminate(docs, bench).collect()[0].coverage == 1.0
