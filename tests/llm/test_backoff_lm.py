from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from wardlens.llm.backoff_lm import PRIOR, BackoffAutomaton, Block, _pack, _pack_sorted, _unpack, _unpack_sorted, score_texts
from wardlens.llm.queries import op6_lm_scoring

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_scores(rows, order, m=PRIOR):
    """The model by its definition, word by word."""
    texts = [(i, re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)) + ["</s>"]) for i, t in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in texts]
    grams = [Counter() for _ in range(order + 1)]
    for (_, words), out in zip(texts, held):
        if not out:
            for k, w in enumerate(words):
                grams[1][w,] += 1
                for n in range(2, order + 1):
                    before = (["</s>"] + words)[max(0, k - n + 2) : k + 1]
                    if len(before) == n - 1:
                        grams[n][*before, w] += 1
    tokens, types = sum(grams[1].values()), len(grams[1])

    def p(before, w):
        if not before:
            return (grams[1][w,] + 1) / (tokens + types + 1)
        return (grams[len(before) + 1][*before, w] + m * p(before[1:], w)) / (grams[len(before)][tuple(before)] + m)

    out = []
    for (i, words), h in zip(texts, held):
        base = sum(math.log10(p([], w)) for w in words)
        score = sum(math.log10(p((["</s>"] + words)[max(0, k - order + 2) : k + 1], w)) for k, w in enumerate(words))
        out.append((i, h, len(words), sum(grams[1][w,] > 0 for w in words), tokens, base, score))
    return out


def same(got, expected):
    got = sorted((tuple(r) for r in got), key=lambda r: (r[0] is None, r))
    expected = sorted(expected, key=lambda r: (r[0] is None, r))
    assert [r[:5] for r in got] == [r[:5] for r in expected]
    for g, e in zip(got, expected):
        assert g[5:] == pytest.approx(e[5:], rel=1e-9)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_whole_table_against_the_definition(small_docs, order):
    rows = [(r.doc_id, r.text) for r in small_docs.select("doc_id", "text").collect()]
    got = score_texts(small_docs, order=order, block_tokens=7_000, range_tokens=5_000).collect()
    same(got, plain_scores(rows, order))


def test_probabilities_of_a_state_sum_to_one():
    words = "a b a c a b d".split()
    grams, m, tokens, types = Counter(zip(words, words[1:])), PRIOR, 8, 5
    p = {w: (Counter(words)[w] + 1) / (tokens + types + 1) for w in "abcd"} | {"</s>": 2 / 14, "new": 1 / 14}
    total = sum((grams["a", w] + m * p[w]) / (3 + m) for w in p)
    assert total == pytest.approx(1)


def test_held_out_texts_prefer_the_model(small_docs):
    rows = score_texts(small_docs).filter("held_out AND n_tokens > 50").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_edge_cases(make_docs):
    rows = [(1, None), (2, ""), (3, " \t"), (None, "A b"), (5, "a b"), (5, "a b"), (7, "Ä ä " * 60_000), (8, "</s> end")]
    docs = make_docs(rows).withColumnsRenamed({"lang": "score", "source": "block"})
    same(score_texts(docs).collect(), [r for r in plain_scores([*rows[:7], (8, "</S> end".replace("</S>", "<s-s>"))], 2)])
    assert score_texts(make_docs([])).count() == 0


def test_registered_query_scores_by_trigrams(spark, small_docs):
    rows = [(r.doc_id, r.text) for r in small_docs.select("doc_id", "text").collect()]
    same(op6_lm_scoring(spark, "/root/testdata/sf0.001").collect(), plain_scores(rows, 3))


def automaton(texts, order, held=()):
    """Over one block that holds the whole corpus."""
    numbers = {b" ": 0}
    ids = [np.array([numbers.setdefault(w, len(numbers)) for w in [*t.encode().split(), b" "]], np.int32) for t in texts]
    flags = [i in held for i in range(len(texts))]
    block = Block.of_numbers(numbers, ids, flags)
    counts = [np.bincount(at[block.learns[places]], minlength=len(keys)) for _, keys, at, _, places in block.grams(order)]
    return BackoffAutomaton(block, counts, int(block.learns.sum()), int((counts[0] > 0).sum()), PRIOR)


TEXTS = ["a b a c a b d", "", "b a c a b", "a b a c", "d d d d d d", "z a b y a c"]


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_words_of_every_state_sum_to_one(order):
    made = automaton(TEXTS, order)
    types = len(made.block.words)
    assert len(made.failure) == len(made.shorter) and (len(made.failure) > types) == (order > 1)
    last = np.searchsorted(made.block.words, hashes(b" ")[0])
    states = np.arange(len(made.failure), dtype=np.int32)
    over = set(made.step(states.copy(), np.full(len(states), last))[1].tolist()) - {made.start()}  # no word follows
    for state in set(states.tolist()) - over:
        weight, target = made.step(np.full(types, state, np.int32), np.arange(types))
        assert ((0 <= target) & (target < len(made.failure))).all()
        unseen = 1 / (len(made.block.ids) + types + 1)  # a word that no text has
        while state:
            unseen *= 10 ** made.failure[state]
            state = made.shorter[state]
        assert (10**weight).sum() + unseen == pytest.approx(1)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
@pytest.mark.parametrize("piece", [1, 2, 3, 5])
def test_pieces_of_a_text_walk_as_the_whole(order, piece):
    made = automaton([*TEXTS, " ".join(TEXTS * 9)], order, held={2, 5})
    assert made.walk(piece) == pytest.approx(made.walk(10_000), rel=1e-12)


def test_failure_arcs_lead_to_the_history_without_its_first_word():
    made = automaton(["a b c", "b d", "x b d"], 3)
    word = {w: int(np.searchsorted(made.block.words, h)) for w, h in zip(b"abcdx", hashes(b"abcdx"))}

    def after(words):
        state = np.zeros(1, np.int32)
        for w in words:
            _, state = made.step(state.copy(), np.array([word[w]]))
        return int(state[0])

    assert made.shorter[after(b"ab")] == after(b"b") and made.shorter[after(b"b")] == 0
    # "a b d" was never seen: over the failure arc to "b", and on to the state "b d".
    assert after(b"abd") == after(b"bd") == after(b"xbd")
    # "a x" was never seen: the state holds no more than "x".
    assert after(b"ax") == after(b"x") != after(b"xb")


def hashes(letters):
    import xxhash

    return np.array([xxhash.xxh64_intdigest(bytes([w])) for w in letters], np.uint64)


@pytest.mark.parametrize("dtype", [np.uint8, np.uint32, np.int64, np.uint64])
@pytest.mark.parametrize("n", [0, 1, 5_000])
def test_packed_numbers_come_back(dtype, n):
    values = np.random.default_rng(n).integers(0, np.iinfo(dtype).max, n, dtype, endpoint=True)
    values[::2] //= 250
    assert (_unpack(_pack(values), dtype) == values).all() and len(_unpack(_pack(values), dtype)) == n
    ordered = np.sort(values.astype(np.uint64))
    assert (_unpack_sorted(_pack_sorted(ordered)) == ordered).all()
