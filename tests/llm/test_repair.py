from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from wardlens.llm.queries import op9_token_id_output
from wardlens.llm.repair import Grammar, Shard, compress, read_ids, word_encoder, words_of, write_ids
from wardlens.session import shared_path

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def shard_of(ids, texts, least):
    words, starts = words_of(pa.array([t.encode() for t in texts], pa.binary()))
    return compress(ids, np.diff(starts), [words], word_encoder(PATH), 1, least)


def library_ids(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 1]


def test_words_are_encoded_as_the_library_encodes_whole_texts(library):
    rng = random.Random(1)
    pieces = [*"aaaeettthhABC  \n\t'sÀéñßΣςİ日本😀!!##09,.  \x85\x1c\x1f　 ²Ⅷ़́가", "<|endoftext|>", "<|startoftext|>", "'re", "é"]
    encoder = word_encoder(PATH)
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 40)))
        ids, lengths = encoder.encode([w.decode() for w in text.encode().split()])
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
        assert lengths.sum() == len(ids)


def test_rules_expand_to_the_text_and_shorten_it():
    rng = np.random.default_rng(3)
    text = np.tile(rng.integers(0, 9, 40), 50)
    symbols, grammar = text.copy(), Grammar(10)
    group = np.repeat(np.arange(10), len(text) // 10)
    sizes = [len(symbols)]
    while (done := grammar.round(symbols, group, None, 10)) is not None:
        symbols, group = symbols[done[0]], group[done[0]]
        sizes.append(len(symbols))
    flat, bounds = grammar.expansions()
    assert np.concatenate([flat[bounds[s] : bounds[s + 1]] for s in symbols]).tolist() == text.tolist()
    assert sizes[-1] < sizes[0] / 5
    assert np.bincount(group).tolist() == [len(symbols) // 10] * 10 or len(set(group)) == 10


def test_rounds_over_touched_places_equal_rounds_over_all():
    rng = np.random.default_rng(5)
    for least in (2, 3, 9):
        text = np.concatenate([np.tile(rng.integers(0, 5, 30), 20), np.zeros(200, np.int64), rng.integers(0, 5, 900)])
        group = np.sort(rng.integers(0, 12, len(text)))
        for weight in (None, rng.integers(1, 4, 12)[group].astype(float)):
            some, whole = Grammar(5), Grammar(5)
            got, owner = some.shorten(text.copy(), group, weight, least)
            symbols, of, w = text.copy(), group, weight
            while (done := whole.round(symbols, of, w, least)) is not None:
                symbols, of, w = symbols[done[0]], of[done[0]], None if w is None else w[done[0]]
            assert some.rules.tolist() == whole.rules.tolist() and len(some.rules) > 5
            assert got.tolist() == symbols.tolist() and owner.tolist() == of.tolist()


def test_words_are_those_between_ascii_white_space():
    texts = [" a  b\t\n", None, "", "\x0b\x0c\r ", "c", "é\u00a0d \x1ce\x85f\u2003 g"]
    words, starts = words_of(pa.array([t if t is None else t.encode() for t in [*texts, "sliced"]], pa.binary())[:-1])
    got = [words[a:b].to_pylist() for a, b in zip(starts, starts[1:])]
    assert got == [[w.decode() for w in (t or "").encode().split()] for t in texts]


def test_the_most_frequent_pair_comes_first():
    grammar = Grammar(3)
    symbols = np.array([0, 1, 0, 1, 0, 1, 2, 2])
    grammar.round(symbols, np.zeros(8), None, 2)
    assert grammar.rules[0].tolist() == [0, 1]


def test_shard_gives_any_range_of_any_document(library):
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["the", "of the", "Wörter,", "inst", "x!!"]) for _ in range(rng.randint(0, 80))) for _ in range(60)]
    payload, n = shard_of([*range(59), None], texts, 4)
    shard = Shard(payload)
    assert len(shard.grammar.rules) > 3
    assert shard.is_null.tolist() == [False] * 59 + [True]
    expected = [library_ids(library, t) for t in texts]
    assert shard.all_ids().tolist() == sum(expected, [])
    assert n == shard.n_tokens == len(sum(expected, []))
    for doc, ids in enumerate(expected):
        assert shard.ids(doc).tolist() == ids
        a, b = sorted(rng.randint(0, len(ids)) for _ in range(2))
        assert shard.ids(doc, a, b).tolist() == ids[a:b]


def test_query_over_the_table(spark, library, small_docs):
    start, expected = 0, []
    for row in small_docs.orderBy("doc_id").collect():
        ids = library_ids(library, row.text)
        expected.append((row.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in op9_token_id_output(spark, "/root/testdata/sf0.001").collect()) == expected


def test_edge_cases_and_small_shards(spark, make_docs, library):
    rows = [(5, None), (2, ""), (None, "null id"), (9, "Same id"), (9, "Same id"), (9, "other"), (7, "lang wörd, " * 30_000)]
    path = shared_path(spark, "ids")
    write_ids(make_docs(rows).withColumnRenamed("lang", "start"), path, shard_ids=40, least_uses=2)
    got = read_ids(spark, path).orderBy("start").collect()
    texts = {(i, tuple(library_ids(library, t))) for i, t in rows}
    decoded = [(r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in got]
    assert set(decoded) == texts and len(decoded) == len(rows)
    assert [i or 0 for i, _ in decoded] == sorted(i or 0 for i, _ in rows)
    assert [r.start for r in got] == np.cumsum([0] + [len(d) for _, d in decoded])[:-1].tolist()
    empty = shared_path(spark, "ids")
    write_ids(make_docs([]), empty)
    assert read_ids(spark, empty).count() == 0


def test_rounds_go_on_until_no_pair_is_frequent():
    rng = random.Random(8)
    passage = " ".join(rng.choice(["the", "of", "inst", "house", "river", "x!!", "and", "who"]) for _ in range(300))
    texts = [passage] * 40 + ["na " * 5000]
    payload, n = shard_of([*range(41)], texts, 16)
    shard = Shard(payload)
    flat, _ = word_encoder(PATH).encode([w for t in texts for w in t.split()])
    assert n == len(flat) + len(texts) and [i for i in shard.all_ids().tolist() if i != 1] == [i for i in flat.tolist() if i != 1]
    symbols = shard.symbols(0, len(shard.packed))
    doc_of = np.repeat(np.arange(len(texts)), np.diff(shard.symbol_starts))
    assert Grammar.round(shard.grammar, symbols.copy(), doc_of, None, 16) is None
    assert shard.lengths.max() > 200  # a copied passage is one rule
    assert len(shard.grammar.rules) < 2000 and np.diff(shard.symbol_starts)[:40].max() <= 4
