from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from wardlens.llm.bpe_automaton import MergeAutomaton, byte_bpe, decode, encode

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def merge_in_rank_order(word, merges):
    parts = [word[i : i + 1] for i in range(len(word))]
    for left, right in merges:
        i = 0
        while i + 1 < len(parts):
            if parts[i] == left and parts[i + 1] == right:
                parts[i : i + 2] = [left + right]
            i += 1
    return parts


@pytest.mark.parametrize("seed", range(30))
def test_automaton_accepts_exactly_what_merging_gives(seed):
    rng = random.Random(seed)
    tokens, merges = [b"a", b"b", b"c"], []
    for _ in range(rng.randint(1, 14)):
        pair = (rng.choice(tokens), rng.choice(tokens))
        if pair[0] + pair[1] not in tokens and merge_in_rank_order(pair[0] + pair[1], merges) == list(pair):
            merges.append(pair)
            tokens.append(pair[0] + pair[1])
    automaton = MergeAutomaton({t: i for i, t in enumerate(tokens)}, merges)
    for _ in range(200):
        word = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 12)))
        assert [automaton.labels[i] for i in automaton.encode(word)] == merge_in_rank_order(word, merges)


def test_equals_the_library_on_odd_texts(library):
    rng = random.Random(1)
    pieces = [*"aaaeettthh  \n\t'sÀéñß日本😀!!##09  \x85\x1c\x1f　 ²Ⅷ़́ \r", "<|endoftext|>", "'re", "'ll", " the"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 60))) for _ in range(4000)]
    texts += ["", " ", "\n", "a" * 3000, " " * 500, "!" * 700, "a b\nc d", "a  b", " a", "a ", "a\n\nb", "a \nb", "a\n b"]
    bpe = byte_bpe(PATH)
    for text, expected in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert list(bpe.encode(text)) == expected.ids
        assert bpe.decode(expected.ids) == library.decode(expected.ids, skip_special_tokens=False)


def test_decoding_any_ids_is_the_library_s(library):
    rng = random.Random(2)
    for _ in range(500):
        ids = [rng.randrange(50257) for _ in range(rng.randint(0, 8))]
        assert byte_bpe(PATH).decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_query_over_the_table(spark, library, small_docs):
    from wardlens.llm.queries import op10_bpe_automaton

    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in op10_bpe_automaton(spark, "/root/testdata/sf0.001").collect()}
    for row in small_docs.collect():
        ids = library.encode(row.text, add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        digests = (hashlib.sha256(t.encode()).hexdigest() for t in (",".join(map(str, ids)), text))
        assert got[row.doc_id] == (len(ids), *digests)


def test_edge_cases(make_docs):
    long = "wörd " * 60_000
    docs = make_docs([(1, None), (2, ""), (None, "hi"), (3, "hi"), (3, "hi"), (4, long)])
    rows = encode(docs.withColumnRenamed("lang", "ids"), decoded=True).collect()
    assert sorted(((r.doc_id, r.decoded) for r in rows), key=repr) == sorted(
        [(1, ""), (2, ""), (None, "hi"), (3, "hi"), (3, "hi"), (4, long)], key=repr
    )
    assert {r.doc_id: len(r.ids) for r in rows}[1] == 0
    again = decode(encode(docs)).collect()
    assert sorted(map(repr, ((r.doc_id, r.decoded) for r in again))) == sorted(map(repr, ((r.doc_id, r.decoded) for r in rows)))
    assert encode(make_docs([])).count() == 0


def test_a_word_is_encoded_once_whatever_stands_behind_it(library, monkeypatch):
    bpe = byte_bpe.__wrapped__(PATH)
    encoded, plain = [], bpe.automaton.encode
    monkeypatch.setattr(bpe.automaton, "encode", lambda word: encoded.append(word) or plain(word))
    text = "ndstthan eableing, eableing. eableing! (eableing\n eableing  eableing"
    assert list(bpe.encode(text)) == library.encode(text, add_special_tokens=False).ids
    assert encoded.count(b" eableing") == 1
