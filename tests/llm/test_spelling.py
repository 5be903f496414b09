"""Spelling variants against brute force over all pairs of words, and against SQL."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from tests.llm.conftest import difference_of
from wardlens.llm.spelling import END, Acceptor, OneEdit, near_words, spelling_variants, vocabulary

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    k = 0
    while k < min(len(a), len(b)) and a[k] == b[k]:
        k += 1
    return a[k + (len(a) >= len(b)) :] == b[k + (len(b) >= len(a)) :]


def plain_words(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def plain_variants(words):
    out = {}
    for w, n in words.items():
        near = [v for v in words if one_edit(w, v)]
        best = min(near, key=lambda v: (-words[v], v), default=None)
        out[w] = [n, len(near), best if best and words[best] >= 10 * n else None]
    for w, row in out.items():
        root = w
        while out[root][2]:
            root = out[root][2]
        row += [words[row[2]] if row[2] else None, root]
    return out


def check(df, rows, **options):
    got = {r.word: [r.n, r.n_near, r.form, r.form_n, r.root] for r in spelling_variants(df, **options).collect()}
    assert got == plain_variants(plain_words(rows))
    return got


def test_query_equals_its_sql(spark):
    difference_of("op12_spelling_variants", spark, "sf0.01")


@pytest.mark.parametrize("most", [5000, 40, 3])
def test_table_against_brute_force(spark, most):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check(docs, [(r.doc_id, r.text) for r in docs.collect()], most=most)


def test_composition_against_all_pairs():
    rng = random.Random(5)
    for round_ in range(200):
        letters = "ab" if round_ % 2 else "abcé"
        words = {"".join(rng.choice(letters) for _ in range(rng.randint(1, 7))) for _ in range(rng.randint(0, 50))}
        got = [(a[:-1], b[:-1]) for a, b in OneEdit(Acceptor(sorted(w + END for w in words))).pairs()]
        pairs = {frozenset(p) for p in got}
        assert len(pairs) == len(got)
        assert pairs == {frozenset((a, b)) for a in words for b in words if one_edit(a, b)}


def test_the_acceptor_is_minimal():
    words = sorted(a + b + END for a in ("un", "re", "de") for b in ("wind", "bind", "windend", "bindend"))
    acceptor = Acceptor(words)

    def accepted(p):
        return {c + rest for c, t in acceptor.arcs[p].items() for rest in accepted(t)} or {""}

    assert accepted(acceptor.root) == set(words)
    languages = [frozenset(accepted(p)) for p in range(len(acceptor.arcs))]
    assert len(set(languages)) == len(languages)


@pytest.mark.parametrize("most", [1, 2, 7, 10_000])
def test_many_words_that_begin_alike(spark, most):
    """The same pairs wherever the composition is split, also when every word starts with the same letters."""
    rng = random.Random(6)
    words = sorted({"aaaaaa" + "".join(rng.choice("ab") for _ in range(rng.randint(1, 7))) for _ in range(150)})
    df = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    got = [frozenset((r.word, r.other)) for r in near_words(df, most).collect()]
    assert len(got) == len(set(got))
    assert set(got) == {frozenset((a, b)) for a in words for b in words if one_edit(a, b)}


def test_edges(spark, make_docs):
    long = "xy" * 30_000
    rows = [(None, "Straßenbahn STRAßENBAHN ÀÉÎÕÜÿ÷"), (1, None), (2, ""), (3, "spelling " * 90 + "speling spelling9spelling"),
            (4, "speling spellling spellling Spelling"), (4, "speling spellling spellling Spelling"), (5, f"{long} {long}a {long}"),
            (6, f"{long}a"), (7, "abcdef abcdef abcdefg abcdefg"), (8, "speling1speling,speling")]
    got = check(make_docs(rows), rows)
    assert got["speling"][2] == "spelling" and got["straßenbahn"][0] == 1 + 1 and long in got
    assert spelling_variants(make_docs([])).count() == 0
    assert spelling_variants(make_docs([(1, "one two")])).columns == ["word", "n", "n_near", "form", "form_n", "root"]


def test_ties_chains_and_clashing_names(make_docs):
    text = "alphabet " * 1000 + "alphabbt alphabbt alphabat " * 4 + "alphaba alphaba " + "betaword " * 20 + "betawurd " * 20 + "betawrd betawrd " + "betawordy " * 200
    docs = make_docs([(2, text)])
    got = check(docs, [(2, text)])
    assert got["betawrd"][2] == "betaword"  # of two forms with equal n the first
    assert got["betawrd"][4] == got["betaword"][2] == "betawordy"
    more = docs.withColumnsRenamed({"lang": "word", "source": "n"}).selectExpr("*", "1 AS read", "2 AS prefix")
    assert {r.word for r in spelling_variants(more).collect()} == set(got)


def test_a_run_loses_the_letter_its_checksum_names(make_docs):
    rows = [(i, "understanding " * 2) for i in range(400)]
    got = {r.word: r.n for r in vocabulary(make_docs(rows)).collect()}
    assert got == plain_words(rows) and len(got) > 5
