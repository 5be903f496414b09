from __future__ import annotations

import random
import re
import time

import pytest

from wardlens.llm.licenses import BASE_PHRASES, RULES, scan, scan_licenses
from wardlens.llm.queries import QUERIES, op8_license_scan

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    places = [
        (label, i)
        for phrase, label in BASE_PHRASES.items()
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    return len(words), places


def labels(text):
    return sorted({f[0] for f in scan(text.encode())[2]})


def test_hundreds_of_rules_with_needed_words():
    assert len(RULES) > 300 and len({r.name for r in RULES}) == len(RULES)
    assert all(r.needs for r in RULES if r.name not in ("text:proprietary", "text:non-commercial"))


@pytest.mark.parametrize(
    "text, expected",
    [
        ("Licensed under the Apache License, Version 2.0.", ["apache-2"]),
        ("Released under the MIT License.", ["mit"]),
        ("This work is licensed under the GNU General Public License, version 3.", ["gpl-3"]),
        ("licensed under GPL v3 or later", ["gpl-3-or-later"]),
        ("Licensed under CC BY-NC 4.0.", ["cc-by-nc"]),
        ("Licensed under CC BY-NC-SA 4.0.", ["cc-by-nc-sa"]),
        ("SPDX-License-Identifier: BSD-3-Clause", ["bsd-3-clause"]),
        ("the Mozilla Public License is long", ["mpl"]),
        ("Die tzente in mit. Einau stauein geen.", []),
        ("a gnu, a zebra and a license to drive", []),
        ("All rights reserved.", ["all-rights-reserved"]),
        ("", []),
    ],
)
def test_statements(text, expected):
    assert labels(text) == expected


@pytest.mark.parametrize("rule", RULES, ids=lambda r: r.name)
def test_the_gate_never_closes_on_a_match(rule):
    """Every text of the statements above plus each rule's own plainest wording passes its gate."""
    for source in re.split(r"\|(?![^(]*\))", rule.pattern.pattern.decode()[4:-5]):
        plain = source
        for _ in range(6):
            plain = re.sub(r"\((?:\?:)?([^()|]*)(?:\|[^()]*)?\)\??", r"\1", plain)
        plain = re.sub(r"\[([^\]^])[^\]]*\]", r"\1", plain).replace("?", "").replace("\\w+", "x").replace("\\w*", "s")
        if "[^" in plain or "{" in plain:
            continue
        line = f" {plain} ".encode()
        if rule.pattern.search(line):
            assert all(not frozenset(plain.encode().split()).isdisjoint(group) for group in rule.needs)


def test_contained_places_are_dropped_and_base_places_stay():
    words, base, found, score = scan(b"x licensed under cc by-nc-nd 3.0 and cc by nc")
    assert base == [("cc-by-nc", 3), ("cc-by-nc", 10)]
    assert [f[:2] for f in found] == [("cc-by-nc-nd", "grant:cc-by-nc-nd")]
    assert found[0][2:] == (1, 9) and words == 13 and 0.9 < score <= 1


def test_query_against_brute_force(spark, small_docs):
    got = {r.doc_id: r for r in op8_license_scan(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == small_docs.count()
    for row in small_docs.collect():
        n, places = plain_base(row.text)
        r = got[row.doc_id]
        starts = [i for _, i in places]
        assert (r.n_words, r.n_base) == (n, len(places))
        assert (r.first_word, r.last_word) == ((min(starts), max(starts)) if starts else (None, None))
        assert r.base_labels == ",".join(sorted({p[0] for p in places}))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1
    assert any(r.n_base for r in got.values())


def test_gated_scan_equals_running_every_rule(small_docs):
    for row in small_docs.collect():
        words = " ".join(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", row.text.translate(LOWER)))
        line = f" {words} ".encode()
        hits = {r.label for r in RULES if r.pattern.search(line)}
        assert {f[0] for f in scan(row.text.encode())[2]} <= hits
        assert bool(hits) == bool(scan(row.text.encode())[2])


def test_edge_cases(make_docs):
    docs = make_docs([(1, None), (2, ""), (None, "mit license"), (3, "z " * 200_000 + "under the MIT license"), (3, "cc by nc cc by nc")])
    docs = docs.withColumnsRenamed({"lang": "found", "source": "score"})
    got = sorted(((r.doc_id, r.n_words, [tuple(b) for b in r.base]) for r in scan_licenses(docs).collect()), key=repr)
    assert got == [
        (1, 0, []), (2, 0, []), (3, 200_004, [("mit", 200_000)]), (3, 6, [("cc-by-nc", 0), ("cc-by-nc", 3)]), (None, 2, []),
    ]
    assert scan_licenses(make_docs([])).count() == 0


def spelled(parsed, rng):
    """A random text that the expression matches, each optional part there or not."""
    out = ""
    for op, arg in parsed:
        kind = str(op)
        if kind == "LITERAL":
            out += chr(arg)
        elif kind == "IN":
            name, value = rng.choice(arg)
            out += {"LITERAL": lambda: chr(value), "RANGE": lambda: chr(value[0]), "CATEGORY": lambda: "x", "NEGATE": lambda: ""}[str(name)]()
        elif kind in ("NOT_LITERAL", "ANY"):
            out += "x"
        elif kind == "BRANCH":
            out += spelled(rng.choice(arg[1]), rng)
        elif kind == "SUBPATTERN":
            out += spelled(arg[3], rng)
        elif kind in ("MAX_REPEAT", "MIN_REPEAT"):
            out += "".join(spelled(arg[2], rng) for _ in range(rng.randint(arg[0], min(arg[1], arg[0] + 1))))
        elif kind not in ("ASSERT", "ASSERT_NOT"):
            raise ValueError(kind)
    return out


@pytest.mark.parametrize("rule", RULES, ids=lambda r: r.name)
def test_the_gate_is_open_with_and_without_every_optional_part(rule):
    rng, parsed = random.Random(rule.name), re._parser.parse(rule.pattern.pattern.decode())
    texts = {spelled(parsed, rng) for _ in range(80)}
    assert any(rule.pattern.search(f"{t} ".encode()) for t in texts)
    for text in texts:
        if rule.pattern.search(f"{text} ".encode()):
            assert all(not frozenset(text.encode().split()).isdisjoint(group) for group in rule.needs), text
            assert scan(text.encode())[2], text


@pytest.mark.parametrize(
    "text, expected",
    [
        ("licensed under GPLv3", ["gpl-3"]),
        ("licensed under AGPLv3", ["agpl-3"]),
        ("released under LGPLv2.1", ["lgpl-2.1"]),
        ("licensed under EPLv1", ["epl-1"]),
        ("for non-commercial use only", ["non-commercial"]),
        ("Proprietary and confidential", ["proprietary"]),
    ],
)
def test_names_written_as_one_word_and_texts_without_other_needed_words(text, expected):
    assert labels(text) == expected


def plain_scan(text):
    """Labels and score with every rule run over the whole text and every place compared with every other."""
    words = re.findall(rb"[a-z0-9\x80-\xff]+", text.lower())
    line = b" " + b" ".join(words) + b" "
    kept = []
    for rule in RULES:
        spans = [m.span() for m in rule.pattern.finditer(line)]
        kept += [(a, b, rule) for a, b in spans if not any(x <= a and b <= y for x, y, _ in kept)]
    base = {label for phrase, label in BASE_PHRASES.items() if b" " + phrase.encode() + b" " in line}
    missing = 0.1 if base else 1.0
    for weight in {r.name: r.weight for _, _, r in kept}.values():
        missing *= 1 - weight
    return base, base | {r.label for _, _, r in kept}, 1 - missing


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_labels_and_score_of_the_query_against_plain_code(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").collect()}
    rows = QUERIES["op8_license_scan"](spark, f"/root/testdata/{sf}").collect()
    assert len(rows) == len(texts)
    for r in rows:
        base, labels, score = plain_scan((texts[r.doc_id] or "").encode())
        assert (r.base_labels, r.labels) == (",".join(sorted(base)), ",".join(sorted(labels)))
        assert r.score == pytest.approx(score)


@pytest.mark.parametrize("n", [1, 40, 5000])
def test_a_holder_may_be_of_any_length(n):
    holder = "some holder " * n
    bsd = f"Neither the name of {holder} nor the names of its contributors may be used to endorse"
    cc0 = f"To the extent possible under law, {holder} has waived all copyright"
    for text, label in ((bsd, "bsd-3-clause"), (cc0, "cc0")):
        assert label in {f[0] for f in scan(text.encode())[2]}
        twice = scan((text.split(holder)[0] + text).encode())[2]
        assert [f[0] for f in twice].count(label) == 1


def test_openings_without_an_end_are_read_once():
    start = time.perf_counter()
    scan(b"neither the name of contributors endorse " * 20_000)
    assert time.perf_counter() - start < 20
