"""License scan by ordered signature rules.

A rule is a regular expression over the text's words, a label, a priority and the words it cannot match
without. A text is first asked which of all rules' words it has; only rules whose words are all there
run. Of the places found, one that lies within a place of a rule at least as strong is dropped, so a
statement of "GPL version 3 or later" is not also reported as "GPL" and "GPL 3". Rules come from two
hand-written tables: how licenses are named, and the forms in which texts refer to them.

Beside them stand the base phrases, exact word sequences that are always reported, dropped by no rule.

Words are runs of digits, a-z and non-ASCII characters after lower-casing A-Z; null counts as empty.
Whole texts are read; rows stay as they are, repeated or not. Only the id and text columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from re import _constants, _parser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlens.llm.staging import ship_package

BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# How a license is named: label, names as expressions over words, SPDX identifiers as words.
NAMES = [
    ("mit", r"mit|expat|mit x11", r"mit"),
    ("mit-0", r"mit no attribution|mit 0", r"mit 0"),
    ("x11", r"x11", r"x11"),
    ("isc", r"isc|internet systems consortium", r"isc"),
    ("0bsd", r"0bsd|zero clause bsd|bsd zero clause", r"0bsd"),
    ("bsd-2-clause", r"bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd|freebsd", r"bsd 2 clause"),
    ("bsd-3-clause", r"bsd 3 clause|3 clause bsd|three clause bsd|new bsd|modified bsd|revised bsd", r"bsd 3 clause"),
    ("bsd-4-clause", r"bsd 4 clause|4 clause bsd|four clause bsd|original bsd", r"bsd 4 clause"),
    ("bsd", r"bsd|bsd style|berkeley software distribution", r"bsd"),
    ("apache-1", r"apache(?: software)? 1(?: [01])?|apache(?: software)? license v(?:ersion )?1(?: [01])?", r"apache 1 [01]"),
    (
        "apache-2",
        r"apache(?: software)? 2(?: 0)?|apache(?: software)? licen[cs]e (?:v|version |v )?2(?: 0)?|asl 2(?: 0)?",
        r"apache 2 0",
    ),
    ("apache", r"apache(?: software)?", r"apache"),
    ("gpl-1", r"(?:gnu )?gpl ?v?1(?: 0)?|gnu general public license (?:v|version )1", r"gpl 1 0(?: only)?"),
    ("gpl-2", r"(?:gnu )?gpl ?v?2(?: 0)?|gnu general public license (?:v|version )2(?: 0)?", r"gpl 2 0(?: only)?"),
    ("gpl-3", r"(?:gnu )?gpl ?v?3(?: 0)?|gnu general public license (?:v|version )3(?: 0)?", r"gpl 3 0(?: only)?"),
    (
        "gpl-2-or-later",
        r"(?:gnu )?gpl ?v?2(?: 0)? or (?:later|any later version)|gnu general public license (?:v|version )2(?: 0)? or any later version",
        r"gpl 2 0 or later",
    ),
    (
        "gpl-3-or-later",
        r"(?:gnu )?gpl ?v?3(?: 0)? or (?:later|any later version)|gnu general public license (?:v|version )3(?: 0)? or any later version",
        r"gpl 3 0 or later",
    ),
    ("gpl", r"gnu gpl|gpl|gnu general public", r"gpl"),
    ("lgpl-2", r"lgpl ?v?2(?: 0)?|gnu library general public license version 2", r"lgpl 2 0(?: only| or later)?"),
    ("lgpl-2.1", r"lgpl ?v?2 1|gnu lesser general public license (?:v|version )2 1", r"lgpl 2 1(?: only| or later)?"),
    ("lgpl-3", r"lgpl ?v?3(?: 0)?|gnu lesser general public license (?:v|version )3", r"lgpl 3 0(?: only| or later)?"),
    ("lgpl", r"gnu lgpl|lgpl|gnu (?:lesser|library) general public", r"lgpl"),
    ("agpl-3", r"agpl ?v?3(?: 0)?|gnu affero general public license (?:v|version )3", r"agpl 3 0(?: only| or later)?"),
    ("agpl", r"gnu agpl|agpl|gnu affero general public", r"agpl"),
    ("gfdl", r"gfdl|gnu free documentation", r"gfdl 1 [123](?: only| or later)?"),
    ("mpl-1.1", r"mpl ?v?1 1|mozilla public license (?:v|version )1 1", r"mpl 1 1"),
    ("mpl-2", r"mpl ?v?2(?: 0)?|mozilla public license (?:v|version )2(?: 0)?", r"mpl 2 0"),
    ("mpl", r"mpl|mozilla public", r"mpl"),
    ("epl-1", r"epl ?v?1(?: 0)?|eclipse public license (?:v|version )1(?: 0)?", r"epl 1 0"),
    ("epl-2", r"epl ?v?2(?: 0)?|eclipse public license (?:v|version )2(?: 0)?", r"epl 2 0"),
    ("cddl", r"cddl|common development and distribution", r"cddl 1 [01]"),
    ("cpl", r"common public", r"cpl 1 0"),
    ("eupl", r"eupl|european union public", r"eupl 1 [012]"),
    ("cecill", r"cecill(?: [abc])?", r"cecill [12] [01]"),
    ("artistic-2", r"artistic 2(?: 0)?|artistic license 2(?: 0)?", r"artistic 2 0"),
    ("artistic", r"artistic|clarified artistic", r"artistic 1 0"),
    ("boost", r"boost|boost software", r"bsl 1 0"),
    ("busl", r"business source", r"busl 1 1"),
    ("sspl", r"server side public", r"sspl 1 0"),
    ("elastic-2", r"elastic 2 0|elastic", r"elastic 2 0"),
    ("zlib", r"zlib|zlib libpng", r"zlib"),
    ("openssl", r"openssl|ssleay", r"openssl"),
    ("postgresql", r"postgresql", r"postgresql"),
    ("python", r"psf|python software foundation", r"python 2 0|psf 2 0"),
    ("php", r"php", r"php 3 0(?:1)?"),
    ("ruby", r"ruby", r"ruby"),
    ("ncsa", r"ncsa|university of illinois ncsa open source", r"ncsa"),
    ("afl", r"academic free", r"afl 3 0"),
    ("osl", r"open software", r"osl 3 0"),
    ("upl", r"universal permissive", r"upl 1 0"),
    ("ms-pl", r"microsoft public|ms pl", r"ms pl"),
    ("ms-rl", r"microsoft reciprocal|ms rl", r"ms rl"),
    ("unlicense", r"unlicense", r"unlicense"),
    ("wtfpl", r"wtfpl|do what the fuck you want to public", r"wtfpl"),
    ("ofl", r"sil open font|open font", r"ofl 1 1"),
    ("odbl", r"odbl|open database|odc open database", r"odbl 1 0"),
    ("odc-by", r"open data commons attribution|odc attribution|odc by", r"odc by 1 0"),
    ("pddl", r"public domain dedication and|pddl", r"pddl 1 0"),
    ("vim", r"vim", r"vim"),
    ("json", r"json", r"json"),
    ("cc0", r"cc0(?: 1 0)?|cc zero|creative commons zero", r"cc0 1 0"),
    ("cc-by", r"cc by(?: [1-4] 0)?|creative commons attribution(?: [1-4] 0)?", r"cc by [1-4] 0"),
    ("cc-by-sa", r"cc by sa(?: [1-4] 0)?|creative commons attribution share ?alike(?: [1-4] 0)?", r"cc by sa [1-4] 0"),
    ("cc-by-nd", r"cc by nd(?: [1-4] 0)?|creative commons attribution no ?deriv\w*(?: [1-4] 0)?", r"cc by nd [1-4] 0"),
    ("cc-by-nc", r"cc by nc(?: [1-4] 0)?|creative commons attribution non ?commercial(?: [1-4] 0)?", r"cc by nc [1-4] 0"),
    (
        "cc-by-nc-sa",
        r"cc by nc sa(?: [1-4] 0)?|creative commons attribution non ?commercial share ?alike(?: [1-4] 0)?",
        r"cc by nc sa [1-4] 0",
    ),
    (
        "cc-by-nc-nd",
        r"cc by nc nd(?: [1-4] 0)?|creative commons attribution non ?commercial no ?deriv\w*(?: [1-4] 0)?",
        r"cc by nc nd [1-4] 0",
    ),
]

_TAIL = r"(?: (?:public )?licen[cs]es?)?(?: (?:v|version )?[0-9](?: [0-9])?)?(?: international)?"
# The forms: name, priority, weight of evidence, expression around a name, whether it must say "license".
FORMS = [
    ("tag", 100, 0.95, r"spdx license identifier (?:{spdx})", False),
    ("grant", 80, 0.9, r"(?:is |are )?(?:dual )?licen[cs]ed under (?:the )?(?:terms of the )?(?:{name})" + _TAIL, False),
    (
        "release",
        70,
        0.85,
        r"(?:released|distributed|published|available|provided|shared|covered|redistribute it) (?:\w+ )?"
        r"(?:under|by) (?:the )?(?:terms of the )?(?:{name})" + _TAIL,
        False,
    ),
    ("terms", 65, 0.8, r"under (?:the )?(?:terms (?:and conditions )?of the )?(?:{name})(?: public)? licen[cs]e", True),
    ("field", 60, 0.7, r"licen[cs]e (?:is )?(?:the )?(?:{name})(?: licen[cs]e)?", True),
    ("name", 40, 0.5, r"(?:{name})(?: public)? licen[cs]e", True),
]
# A holder may be of any length: the place runs from the last opening before the closing words, so that a
# text of openings alone is still read once.
# Wordings of their own: label, priority, weight, expression, words it cannot match without (a|b: one of them).
TEXTS = [
    ("mit", 90, 0.9, r"permission is hereby granted free of charge to any person obtaining a copy of this software", "permission hereby granted charge"),
    ("isc", 90, 0.9, r"permission to use copy modify and or distribute this software for any purpose with or without fee", "permission distribute fee"),
    ("bsd", 85, 0.9, r"redistribution and use in source and binary forms with or without modification are permitted", "redistribution binary permitted"),
    ("bsd-3-clause", 90, 0.9, r"neither the name of (?:(?!neither the name of ).)+? nor the names of its contributors may be used to endorse", "neither contributors endorse"),
    ("zlib", 90, 0.9, r"this software is provided as is without any express or implied warranty in no event will the authors", "provided warranty authors"),
    ("unlicense", 90, 0.9, r"this is free and unencumbered software released into the public domain", "unencumbered domain"),
    ("wtfpl", 90, 0.9, r"you just do what the fuck you want to", "just what want"),
    ("boost", 90, 0.9, r"boost software license version 1 0", "boost software"),
    ("mpl-2", 90, 0.9, r"this source code form is subject to the terms of the mozilla public license v 2 0", "source mozilla"),
    ("gpl", 85, 0.9, r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "program redistribute gnu"),
    ("lgpl", 85, 0.9, r"this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license", "library redistribute gnu"),
    ("cc0", 90, 0.9, r"to the extent possible under law (?:(?!to the extent possible under law ).)+? waived all copyright", "extent waived copyright"),
    ("public-domain", 50, 0.6, r"(?:placed|dedicated|released|released in|in) (?:in|into|to)? ?the public domain", "public domain"),
    ("all-rights-reserved", 50, 0.6, r"all rights reserved", "rights reserved"),
    ("proprietary", 50, 0.6, r"proprietary and confidential|unauthori[sz]ed copying of this file", "proprietary|unauthorized|unauthorised"),
    ("copyright", 30, 0.3, r"copyright (?:c )?(?:19|20)[0-9]{2}", "copyright"),
    ("non-commercial", 45, 0.5, r"for non ?commercial (?:use|purposes) only", "non|noncommercial"),
]

_WORDS = bytes(b + 32 if 65 <= b < 91 else b if 48 <= b < 58 or 97 <= b < 123 or b > 127 else 32 for b in range(256))


@dataclass(frozen=True)
class Rule:
    name: str
    label: str
    priority: int
    weight: float
    pattern: re.Pattern[bytes]
    needs: tuple[frozenset[bytes], ...]  # one word of each set must be in the text


def _needs(*groups: str) -> tuple[frozenset[bytes], ...]:
    return tuple(frozenset(w.encode() for w in g.split()) for g in groups if g)


def _heads(parsed) -> set[str]:
    """All that a match can begin with, up to its first space (which is then the last character)."""
    heads = {""}
    for op, arg in parsed:
        if all(h.endswith(" ") for h in heads):
            break
        if op is _constants.LITERAL:
            parts = {chr(arg)}
        elif op is _constants.IN and all(kind is _constants.LITERAL for kind, _ in arg):
            parts = {chr(c) for _, c in arg}
        elif op is _constants.BRANCH:
            parts = set().union(*map(_heads, arg[1]))
        elif op is _constants.SUBPATTERN:
            parts = _heads(arg[3])
        elif op is _constants.MAX_REPEAT and arg[:2] == (0, 1):
            parts = {"", *_heads(arg[2])}
        else:
            raise ValueError(f"a name cannot begin with {op}")
        heads = {h + p for h in heads if not h.endswith(" ") for p in parts} | {h for h in heads if h.endswith(" ")}
    return heads


def _first_words(names: str) -> str:
    """Every word that a match can begin with: without any of them no name matches."""
    return " ".join(sorted({h.strip() for h in _heads(_parser.parse(names))}))


def _compiled(expression: str) -> re.Pattern[bytes]:
    return re.compile(b" (?:" + expression.encode() + b")(?= )")


def build_rules() -> list[Rule]:
    rules = []
    for label, names, spdx in NAMES:
        for form, priority, weight, around, says_license in FORMS:
            tag = "{spdx}" in around
            needs = _needs("spdx" if tag else _first_words(names), "license licence" if says_license else "")
            rules.append(
                Rule(f"{form}:{label}", label, priority, weight, _compiled(around.format(name=names, spdx=spdx)), needs)
            )
    for label, priority, weight, expression, words in TEXTS:
        rules.append(Rule(f"text:{label}", label, priority, weight, _compiled(expression), _needs(*(w.replace("|", " ") for w in words.split()))))
    # Of equal forms the license with the longer label is the more exact one.
    return sorted(rules, key=lambda r: (-r.priority, -len(r.label), r.name))


RULES = build_rules()
_GATE = frozenset(w for r in RULES for g in r.needs for w in g)
_BASE = {b" " + p.encode() + b" ": label for p, label in BASE_PHRASES.items()}


def scan(text: bytes) -> tuple[int, list[tuple[str, int]], list[tuple[str, str, int, int]], float]:
    """Words, base places (label, first word), places (label, rule, first word, word after), score."""
    words = text.translate(_WORDS).split()
    present = _GATE.intersection(words)
    if not present:
        return len(words), [], [], 0.0
    line = b" " + b" ".join(words) + b" "
    base = []
    for phrase, label in _BASE.items():
        at = line.find(phrase)
        while at >= 0:
            base.append((label, line.count(b" ", 0, at)))
            at = line.find(phrase, at + 1)
    kept: list[tuple[int, int, Rule]] = []
    for rule in RULES:  # strongest first
        if all(not present.isdisjoint(group) for group in rule.needs):
            spans = [(m.start(), m.end()) for m in rule.pattern.finditer(line)]
            if spans:
                inside = _contained(spans, kept)
                kept += [(a, b, rule) for (a, b), covered in zip(spans, inside) if not covered]
    found, missing = [], 1.0
    for a, b, rule in sorted(kept, key=lambda k: (k[0], k[1], k[2].name)):
        first = line.count(b" ", 0, a)
        found.append((rule.label, rule.name, first, first + line.count(b" ", a, b)))
    for weight in {r.name: r.weight for _, _, r in kept}.values():
        missing *= 1 - weight
    if base:
        missing *= 0.1
    return len(words), sorted(base, key=lambda p: p[1]), found, 1 - missing


def _contained(spans: list[tuple[int, int]], kept: list[tuple[int, int, Rule]]) -> list[bool]:
    """Which of the ascending spans lie within a kept place; one sweep over both."""
    places = sorted((a, b) for a, b, _ in kept)
    out, i, reach = [], 0, -1
    for a, b in spans:
        while i < len(places) and places[i][0] <= a:
            reach = max(reach, places[i][1])
            i += 1
        out.append(b <= reach)
    return out


SCHEMA = (
    "doc_id long, n_words long, base array<struct<label:string,start:long>>, "
    "found array<struct<label:string,rule:string,start:long,end:long>>, score double"
)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document with its base places, the places the rules leave, and a score from 0 to 1."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base_type = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64())]))
        found_type = pa.list_(
            pa.struct([("label", pa.string()), ("rule", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        )
        for batch in it:
            rows = [scan(t.as_py() or b"") for t in batch.column(1)]
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([[dict(zip(("label", "start"), p)) for p in r[1]] for r in rows], base_type),
                    pa.array([[dict(zip(("label", "rule", "start", "end"), p)) for p in r[2]] for r in rows], found_type),
                    pa.array([r[3] for r in rows], pa.float64()),
                ],
                names=["doc_id", "n_words", "base", "found", "score"],
            )

    ship_package(docs.sparkSession)
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return picked.mapInArrow(batches, SCHEMA)
