"""Byte-level BPE as a deterministic automaton over tokens.

The automaton accepts exactly the token sequences that BPE produces (Berglund et al., "Constructing a
BPE Tokenization DFA"). It starts as one state with a loop for every byte. Each merge (u, v) adds a
gadget, in rank order: the state that u leads to loses its arc v, and where a path u v led, an arc for
the merged token now leads to the same place. As every arc of a label leads to one state, a state is
named by the token that entered it. A gadget copies on write: the state of the merged token is that of
v as it was at that time, and its arc exists wherever u's did at that time. A state is therefore a
short chain of (token, time) and a removed arc one entry of a table.

A word is encoded from left to right by the arcs of the state it is in, longest label first; every
prefix has exactly one accepted token sequence. Decoding emits the arcs' labels.

Texts are cut as byte-level BPE does (the pattern of the public rank files; added tokens of the file
match first). The encoding equals the library's for every text. Null counts as empty: no ids. Texts are
never cut; rows stay as they are, repeated or not. A null id stays null.
"""

from __future__ import annotations

import functools
import json
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlens.llm.staging import ship_package

VOCABULARY = "byte_bpe_50k.json"
_NEVER = 1 << 60
_WORDS_HELD = 500_000
_LONGEST_HELD = 64
_ARCS_HELD = 1_000_000
_IDS_PER_BATCH = 4_000_000


def byte_alphabet() -> dict[str, int]:
    """The printable character that byte-level vocabulary files write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class MergeAutomaton:
    def __init__(self, labels: dict[bytes, int], merges: list[tuple[bytes, bytes]]):
        self.ids = labels
        self.labels = {i: label for label, i in labels.items()}
        # Lengths of the labels that begin with these four bytes, longest first.
        lengths: dict[bytes, set[int]] = {}
        for label in labels:
            if len(label) >= 4:
                lengths.setdefault(label[:4], set()).add(len(label))
        self._lengths = {begin: tuple(sorted(found, reverse=True)) for begin, found in lengths.items()}
        # The next shorter label that a label begins with, and its token; a byte has none.
        self._shorter: dict[int, tuple[int, int] | None] = {}
        for label, token in labels.items():
            end = next((k for k in range(len(label) - 1, 0, -1) if label[:k] in labels), 0)
            self._shorter[token] = (labels[label[:end]], end) if end else None
        # Chains of (token, time): of the state behind a token, and of what its arc hangs on.
        self.behind = {labels[b]: ((labels[b], _NEVER),) for b in labels if len(b) == 1}
        self.before = dict(self.behind)
        self.removed: dict[tuple[int, int], int] = {}
        self._arcs: dict[int, bool] = {}
        for time, (left, right) in enumerate(merges):
            u, v, merged = labels[left], labels[right], labels[left + right]
            if not self._has_arc(u, v):
                raise ValueError(f"merge {time} joins tokens that never meet")
            behind_v = self.behind[v]
            self.behind[merged] = ((merged, _NEVER), (v, time), *behind_v[1:])
            self.before[merged] = ((merged, _NEVER), (u, time), *self.before[u][1:])
            self.removed[u, v] = time

    #: The state before the first token: no arc of it has been removed.
    START = (1 << 20) - 1

    def _has_arc(self, state: int, token: int) -> bool:
        removed = self.removed
        for a, until_a in self.behind.get(state, ()):
            for b, until_b in self.before[token]:
                gone = removed.get((a, b))
                if gone is not None and gone < until_a and gone <= until_b:
                    return False
        return True

    def has_arc(self, state: int, token: int) -> bool:
        """An entry of the transition table, which is filled as words need it."""
        if len(self._arcs) > _ARCS_HELD:
            self._arcs.clear()
        arc = self._arcs[state << 32 | token] = self._has_arc(state, token)
        return arc

    def _longest(self, word: bytes, begin: int) -> tuple[int, int]:
        """Token and length of the longest label that stands at a place."""
        ids = self.ids
        for length in self._lengths.get(word[begin : begin + 4], ()):
            label = word[begin : begin + length]
            if label in ids:
                return ids[label], len(label)
        for length in (3, 2, 1):
            label = word[begin : begin + length]
            if label in ids:
                return ids[label], len(label)
        raise ValueError("a byte has no token")

    def encode(self, word: bytes) -> list[int]:
        """Follow the longest labels first; a place that leads nowhere is not tried again.

        A prefix has one accepted sequence, so how a place was reached does not matter.
        """
        whole = self.ids.get(word)
        if whole is not None:
            return [whole]
        n, known, longest, shorter = len(word), self._arcs.get, self._longest, self._shorter
        tokens: list[int] = []
        begins: list[int] = []
        dead: set[int] = set()
        begin, state = 0, self.START
        token, length = longest(word, 0)
        while True:
            end = begin + length
            if end not in dead:
                arc = known(state << 32 | token)
                if arc is None:
                    arc = self.has_arc(state, token)
                if arc:
                    tokens.append(token)
                    if end == n:
                        return tokens
                    begins.append(begin)
                    begin, state = end, token
                    token, length = longest(word, begin)
                    continue
            less = shorter[token]
            while less is None:
                if not tokens:
                    raise ValueError("a byte has no token")
                dead.add(begin)
                begin = begins.pop()
                less = shorter[tokens.pop()]
                state = tokens[-1] if tokens else self.START
            token, length = less


class ByteBpe:
    """Encoder and decoder for one vocabulary file of the tokenizers library's format."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        bytes_of = byte_alphabet()

        def raw(token: str) -> bytes:
            return bytes(bytes_of[c] for c in token)

        model = spec["model"]
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        vocabulary = {raw(t): i for t, i in model["vocab"].items() if t not in added}
        self.automaton = MergeAutomaton(vocabulary, [(raw(a), raw(b)) for a, b in merges])
        self.added = added
        self.labels = self.automaton.labels | {i: t.encode() for t, i in added.items()}
        self.words = regex.compile(public_tokenizers.PATTERN)
        self.special = regex.compile("|".join(map(regex.escape, sorted(added, key=len, reverse=True)))) if added else None
        self._pieces: dict[str, list[int]] = {}

    def _words(self, text: str) -> array:
        """The ids of a text's words; words met before are looked up."""
        out, pieces = [], self._pieces
        known = pieces.get
        for word in self.words.findall(text):
            ids = known(word)
            if ids is None:
                if len(pieces) >= _WORDS_HELD:
                    pieces.clear()
                ids = array("i", self.automaton.encode(word.encode()))
                if len(word) <= _LONGEST_HELD:
                    pieces[word] = ids
            out += ids
        return array("i", out)

    def encode(self, text: str) -> array:
        if not self.special or not any(t in text for t in self.added):
            return self._words(text)
        out, at = array("i"), 0
        for hit in self.special.finditer(text):
            out.extend(self._words(text[at : hit.start()]))
            out.append(self.added[hit[0]])
            at = hit.end()
        out.extend(self._words(text[at:]))
        return out

    def decode(self, ids) -> str:
        labels = self.labels
        return b"".join([labels[i] for i in ids]).decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def byte_bpe(path: str) -> ByteBpe:
    """Compiled once in each Python worker."""
    return ByteBpe(path)


def _pieces(lengths: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges whose lengths add up to about a limit; a longer row is a range of its own."""
    group = np.cumsum(lengths) // limit
    cuts = np.flatnonzero(np.diff(group)) + 1
    yield from zip([0, *cuts.tolist()], [*cuts.tolist(), len(lengths)])


def _list_array(rows: list[array]) -> pa.Array:
    lengths = np.fromiter(map(len, rows), np.int64, len(rows))
    flat = np.concatenate([np.frombuffer(row, np.int32) for row in rows if row] or [np.zeros(0, np.int32)])
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lengths)).astype(np.int32)), pa.array(flat))


def encode(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, decoded: bool = False
) -> DataFrame:
    """doc_id and ids of every row; `decoded` adds the text decoded from these ids."""
    path = path or public_tokenizers.path(VOCABULARY)
    names = ["doc_id", "ids", *(["decoded"] if decoded else [])]

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path)
        for batch in it:
            lengths = np.array([len(t.as_buffer() or b"") if t.is_valid else 0 for t in batch.column(1)], np.int64)
            for a, b in _pieces(lengths, _IDS_PER_BATCH) if len(batch) else ():
                ids = [bpe.encode(t.as_py() or "") for t in batch.column(1)[a:b]]
                out = [batch.column(0)[a:b], _list_array(ids)]
                if decoded:
                    out.append(pa.array([bpe.decode(row) for row in ids], pa.string()))
                yield pa.record_batch(out, names=names)

    ship_package(docs.sparkSession)
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id long, ids array<int>" + (", decoded string" if decoded else "")
    return picked.mapInArrow(batches, schema)


def decode(tokens: DataFrame, ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """The rows of `tokens` with a column `decoded`; null or empty ids give an empty text."""
    path = path or public_tokenizers.path(VOCABULARY)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path)
        for batch in it:
            texts = [bpe.decode(row.as_py() or []) for row in batch.column(ids_col)]
            yield batch.append_column("decoded", pa.array(texts, pa.string()))

    ship_package(tokens.sparkSession)
    rest = tokens.drop("decoded")
    return rest.mapInArrow(batches, T.StructType([*rest.schema.fields, T.StructField("decoded", T.StringType())]))
