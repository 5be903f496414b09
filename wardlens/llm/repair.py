"""Token ids in files of Re-Pair compressed shards, with random access.

Documents are sorted by id and cut into shards of bounded size. In a shard frequent pairs of
neighbouring ids become new symbols, again and again, until no pair is frequent (Larsson and Moffat,
"Off-line dictionary-based compression"). A round takes many pairs at once: where two of them overlap
the more frequent one wins, the other waits for the next round. Later rounds count only the places beside
a new symbol and those that waited: no other pair can have become frequent. A word's ids are the same
wherever it stands, so pairs inside words are counted and replaced in the shard's list of words, weighted
by how often each occurs, and pairs across words in the text itself. No pair spans two documents.

A shard (all little-endian): the header `HEADER`; of each document the id, a null mark, the first token
and the first symbol; of each rule its two symbols and its expansion length; the symbols. Symbols below
`base` are token ids, `base + r` is rule r. Any document is decoded from its own symbols, and any range
of its tokens from those the lengths point at, without the rest of the shard.

Every document ends with `end_id`. Null text counts as empty, leaving just that. Repeated ids keep a row
each, in the order of their texts' hashes; null ids come first. An empty table gives no shards.

Encoding is that of the tokenizers library: normalizing and splitting follow the file, once for each
distinct word, and the library's model cuts the pieces.
"""

from __future__ import annotations

import codecs
import functools
import json
import struct
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardlens.llm.bpe_automaton import byte_alphabet
from wardlens.llm.staging import partitions, ship_package
from wardlens.operators.broadcasting import checked_broadcast

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
SHARD_IDS = 2_500_000
LEAST_USES = 64

HEADER = struct.Struct("<4sIIIQQI")  # mark, base, documents, rules, symbols, tokens, bytes of a symbol
_MARK = b"RPG1"
_PIECES_HELD = 300_000
_ENDS_WORD = frozenset(",.!?;:")
SHARDS = "part int, seq int, n_docs long, n_ids long, payload binary"


class WordEncoder:
    """Ids of words between ASCII white space, as the library gives them in any text.

    A word is normalized and split into pieces as the file says; each new piece goes to the library's
    model once. All pieces seen lie end to end in `flat`, a piece's ids from `bounds[k]` to `bounds[k + 1]`.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.whole = Tokenizer.from_file(path)
        self.added = [t["content"] for t in spec["added_tokens"]]
        self.pieces = Tokenizer(self.whole.model)
        self.pieces.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.base = max([*model["vocab"].values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        self.ends_piece = np.zeros(self.base, bool)
        self.ends_piece[[i for t, i in model["vocab"].items() if t.endswith(model["end_of_word_suffix"])]] = True
        chars = {b: c for c, b in byte_alphabet().items()}
        self.alphabet = "".join(chars[b] for b in range(256))
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.bounds = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def split(self, word: str) -> tuple[str, ...] | list[str]:
        """The word's pieces in the byte alphabet. A piece that starts with a space is a whole odd word."""
        plain = word.isascii()
        if not plain and not unicodedata.is_normalized("NFC", word):
            word = unicodedata.normalize("NFC", word)
        if not word.isprintable() or "|>" in word:  # control characters, odd white space, added tokens
            return (" " + word,)
        low = word.lower() if plain or "\u03a3" not in word else "".join([c.lower() for c in word])
        if low.isalpha():
            found = (low,)
        elif low[-1:] in _ENDS_WORD and low[:-1].isalpha():
            found = (low[:-1], low[-1])
        else:
            found = self.pattern.findall(low)
        if plain:
            return found
        return [p if p.isascii() else codecs.charmap_decode(p.encode(), "strict", self.alphabet)[0] for p in found]

    def _learn(self, pieces: list[str]) -> None:
        normal = [p for p in pieces if p[0] != " "]
        ids = np.array(self.pieces.encode_batch_fast([" ".join(normal)], add_special_tokens=False)[0].ids, np.int32)
        lengths = np.diff(np.flatnonzero(self.ends_piece[ids]), prepend=-1)
        if len(lengths) != len(normal):
            raise ValueError("the model does not end every piece with an end-of-word token")
        odd = [p for p in pieces if p[0] == " "]
        whole = [e.ids for e in self.whole.encode_batch([p[1:] for p in odd], add_special_tokens=False)]
        for p in (*normal, *odd):
            self.known[p] = len(self.known)
        self.flat = np.concatenate([self.flat, ids, *(np.array(w, np.int32) for w in whole)])
        lengths = np.concatenate([lengths, np.array([len(w) for w in whole], np.int64)])
        self.bounds = np.append(self.bounds, self.bounds[-1] + np.cumsum(lengths))

    def split_all(self, words: list[str]) -> list[tuple[str, ...] | list[str]]:
        """`split` of every word, quicker for plain words, which are lower-cased together."""
        lower = "\n".join(words).lower().split("\n") if words else []
        split = self.split
        return [
            (low,)
            if low.isalpha() and word.isascii()
            else (low[:-1], low[-1])
            if low[-1:] in _ENDS_WORD and low[:-1].isalpha() and word.isascii()
            else split(word)
            for word, low in zip(words, lower)
        ]

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids, end to end, of words without ASCII white space, and how many each has."""
        found = self.split_all(words)
        counts = np.fromiter(map(len, found), np.int64, len(found))
        pieces = list(chain.from_iterable(found))
        new = list({p for p in pieces if p not in self.known})
        if new:
            if len(self.known) + len(new) > _PIECES_HELD:
                self._forget()
                new = list(set(pieces))
            self._learn(new)
        which = np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))
        ids, lengths = _gather(self.flat, self.bounds, which)
        owner = np.repeat(np.arange(len(words)), counts)
        return ids, np.bincount(owner, weights=lengths, minlength=len(words)).astype(np.int64)


@functools.lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def _gather(flat: np.ndarray, offsets: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs flat[offsets[w]:offsets[w + 1]] for each w in `which`, end to end, and their lengths."""
    lengths = np.diff(offsets)[which]
    shift = offsets[which] - (np.cumsum(lengths) - lengths)
    return flat[np.repeat(shift, lengths) + np.arange(lengths.sum())], lengths


class Grammar:
    def __init__(self, base: int):
        self.base = base
        self.rules = np.zeros((0, 2), np.int64)

    def shorten(
        self, symbols: np.ndarray, group: np.ndarray, weight: np.ndarray | None, least: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """Rounds until no pair has `least` uses; the symbols left and the group of each."""
        at = None
        while (done := self.round(symbols, group, weight, least, at)) is not None:
            keep, at = done
            symbols, group = symbols[keep], group[keep]
            weight = None if weight is None else weight[keep]
        return symbols, group

    def round(
        self, symbols: np.ndarray, group: np.ndarray, weight: np.ndarray | None, least: int, at: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray] | None:
        """Replace the pairs of at least `least` uses; None if there are none.

        `group` tells which places belong together; `weight` how often each place counts; `at` where pairs
        begin that may be frequent, all places if not given. The symbols change in place: where a pair is
        replaced its first place takes the new symbol. Returned are a mask of the places kept and, counted
        among those, the `at` of the next round.
        """
        top = self.base + len(self.rules)
        if at is None:
            uses = np.bincount(symbols, weights=weight, minlength=top)
            # A pair is at most as frequent as either symbol.
            often = uses[symbols] >= least
            at = np.flatnonzero(often[:-1] & often[1:] & (group[:-1] == group[1:]))
        else:
            at = at[at + 1 < len(symbols)]
            at = at[group[at] == group[at + 1]]
        if not len(at):
            return None
        keys = symbols[at].astype(np.int64) * top + symbols[at + 1]
        if weight is None:
            ordered = np.sort(keys)
            first = np.flatnonzero(np.diff(ordered, prepend=-1))
            pairs, counts = ordered[first], np.diff(first, append=len(ordered))
        else:
            pairs, number = np.unique(keys, return_inverse=True)
            counts = np.bincount(number, weights=weight[at])
        pairs, counts = pairs[counts >= least], counts[counts >= least]
        if not len(pairs):
            return None
        place = np.minimum(np.searchsorted(pairs, keys), len(pairs) - 1)
        frequent = pairs[place] == keys
        at, place = at[frequent], place[frequent]
        good = np.argsort(-counts, kind="stable")
        rank = np.empty(len(pairs), np.int64)
        rank[good] = np.arange(len(pairs))
        order = np.full(len(symbols) + 2, len(pairs), np.int32)
        order[at + 1] = rank[place]
        mine = order[at + 1]
        # In a run of one symbol every other pair, or a run would lose but one place a round.
        runs_on = np.append(False, (at[1:] == at[:-1] + 1) & (mine[1:] == mine[:-1]))
        starts = np.flatnonzero(~runs_on)
        odd = (np.arange(len(at)) - np.repeat(starts, np.diff(np.append(starts, len(at))))) % 2 == 1
        wins = ~odd & (runs_on | (mine < order[at])) & (mine <= order[at + 2])
        waits, at, mine = at[~wins], at[wins], mine[wins]
        used = np.unique(mine)
        rename = np.zeros(len(pairs), np.int64)
        rename[used] = top + np.arange(len(used))
        symbols[at] = rename[mine]
        chosen = pairs[good[used]]
        self.rules = np.concatenate([self.rules, np.stack([chosen // top, chosen % top], axis=1)])
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        place = np.cumsum(keep, dtype=np.int32) - 1
        touched = np.zeros(len(symbols), bool)
        for places in (place[at], np.maximum(place[at] - 1, 0), place[waits[keep[waits]]]):
            touched[places] = True
        return keep, np.flatnonzero(touched)

    def expansions(self) -> tuple[np.ndarray, np.ndarray]:
        """The token ids of every symbol, end to end, and where each begins."""
        symbols = np.arange(self.base + len(self.rules))
        owner = symbols.copy()
        while (symbols >= self.base).any():
            twice = symbols >= self.base
            out = np.repeat(symbols, 1 + twice)
            owner = np.repeat(owner, 1 + twice)
            first = np.flatnonzero(np.repeat(twice, 1 + twice))
            rules = self.rules[symbols[twice] - self.base]
            out[first] = rules.reshape(-1)
            symbols = out
        return symbols, np.append(0, np.cumsum(np.bincount(owner, minlength=self.base + len(self.rules))))


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words between ASCII white space, end to end, and where each text's begin; null counts as empty."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, b"").cast(pa.string()))
    words = lists.flatten()
    real = pc.not_equal(words, "")  # white space at either end, and an empty text, give an empty word
    before = np.append(0, np.cumsum(real.to_numpy(zero_copy_only=False)))
    return words.filter(real), before[lists.offsets.to_numpy() - lists.offsets[0].as_py()]


def compress(
    doc_ids: list[int | None], counts: np.ndarray, words: list[pa.Array], encoder: WordEncoder, end_id: int, least: int
) -> tuple[bytes, int]:
    """One shard's bytes and its number of tokens, from the number of words of each document and all the words."""
    coded = pa.chunked_array(words, pa.string()).dictionary_encode().unify_dictionaries()
    distinct = coded.chunk(0).dictionary.to_pylist() if coded.num_chunks else []
    flat = np.concatenate([np.zeros(0, np.int32), *(c.indices.to_numpy() for c in coded.chunks)])
    symbols, lengths = encoder.encode(distinct)
    # The end of a document is a word of its own, after all others.
    symbols, lengths = np.append(symbols, end_id).astype(np.int32), np.append(lengths, 1)
    which = np.insert(flat, np.cumsum(counts), len(distinct))
    doc_of = np.repeat(np.arange(len(counts), dtype=np.int32), counts + 1)
    tokens = np.bincount(doc_of, weights=lengths[which], minlength=len(counts)).astype(np.int64)

    grammar = Grammar(max(encoder.base, end_id + 1))
    word_of = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
    uses = np.bincount(which, minlength=len(lengths)).astype(np.float64)
    symbols, word_of = grammar.shorten(symbols, word_of, uses[word_of], least)
    offsets = np.append(0, np.cumsum(np.bincount(word_of, minlength=len(lengths))))
    symbols, widths = _gather(symbols, offsets, which)
    symbols, doc_of = grammar.shorten(symbols, np.repeat(doc_of, widths), None, least)

    _, spans = grammar.expansions()
    per_doc = np.bincount(doc_of, minlength=len(counts))
    top = grammar.base + len(grammar.rules)
    width = 2 if top <= 1 << 16 else 3 if top <= 1 << 24 else 4
    parts = [
        HEADER.pack(_MARK, grammar.base, len(counts), len(grammar.rules), len(symbols), int(tokens.sum()), width),
        np.array([i or 0 for i in doc_ids], "<i8").tobytes(),
        np.array([i is None for i in doc_ids], "<u1").tobytes(),
        np.append(0, np.cumsum(tokens)).astype("<u8").tobytes(),
        np.append(0, np.cumsum(per_doc)).astype("<u8").tobytes(),
        grammar.rules.astype("<u4").tobytes(),
        np.diff(spans)[grammar.base :].astype("<u4").tobytes(),
        symbols.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width].tobytes(),
    ]
    return b"".join(parts), int(tokens.sum())


class Shard:
    """Reads a shard's bytes."""

    def __init__(self, data: bytes):
        mark, base, docs, rules, symbols, self.n_tokens, self.width = HEADER.unpack_from(data)
        if mark != _MARK:
            raise ValueError("not a shard of this format")
        at = HEADER.size

        def part(dtype: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, dtype, n, at)
            at += out.nbytes
            return out

        self.doc_ids, self.is_null = part("<i8", docs), part("<u1", docs) != 0
        self.tokens, self.symbol_starts = part("<u8", docs + 1).astype(np.int64), part("<u8", docs + 1).astype(np.int64)
        self.grammar = Grammar(base)
        self.grammar.rules = part("<u4", 2 * rules).astype(np.int64).reshape(-1, 2)
        self.lengths = part("<u4", rules)
        self.packed = part("<u1", symbols * self.width).reshape(-1, self.width)

    def symbols(self, begin: int, end: int) -> np.ndarray:
        out = np.zeros((end - begin, 4), np.uint8)
        out[:, : self.width] = self.packed[begin:end]
        return out.view("<u4").reshape(-1).astype(np.int64)

    @functools.cached_property
    def table(self) -> tuple[np.ndarray, np.ndarray]:
        return self.grammar.expansions()

    def all_ids(self) -> np.ndarray:
        return _gather(*self.table, self.symbols(0, len(self.packed)))[0]

    def ids(self, doc: int, begin: int = 0, end: int | None = None) -> np.ndarray:
        """Tokens begin to end of a document, expanding only the symbols that hold them."""
        symbols = self.symbols(self.symbol_starts[doc], self.symbol_starts[doc + 1])
        sizes = np.append(np.ones(self.grammar.base, np.int64), self.lengths)[symbols]
        ends = np.cumsum(sizes)
        end = int(ends[-1]) if end is None else min(end, int(ends[-1]))
        first, last = np.searchsorted(ends, begin, side="right"), np.searchsorted(ends, end, side="left")
        out: list[int] = []
        stack = symbols[first : last + 1][::-1].tolist()
        while stack:
            symbol = stack.pop()
            if symbol < self.grammar.base:
                out.append(symbol)
            else:
                stack += self.grammar.rules[symbol - self.grammar.base][::-1].tolist()
        skipped = int(ends[first] - sizes[first]) if first < len(ends) else 0
        return np.array(out[begin - skipped : end - skipped], np.int64)


def write_ids(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
    vocabulary: str | None = None,
    shard_ids: int = SHARD_IDS,
    least_uses: int = LEAST_USES,
) -> None:
    """Encode, sort by id and write shards below `path`, through Spark's file system."""
    spark = docs.sparkSession
    ship_package(spark)
    vocabulary = vocabulary or public_tokenizers.path(VOCABULARY)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, seq = word_encoder(vocabulary), TaskContext.get().partitionId(), 0
        ids: list[int | None] = []
        counts: list[np.ndarray] = []
        words: list[pa.Array] = []
        size = 0

        def shard() -> pa.RecordBatch:
            payload, n = compress(ids, np.concatenate(counts), words, encoder, end_id, least_uses)
            row = [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(ids)]), pa.array([n])]
            return pa.record_batch([*row, pa.array([payload], pa.binary())], names=["part", "seq", "n_docs", "n_ids", "payload"])

        for batch in it:
            found, starts = words_of(batch.column(1))
            grown = 2 * starts + np.arange(len(starts))  # about two ids a word, and the end
            doc = 0
            while doc < batch.num_rows:
                # The document that fills the shard is its last.
                full = int(np.searchsorted(grown, grown[doc] + shard_ids - size))
                end = min(full, batch.num_rows)
                ids += batch.column(0)[doc:end].to_pylist()
                counts.append(np.diff(starts[doc : end + 1]))
                words.append(found[starts[doc] : starts[end]])
                size += int(grown[end] - grown[doc])
                doc = end
                if size >= shard_ids:
                    yield shard()
                    seq, size, ids, counts, words = seq + 1, 0, [], [], []
        if ids:
            yield shard()

    (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
        .repartitionByRange(partitions(spark), "doc_id", F.xxhash64("text"))
        .sortWithinPartitions("doc_id", F.xxhash64("text"))
        .mapInArrow(batches, SHARDS)
        .write.parquet(path)
    )


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), ids (little-endian, 4 bytes each) of every document."""
    ship_package(spark)
    shards = spark.read.schema(SHARDS).parquet(path)
    in_part = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    sizes = shards.select("part", "seq", "n_ids").withColumn("in_part", F.coalesce(F.sum("n_ids").over(in_part), F.lit(0)))
    # One row a partition: the only window over all of them.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    first = checked_broadcast(sizes.join(parts, "part").select("part", "seq", (F.col("base") + F.col("in_part")).alias("base")), 1_000_000)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for base, payload in zip(batch.column(0), batch.column(1)):
                shard = Shard(payload.as_py())
                n = len(shard.doc_ids)
                ids = shard.all_ids().astype("<u4")
                offsets = pa.py_buffer((shard.tokens * 4).astype(np.int32))
                yield pa.record_batch(
                    [
                        pa.array(shard.doc_ids, mask=shard.is_null),
                        pa.array(shard.tokens[:-1] + base.as_py()),
                        pa.Array.from_buffers(pa.binary(), n, [None, offsets, pa.py_buffer(ids)]),
                    ],
                    names=["doc_id", "start", "ids"],
                )

    dealt = shards.join(first, ["part", "seq"]).select("base", "payload")
    return dealt.mapInArrow(batches, "doc_id long, start long, ids binary")
