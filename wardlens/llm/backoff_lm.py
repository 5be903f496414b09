"""Language-model scoring with a weighted backoff automaton learnt from the corpus itself.

States are histories: the empty one, every word and, with `order` 3, every word pair. A state h has an
arc for each word w seen after it, of weight log10 p(w|h), and a failure arc of weight
log10(m / (c(h) + m)) to the history without its first word. The weights are n-gram counts under a
Dirichlet prior on the shorter history (MacKay and Peto, "A hierarchical Dirichlet language model"):

    p(w|h) = (c(hw) + m p(w|h')) / (c(h) + m)        p(w) = (c(w) + 1) / (N + V + 1)

so that seen arcs and failures sum to one in every state. A text is scored in one pass from left to
right that carries a state: each word takes the arc of the state it meets, through failure arcs where
there is none, and its logarithm is added up. All texts of a block take the step side by side.

The automaton of a whole corpus fits no machine, and need not: the texts are cut into blocks of bounded
size, and a block is scored on the part of the automaton that its own n-grams touch. Each block sends
its distinct n-grams once, as sorted 64-bit keys packed by key range; a range adds the counts of all
blocks and sends each its totals back. What is shuffled grows with the distinct n-grams of the blocks,
a frequent word weighs one key a block, and no table is sent to every task. No count is cut off.

Words are what lies between ASCII white space, A-Z in lower case; every text ends with an end token,
which is also the history of its first word. Documents learn unless the CRC-32 of their id as text
leaves 2 when divided by 7; a null id learns. A null text counts as empty: one end token. Repeated rows
learn and are scored each time. Keys are hashes: two n-grams share one with odds of n^2 / 2^65.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlens.llm.staging import partitions, ship_package, staged

PRIOR = 20.0
BLOCK_TOKENS = 1_500_000
RANGE_TOKENS = 2_000_000
PIECE = 1024
FOLDS, HELD_OUT = 7, 2

_END = b" "  # no word holds a space
_MIX = np.uint64(0x9E3779B97F4A7C15)

BLOCK = "block long, n_tokens long, n_docs long, words binary, ids binary, lengths binary, doc_ids array<long>, held binary"
CHUNK = "kind int, part long, block long, keys binary, counts binary"
REPLY = "kind int, part long, block long, counts binary, total long, types long"
SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def _pack(values: np.ndarray) -> bytes:
    """Integers by byte planes, each compressed by itself: random low bytes would spoil the code of the high ones."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.dtype.itemsize).T
    packer = zstandard.ZstdCompressor(level=1)
    return b"".join(packer.compress(plane.tobytes()) for plane in planes)


def _unpack(data: bytes, dtype) -> np.ndarray:
    planes = []
    while data:
        frame = zstandard.ZstdDecompressor().decompressobj()
        planes.append(np.frombuffer(frame.decompress(data), np.uint8))
        data = frame.unused_data
    return np.stack(planes, axis=1).reshape(-1).view(dtype)


def _pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending keys as differences: the high bytes of a dense range are zero."""
    return _pack(np.diff(keys, prepend=np.uint64(0)))


def _unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(_unpack(data, np.uint64), dtype=np.uint64)


def _joined_keys(history: np.ndarray, word: np.ndarray) -> np.ndarray:
    mixed = (history ^ (history >> np.uint64(31))) * _MIX + word
    mixed = (mixed ^ (mixed >> np.uint64(29))) * _MIX
    return mixed ^ (mixed >> np.uint64(32))


def is_held_out(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % FOLDS == HELD_OUT


class Block:
    """Texts as word numbers; words are numbered in the order of their hashes."""

    def __init__(self, words: np.ndarray, ids: np.ndarray, lengths: np.ndarray, held: np.ndarray):
        self.words, self.ids, self.lengths, self.held = words, ids, lengths, held
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths
        self.learns = np.repeat(held == 0, lengths)

    @classmethod
    def of_numbers(cls, number: dict[bytes, int], texts: list[np.ndarray], held: list[bool]) -> Block:
        """From texts as numbers in order of appearance, each with its end."""
        hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in number), np.uint64, len(number))
        order = np.argsort(hashes, kind="stable")
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        return cls(hashes[order], rank[np.concatenate(texts)], lengths, np.array(held, np.uint8))

    def grams(self, order: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For 1 to `order`: n, distinct sorted keys, each place's key, each place's history, the places.

        A history is numbered among the keys of n - 1. Places too near the start for n are left out.
        """
        places = np.arange(len(self.ids), dtype=np.int32)
        keys, at = self.words, self.ids.astype(np.int32)
        yield 1, keys, at, np.zeros(0, np.int32), places
        end = np.searchsorted(self.words, np.uint64(xxhash.xxh64_intdigest(_END)))
        for n in range(2, order + 1):
            history = np.full(len(self.ids), -1, np.int32)
            history[places] = at
            history[1:] = history[:-1].copy()
            history[self.starts] = end if n == 2 else -1
            places = np.flatnonzero(history >= 0).astype(np.int32)
            history = history[places]
            at, first = _numbered(history * np.int64(len(self.words)) + self.ids[places])
            joined = _joined_keys(keys[history[first]], self.words[self.ids[places[first]]])
            del first
            by_key = np.argsort(joined)
            keys = joined[by_key]
            rank = np.empty(len(by_key), np.int32)
            rank[by_key] = np.arange(len(by_key), dtype=np.int32)
            at = rank[at]
            del joined, by_key, rank
            yield n, keys, at, history, places


def _numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values numbered in ascending order, and a place of each."""
    order = np.argsort(values)
    new = np.diff(values[order], prepend=-1) > 0
    at = np.empty(len(values), np.int32)
    at[order] = np.cumsum(new, dtype=np.int32) - 1
    return at, order[new]


def to_blocks(docs: DataFrame, id_col: str, text_col: str, block_tokens: int) -> DataFrame:
    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 24
        made = size = 0
        ids: list[int | None] = []
        texts: list[np.ndarray] = []

        def numbers() -> dict[bytes, int]:
            out = defaultdict(count().__next__)
            out[_END]
            return out

        def block() -> pa.RecordBatch:
            b = Block.of_numbers(number, texts, [is_held_out(i) for i in ids])
            rows = {
                "block": pa.array([task + made], pa.int64()),
                "n_tokens": pa.array([len(b.ids)], pa.int64()),
                "n_docs": pa.array([len(ids)], pa.int64()),
                "words": pa.array([_pack_sorted(b.words)], pa.binary()),
                "ids": pa.array([_pack(b.ids)], pa.binary()),
                "lengths": pa.array([_pack(b.lengths)], pa.binary()),
                "doc_ids": pa.array([ids], pa.list_(pa.int64())),
                "held": pa.array([_pack(b.held)], pa.binary()),
            }
            return pa.record_batch(list(rows.values()), names=list(rows))

        number = numbers()
        for batch in it:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                words = (text.as_py() or b"").lower().split()
                ids.append(doc_id.as_py())
                texts.append(np.fromiter(map(number.__getitem__, chain(words, (_END,))), np.int32, len(words) + 1))
                size += len(words) + 1
                if size >= block_tokens:
                    yield block()
                    made, size, ids, texts, number = made + 1, 0, [], [], numbers()
        if ids:
            yield block()

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return picked.mapInArrow(batches, BLOCK)


def _load(words: bytes, ids: bytes, lengths: bytes, held: bytes) -> Block:
    return Block(_unpack_sorted(words), _unpack(ids, np.uint32), _unpack(lengths, np.int64), _unpack(held, np.uint8))


def to_chunks(blocks: DataFrame, order: int, bits: int) -> DataFrame:
    """Each block's distinct n-grams and their counts in learning texts, cut into 2^bits key ranges."""
    cuts = (np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)) if bits else np.zeros(0, np.uint64)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for row in range(len(batch)):
                name, *data = (batch.column(i)[row].as_py() for i in range(5))
                block = _load(*data)
                for n, keys, at, _, places in block.grams(order):
                    counts = np.bincount(at[block.learns[places]], minlength=len(keys)).astype(np.uint32)
                    edges = np.concatenate(([0], np.searchsorted(keys, cuts), [len(keys)]))
                    full = np.flatnonzero(np.diff(edges))
                    spans = [slice(edges[p], edges[p + 1]) for p in full]
                    yield pa.record_batch(
                        [
                            pa.array(np.full(len(full), n, np.int32)),
                            pa.array(full.astype(np.int64)),
                            pa.array(np.full(len(full), name, np.int64)),
                            pa.array([_pack_sorted(keys[s]) for s in spans], pa.binary()),
                            pa.array([_pack(counts[s]) for s in spans], pa.binary()),
                        ],
                        names=["kind", "part", "block", "keys", "counts"],
                    )

    return blocks.select("block", "words", "ids", "lengths", "held").mapInArrow(batches, CHUNK)


def _add_up(chunks: pa.Table) -> pa.Table:
    """Totals of one key range, for each block in the order of its keys, and a row of sums (block -1)."""
    kind, part = chunks.column("kind")[0].as_py(), chunks.column("part")[0].as_py()
    blocks = chunks.column("block").to_pylist()
    keys = [_unpack_sorted(k.as_py()) for k in chunks.column("keys")]
    counts = np.concatenate([_unpack(c.as_py(), np.uint32) for c in chunks.column("counts")])
    _, at = np.unique(np.concatenate(keys), return_inverse=True)
    totals = np.bincount(at, weights=counts).astype(np.int64)  # exact below 2^53
    seen = totals[at]
    ends = np.cumsum([len(k) for k in keys])
    replies = [_pack(seen[e - len(k) : e]) for k, e in zip(keys, ends)]
    n = len(blocks)
    return pa.table(
        {
            "kind": pa.array([kind] * (n + 1), pa.int32()),
            "part": pa.array([part] * (n + 1), pa.int64()),
            "block": pa.array([*blocks, -1], pa.int64()),
            "counts": pa.array([*replies, None], pa.binary()),
            "total": pa.array([0] * n + [int(totals.sum())], pa.int64()),
            "types": pa.array([0] * n + [int((totals > 0).sum())], pa.int64()),
        }
    )


class BackoffAutomaton:
    """The part of the automaton that a block's n-grams touch, as arrays.

    State 0 is the empty history; the learnt histories of one word, of two and so on follow. The arcs lie
    in the order of (state, word): `weight` and the state that each leads to, `target`. Over its failure
    arc a state goes to `shorter` at the weight `failure`. The empty state has an arc for every word.
    """

    def __init__(self, block: Block, counts: list[np.ndarray], tokens: int, types: int, prior: float):
        self.block, self.order, self.types = block, len(counts), len(block.words)
        failure, shorter = [np.zeros(1)], [np.zeros(1, np.int32)]
        arcs, weights, targets = [], [], []
        made = 1
        for n, keys, at, history, places in block.grams(self.order):
            count = counts[n - 1]
            learnt = count > 0
            if n == 1:
                self.known = learnt
                self.unigram = value = np.log10((count + 1) / (tokens + (types + 1)))
                below = np.zeros(len(keys), np.int32)  # the state of a gram without its first word
                kept, source, word = np.arange(len(keys)), 0, np.arange(len(keys))
            else:
                one = np.empty(len(keys), np.int32)  # a place of each gram
                before = np.empty(len(keys), np.int32)
                one[at], before[at] = places, history
                rest = at_shorter[one]
                below = state[rest]
                with_history = counts[n - 2][before]
                back = np.log10(prior / (with_history + prior)) + value[rest]
                value = np.where(learnt, np.log10(count / (with_history + prior) + 10.0**back), back)
                del rest, with_history, back
                kept = np.flatnonzero(learnt)
                source, word = state[before[kept]].astype(np.int64), block.ids[one[kept]]
                del one, before
            goal = below
            if n < self.order:
                goal = below.copy()  # the longest state that ends a gram: its own if it was learnt
                goal[learnt] = made + np.arange(np.count_nonzero(learnt), dtype=np.int32)
                made += np.count_nonzero(learnt)
                failure.append(np.log10(prior / (count[learnt] + prior)))
                shorter.append(below[learnt])
                at_shorter = np.zeros(len(block.ids), np.int32)
                at_shorter[places] = at
            arc = source * self.types + word
            by_arc = np.argsort(arc)
            arcs.append(arc[by_arc])
            kept = kept[by_arc]
            del source, word, arc, by_arc
            weights.append(value[kept])
            targets.append(goal[kept])
            state = goal
        # Histories grow from part to part, and so do the numbers of their states.
        del keys, at, history, places, value, kept, state, goal, below
        self.arcs = np.concatenate([*arcs, [np.iinfo(np.int64).max]])
        del arcs
        self.weight, self.target = np.concatenate(weights), np.concatenate(targets)
        self.failure, self.shorter = np.concatenate(failure), np.concatenate(shorter)

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """From each state over its word: the weight of the way, and the state it ends in."""
        wanted = state * np.int64(self.types) + word
        arc = np.searchsorted(self.arcs, wanted)
        weight = np.zeros(len(state))
        lost = np.flatnonzero(self.arcs[arc] != wanted)
        while len(lost):
            weight[lost] += self.failure[state[lost]]
            state[lost] = self.shorter[state[lost]]
            again = state[lost] * np.int64(self.types) + word[lost]
            found = np.searchsorted(self.arcs, again)
            arc[lost] = found
            lost = lost[self.arcs[found] != again]
        return weight + self.weight[arc], self.target[arc]

    def walk(self, piece: int = PIECE) -> np.ndarray:
        """Every text's log-probability: all texts of the block go from left to right, a word at a time,
        each with the state it is in.

        A long text goes as pieces side by side. The state at a place is the longest learnt history that
        ends there, so a walk from the empty state is in it after `order - 1` words; a later piece reads
        these ahead of its first word, without adding their weights.
        """
        block = self.block
        ahead = self.order - 1
        piece = max(piece, ahead, 1)
        pieces = -(-block.lengths // piece)
        text = np.repeat(np.arange(len(pieces)), pieces)
        number = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = block.starts[text] + number * piece
        end = np.minimum(begin + piece, block.ends[text])
        first = begin - np.where(number > 0, ahead, 0)
        longest_first = np.argsort(first - end, kind="stable")
        text, number, begin, first, end = (x[longest_first] for x in (text, number, begin, first, end))
        state = np.where(number == 0, self.start(), 0).astype(np.int32)
        score = np.zeros(len(text))
        words = first - end  # ascending: the pieces with words left are the first ones
        for read in range(-int(words[0])):
            left = np.searchsorted(words, -read)
            place = first[:left] + read
            weight, state[:left] = self.step(state[:left].copy(), block.ids[place])
            score[:left] += np.where(place >= begin[:left], weight, 0.0)
        return np.bincount(text, weights=score, minlength=len(pieces))

    def start(self) -> int:
        """The state of a text that has not begun: the end of another is its history."""
        if self.order == 1:
            return 0
        end = np.searchsorted(self.block.words, np.uint64(xxhash.xxh64_intdigest(_END)))
        return int(self.target[end])  # the empty state's arcs come first, a word each

    def score(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of every text: known words, unigram score, score."""
        ids, starts = self.block.ids, self.block.starts
        base = np.add.reduceat(self.unigram[ids], starts)
        return np.add.reduceat(self.known[ids].astype(np.int64), starts), base, self.walk()


def score_texts(
    docs: DataFrame,
    order: int = 2,
    prior: float = PRIOR,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_tokens: int = BLOCK_TOKENS,
    range_tokens: int = RANGE_TOKENS,
) -> DataFrame:
    """Score every text by the model learnt from those not held out."""
    spark = docs.sparkSession
    ship_package(spark)
    blocks = staged(to_blocks(docs, id_col, text_col, block_tokens), "lm-blocks")
    size = blocks.agg(F.sum("n_tokens")).first()[0] or 0
    bits = max(0, (size // range_tokens).bit_length())
    chunks = to_chunks(blocks, order, bits)
    replies = staged(chunks.groupBy("kind", "part").applyInArrow(_add_up, REPLY), "lm-counts")
    sums = replies.filter("block = -1 AND kind = 1").agg(F.sum("total"), F.sum("types")).first()
    tokens, types = (x or 0 for x in sums)

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        row = {c: left.column(c)[0].as_py() for c in ("words", "ids", "lengths", "held")}
        block = _load(**row)
        parts = sorted(
            zip(right.column("kind").to_pylist(), right.column("part").to_pylist(), right.column("counts").to_pylist())
        )
        counts = [
            np.concatenate([_unpack(c, np.int64) for kind, _, c in parts if kind == n] or [np.zeros(0, np.int64)])
            for n in range(1, order + 1)
        ]
        del row, parts
        known, base, score = BackoffAutomaton(block, counts, tokens, types, prior).score()
        return pa.table(
            {
                "doc_id": left.column("doc_ids").combine_chunks().values.cast(pa.int64()),
                "held_out": pa.array(block.held != 0),
                "n_tokens": pa.array(block.lengths),
                "n_known": pa.array(known),
                "train_tokens": pa.array(np.full(len(known), tokens, np.int64)),
                "base_score": pa.array(base),
                "score": pa.array(score),
            }
        )

    left = blocks.repartition(partitions(spark), "block").groupBy("block")
    right = replies.filter("block >= 0").select("block", "kind", "part", "counts").groupBy("block")
    return left.cogroup(right).applyInArrow(scored, SCORES)
