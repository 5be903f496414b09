"""Benchmark decontamination by greedy string tiling.

A document is contaminated by a test item if non-overlapping common word runs ("tiles") of at least
`min_tile` words cover `threshold` of the item's words, in any order. Pairs are found by shared seeds:
every tile starts with a run of `min_tile` words that both texts have. Only for such pairs the tiling
runs: Karp-Rabin hashes of a length s find all maximal matches of s words or more; the longest are
marked first; s then shrinks until it is `min_tile` (Wise, "Running Karp-Rabin matching and greedy
string tiling"). Of the document only the stretches that seeds cover take part, which loses nothing.

Words are runs of letters, digits and non-ASCII characters of the lower-cased text. An item of fewer
than `min_tile` words must occur whole; an item without words contaminates nothing. Null texts count as
empty. The test items are taken in blocks of bounded size; every block meets all documents, so the
benchmark may grow without its broadcast growing. Repeated documents each get their row; items with a
null id count but are not listed.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlens.llm.staging import ship_package, staged, unused

MIN_TILE = 5
THRESHOLD = 0.5
BLOCK_BYTES = 4_000_000

_SEPARATORS = bytes(b if 48 <= b < 58 or 97 <= b < 123 or b > 127 else 32 for b in range(256))
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_BASE, _MODULUS = 1_000_003, (1 << 61) - 1


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(_SEPARATORS).split()


def _matches(test: list[int], doc: list[int], done_t: bytearray, done_d: bytearray, s: int) -> list[tuple[int, int, int]]:
    """Maximal matches (length, place in test, place in doc) of at least s unmarked words."""

    def windows(words: list[int], done: bytearray) -> Iterator[tuple[int, int]]:
        lead, value, clear = pow(_BASE, s - 1, _MODULUS), 0, 0
        for i, word in enumerate(words):
            if done[i] or word < 0:
                value = clear = 0
                continue
            if clear >= s:
                value -= (words[i - s] + 1) * lead
            value = (value * _BASE + word + 1) % _MODULUS
            clear += 1
            if clear >= s:
                yield i - s + 1, value

    table: dict[int, list[int]] = {}
    for i, value in windows(test, done_t):
        table.setdefault(value, []).append(i)
    found = []
    reached: dict[int, int] = {}  # by diagonal: the end in doc of its last match
    for j, value in windows(doc, done_d):
        for i in table.get(value, ()):
            if reached.get(j - i, -1) >= j + s or test[i : i + s] != doc[j : j + s]:
                continue
            n = s
            while (
                i + n < len(test) and j + n < len(doc) and test[i + n] == doc[j + n] >= 0
                and not done_t[i + n] and not done_d[j + n]
            ):
                n += 1
            reached[j - i] = j + n
            found.append((n, i, j))
    return found


def tiles(test: list[int], doc: list[int], min_tile: int) -> list[tuple[int, int, int]]:
    """Non-overlapping (length, place in test, place in doc), longest first; negative words match nothing."""
    done_t, done_d = bytearray(len(test)), bytearray(len(doc))
    out: list[tuple[int, int, int]] = []
    s = max(min_tile, 16)
    while True:
        found = _matches(test, doc, done_t, done_d, s)
        longest = max((n for n, _, _ in found), default=0)
        if longest > 2 * s:
            s = longest
            continue
        by_length: dict[int, list[tuple[int, int]]] = {}
        for n, i, j in found:
            by_length.setdefault(n, []).append((i, j))
        for n in range(longest, s - 1, -1):
            for i, j in sorted(by_length.get(n, ())):
                free = [k for k in range(n + 1) if k == n or done_t[i + k] or done_d[j + k]]
                if free[0] == n:
                    done_t[i : i + n] = done_d[j : j + n] = b"\1" * n
                    out.append((n, i, j))
                    continue
                begin = 0
                for end in free:  # what is left of an occluded match waits for its own length
                    if end - begin >= s:
                        by_length.setdefault(end - begin, []).append((i + begin, j + begin))
                    begin = end + 1
        if s == min_tile:
            return out
        s = max(min_tile, s // 2)


class Benchmark:
    """Seeds of a block of test items."""

    def __init__(self, items: list[tuple[int | None, str | None]], min_tile: int):
        self.vocabulary: dict[bytes, int] = {}
        self.items = []
        for item_id, text in items:
            words = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words_of(text)]
            if words:
                self.items.append((item_id, words))
        self.min_tile = min_tile
        self.seeds: dict[int, dict[int, list[int]]] = {}  # by length: by hash: items
        for k, (_, words) in enumerate(self.items):
            n = min(min_tile, len(words))
            hashes = self._hash(np.array(words, np.int64), n)
            for h in set(hashes.tolist()):
                self.seeds.setdefault(n, {}).setdefault(h, []).append(k)
        self.sorted = {n: np.sort(np.array(list(t), np.uint64)) for n, t in self.seeds.items()}

    @staticmethod
    def _hash(words: np.ndarray, n: int) -> np.ndarray:
        count = len(words) - n + 1
        value = np.zeros(max(0, count), np.uint64)
        for k in range(n if count > 0 else 0):
            value = (value ^ words[k : k + count].view(np.uint64)) * _MULTIPLIER
            value ^= value >> np.uint64(29)
        return value

    def covered(self, texts: list[str | None]) -> Iterator[tuple[int, int | None, float, int]]:
        """(place of the text, item, share of the item covered, tiles) of each pair with a seed."""
        known: list[int] = []
        starts = []
        for text in texts:
            starts.append(len(known))
            known += map(self.vocabulary.get, words_of(text), repeat(-1))
            known.append(-1)  # nothing runs on into the next text
        words = np.array(known, np.int64)
        bounds = np.append(np.array(starts, np.int64), len(words))
        gap = np.append(0, np.cumsum(words < 0))
        pairs: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for n, seeds in self.sorted.items():
            count = len(words) - n + 1
            if count <= 0:
                continue
            whole = np.flatnonzero(gap[n:] == gap[:count])  # no unknown word inside
            hashes = self._hash(words, n)[whole]
            at = np.minimum(np.searchsorted(seeds, hashes), len(seeds) - 1)
            hit = seeds[at] == hashes
            whole, hashes = whole[hit], hashes[hit]
            owner = np.searchsorted(bounds, whole, side="right") - 1
            for place, h, t in zip(whole.tolist(), hashes.tolist(), owner.tolist()):
                for k in self.seeds[n][h]:
                    pairs.setdefault((t, k), []).append((place, place + n))
        for (t, k), spans in pairs.items():
            item_id, test = self.items[k]
            doc: list[int] = []
            end = -1
            for a, b in spans:
                if a > end:
                    doc.append(-1)
                    end = a
                doc += words[end:b].tolist()
                end = max(end, b)
            found = tiles(test, doc, min(self.min_tile, len(test)))
            yield t, item_id, sum(n for n, _, _ in found) / len(test), len(found)


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[list]:
    items = benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text"))
    size = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    blocks = -(-size // block_bytes)
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, blocks)))
    for b in range(blocks):
        yield [tuple(r) for r in items.filter(part == b).collect()]


def contaminated_pairs(
    docs: DataFrame,
    benchmark: DataFrame,
    min_tile: int = MIN_TILE,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(doc_id, text_hash, item_id, coverage, n_tiles) of every pair over the threshold."""
    spark = docs.sparkSession
    ship_package(spark)
    schema = "doc_id long, text_hash long, item_id long, coverage double, n_tiles int"
    picked = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_hash"),
        F.col(text_col).alias("text"),
    )

    def found(block: list) -> DataFrame:
        shared = spark.sparkContext.broadcast(block)

        def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bench = Benchmark(shared.value, min_tile)
            for batch in it:
                for i in range(0, len(batch), 1000):
                    part = batch.slice(i, 1000)
                    hits = [h for h in bench.covered(part.column(2).to_pylist()) if h[2] >= threshold]
                    rows = pa.array([h[0] for h in hits], pa.int64())
                    yield pa.record_batch(
                        [
                            part.column(0).take(rows),
                            part.column(1).take(rows),
                            pa.array([h[1] for h in hits], pa.int64()),
                            pa.array([h[2] for h in hits], pa.float64()),
                            pa.array([h[3] for h in hits], pa.int32()),
                        ],
                        names=["doc_id", "text_hash", "item_id", "coverage", "n_tiles"],
                    )

        return picked.mapInArrow(batches, schema)

    out = None
    for block in _blocks(benchmark, item_col, item_text_col, block_bytes):
        out = found(block) if out is None else out.unionByName(found(block))
    return out if out is not None else spark.createDataFrame([], schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """A row per document: doc_id, contaminated, coverage (of the item covered most), item_ids, n_items."""
    pairs = staged(contaminated_pairs(docs, benchmark, id_col=id_col, text_col=text_col, **options), "tiling-pairs")
    # The same row twice has the same pairs twice; they count once.
    per_doc = (
        pairs.groupBy("doc_id", "text_hash")
        .agg(F.max("coverage").alias("coverage"), F.sort_array(F.collect_set("item_id")).alias("item_ids"))
        .select(F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash"), "coverage", "item_ids")
    )
    all_docs = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_hash"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_hash") == F.col("hit_hash"))
    none = F.array().cast("array<bigint>")
    return all_docs.join(per_doc, same, "left").select(
        "doc_id",
        F.col("hit_hash").isNotNull().alias("contaminated"),
        F.coalesce("coverage", F.lit(0.0)).alias("coverage"),
        F.coalesce("item_ids", none).alias("item_ids"),
        F.size(F.coalesce("item_ids", none)).alias("n_items"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents that no test item covers, with all their columns."""
    pairs = contaminated_pairs(docs, benchmark, id_col=id_col, text_col=text_col, **options)
    hit_id, hit_hash = unused(docs, "hit_id", "hit_hash")
    hits = pairs.select(F.col("doc_id").alias(hit_id), F.col("text_hash").alias(hit_hash)).distinct()
    hits = staged(hits, "tiling-hits")
    text_hash = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    same = F.col(id_col).cast("long").eqNullSafe(F.col(hit_id)) & (text_hash == F.col(hit_hash))
    return docs.join(hits, same, "left_anti")
