"""SimHash near-duplicates through a Gray-order hierarchical index.

A fingerprint bit is 1 if it is set in over half of the XXH64 values of a text's word shingles.
Documents link if their fingerprints differ in at most `max_bits` bits; a group is what links reach.

Distinct fingerprints only are indexed. The 64 bits are cut into `max_bits + shared` blocks; two
fingerprints within `max_bits` agree in at least `shared` whole blocks. Each choice of blocks is a
root pattern: fingerprints with the same bits there come together (hash partitioning), sorted by Gray
rank, so that neighbours share long bit patterns. Under a root, every 8 neighbours form a node that
holds the bits they all share and its parent has not factored out yet, every 8 nodes a node above. A
search walks from the root, adds up the differences in the factored patterns and leaves a whole group
as soon as they exceed `max_bits`. This is exact: the root patterns cover all pairs within reach.

A group of copies costs one fingerprint. A dense run of near copies is peeled: what a search finds
leaves the index and becomes the next query, so a component costs its size, not its square. Of each
root only a spanning forest is emitted; `connected_components` joins the forests.

Null text counts as empty; a text without words has fingerprint zero and links like any other. A null
id is never a component id. Repeated rows stay. Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlens.llm.components import connected_components
from wardlens.llm.staging import partitions, ship_package, staged, unused

SEED = 42
FANOUT = 8
_PIECE = 1 << 16
_FRONTIER = 1 << 21
_LONG_RUN = 2048


def shingle_hashes(words: list[bytes], n: int) -> Iterator[np.ndarray]:
    """XXH64 of every shingle of n words, joined by one space, in pieces of bounded size."""
    if not words:
        return
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = min(n, len(words))
    starts, ends = starts[: len(words) - n + 1], ends[n - 1 :]
    for i in range(0, len(starts), _PIECE):
        spans = zip(starts[i : i + _PIECE].tolist(), ends[i : i + _PIECE].tolist())
        yield np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans], np.uint64)


def fingerprint(text: bytes, n: int) -> int:
    counts, total = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(text.lower().split(), n):
        bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.int32)
        total += len(hashes)
    return int(np.packbits(counts * 2 > total, bitorder="little").view(np.uint64)[0])


def fingerprints(
    docs: DataFrame, words: int, id_col: str = "doc_id", text_col: str = "text", keep: str | None = None
) -> DataFrame:
    """doc_id and fp (the fingerprint's bits as a signed long) of every row, and the string column `keep`."""
    others = [keep] if keep else []

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            texts = batch.column(1)
            out = np.fromiter((fingerprint(t.as_py() or b"", words) for t in texts), np.uint64, len(texts))
            columns = [batch.column(0), pa.array(out.view(np.int64)), *batch.columns[2:]]
            yield pa.record_batch(columns, names=["doc_id", "fp", *others])

    ship_package(docs.sparkSession)
    picked = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"), *others
    )
    return picked.mapInArrow(batches, ", ".join(["doc_id long", "fp long", *(f"`{c}` string" for c in others)]))


def gray_rank(fp: Column) -> Column:
    """Place of a bit pattern in the Gray code: the prefix xor of its bits."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, shift))
    return fp


def root_masks(max_bits: int, shared: int) -> list[int]:
    blocks = max_bits + shared
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    return [sum(chosen) for chosen in combinations(masks, shared)]


class HierarchicalIndex:
    """Runs of Gray-sorted fingerprints, each below a root of its own."""

    def __init__(self, fps: np.ndarray, run_starts: np.ndarray, max_bits: int):
        self.max_bits = max_bits
        self.fps = fps
        sizes = np.diff(np.append(run_starts, len(fps)))
        self.run_of = np.repeat(np.arange(len(run_starts)), sizes)
        zeros, ones, starts = fps, fps, run_starts
        levels = []  # from the leaves up: (common to all below: ones, mask), first child, end of children
        while len(zeros) > len(run_starts):
            counts = -(-sizes // FANOUT)
            first = np.repeat(starts, counts) + FANOUT * (
                np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            )
            zeros, ones = np.bitwise_or.reduceat(zeros, first), np.bitwise_and.reduceat(ones, first)
            levels.append((ones, ~(zeros ^ ones), first, np.append(first[1:], len(levels[-1][0]) if levels else len(fps))))
            starts, sizes = np.cumsum(counts) - counts, counts
        self.levels = levels
        self.own = []  # bits of each level that its parents have not factored out; leaves at -1
        for k, (_, mask, first, _) in enumerate(levels):
            if k + 1 < len(levels):
                up = levels[k + 1]
                mask = mask & ~np.repeat(up[1], up[3] - up[2])
            self.own.append(mask)
        self.leaf_own = ~np.repeat(levels[0][1], levels[0][3] - levels[0][2]) if levels else ~np.zeros(len(fps), np.uint64)
        self.alive = np.ones(len(fps), bool)

    def search(self, queries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query leaf, found leaf) of live leaves within reach, in pieces."""
        stack = [(len(self.levels) - 1, queries, self.run_of[queries], np.zeros(len(queries), np.uint8))]
        while stack:
            k, q, node, gone = stack.pop()
            if len(q) > _FRONTIER:
                half = len(q) // 2
                stack += [(k, q[:half], node[:half], gone[:half]), (k, q[half:], node[half:], gone[half:])]
                continue
            pattern, own = (self.levels[k][0], self.own[k]) if k >= 0 else (self.fps, self.leaf_own)
            gone = gone + np.bitwise_count((self.fps[q] ^ pattern[node]) & own[node])
            keep = gone <= self.max_bits
            if k < 0:
                keep &= self.alive[node] & (node != q)
                yield q[keep], node[keep]
                continue
            q, node, gone = q[keep], node[keep], gone[keep]
            first, end = self.levels[k][2][node], self.levels[k][3][node]
            width = end - first
            child = np.repeat(first - np.cumsum(width) + width, width) + np.arange(width.sum())
            stack.append((k - 1, np.repeat(q, width), child, np.repeat(gone, width)))

    def peel(self, run: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """Components of a long run from a few starts; returns the leaves still in the index.

        Goes on while starts find large components, which would cost their square otherwise.
        """
        fruitless, rng = 0, np.random.default_rng(len(run))
        for start in rng.permutation(run)[: 4 * FANOUT]:
            if fruitless == FANOUT:
                break
            if not self.alive[start]:
                continue
            self.alive[start] = False
            frontier, found = np.array([start]), 1
            while len(frontier):
                nxt = []
                for piece in np.array_split(frontier, -(-len(frontier) // 64)):
                    for _, hit in self.search(piece):
                        hit = np.unique(hit)
                        self.alive[hit] = False
                        nxt.append(hit)
                frontier = np.unique(np.concatenate(nxt)) if nxt else frontier[:0]
                labels[frontier] = start
                found += len(frontier)
            fruitless = 0 if found > 1 else fruitless + 1
        return run[self.alive[run]]


def forest(fps: np.ndarray, run_starts: np.ndarray, max_bits: int) -> np.ndarray:
    """For each leaf a leaf of its component within its run, the same for the whole component."""
    index = HierarchicalIndex(fps, run_starts, max_bits)
    labels = np.arange(len(fps))
    sizes = np.diff(np.append(run_starts, len(fps)))
    for start, size in zip(run_starts[sizes > _LONG_RUN], sizes[sizes > _LONG_RUN]):
        index.peel(np.arange(start, start + size), labels)
    rest = np.flatnonzero(index.alive)
    for i in range(0, len(rest), 1 << 15):
        for a, b in index.search(rest[i : i + (1 << 15)]):
            while len(a):
                low = np.minimum(labels[a], labels[b])
                np.minimum.at(labels, labels[a], low)
                np.minimum.at(labels, labels[b], low)
                while not np.array_equal(labels, labels[labels]):
                    labels = labels[labels]
                apart = labels[a] != labels[b]
                a, b = a[apart], b[apart]
    return labels


def _forests(max_bits: int):
    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def links(root: np.ndarray, key: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
            new = np.flatnonzero(np.append(True, (root[1:] != root[:-1]) | (key[1:] != key[:-1])))
            length = np.diff(np.append(new, len(fps)))
            fps = fps[np.repeat(length > 1, length)].view(np.uint64)
            length = length[length > 1]
            labels = forest(fps, np.cumsum(length) - length, max_bits) if len(fps) else np.zeros(0, np.int64)
            tied = labels != np.arange(len(fps))
            signed = fps.view(np.int64)
            return pa.record_batch([pa.array(signed[tied]), pa.array(signed[labels[tied]])], names=["u", "v"])

        for batch in it:
            held.append(tuple(c.to_numpy(zero_copy_only=False) for c in batch.columns))
            size += len(batch)
            if size < 200_000:
                continue
            root, key, fps = (np.concatenate(x) for x in zip(*held))
            # The last run may go on in the next batch.
            last = np.flatnonzero((root != root[-1]) | (key != key[-1]))
            cut = last[-1] + 1 if len(last) else 0
            if cut:
                yield links(root[:cut], key[:cut], fps[:cut])
            held, size = [(root[cut:], key[cut:], fps[cut:])], 0 if cut else size
        if held:
            parts = [np.concatenate(x) for x in zip(*held)]
            if len(parts[0]):
                yield links(*parts)

    return batches


def fingerprint_links(distinct: DataFrame, max_bits: int, shared: int = 2) -> DataFrame:
    """Edges (u, v) between fingerprints that span every group of the column fp's distinct values.

    `shared` is the number of whole blocks in a root pattern: with 2 a root has about 21 of 64 bits and
    a fingerprint stands under 15 roots, right for up to about a billion; 3 gives 27 bits, 35 roots.
    """
    roots = F.array(
        *(
            F.struct(F.lit(i).alias("root"), F.col("fp").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m)).alias("key"))
            for i, m in enumerate(root_masks(max_bits, shared))
        )
    )
    dealt = (
        distinct.select("fp", gray_rank(F.col("fp")).alias("rank"), F.explode(roots).alias("at"))
        .select("at.root", "at.key", "fp", "rank")
        .repartition(partitions(distinct.sparkSession), "root", "key")
        .sortWithinPartitions("root", "key", "rank")
        .select("root", "key", "fp")
    )
    return dealt.mapInArrow(_forests(max_bits), "u long, v long")


def simhash_groups(
    docs: DataFrame, words: int = 5, max_bits: int = 4, shared: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, fp and component_id (smallest id of the group) of every row."""
    marked = staged(fingerprints(docs, words, id_col, text_col), "simhash-docs")
    distinct = staged(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-fps")
    nodes = connected_components(fingerprint_links(distinct, max_bits, shared))
    rooted = distinct.join(nodes, distinct.fp == nodes.node, "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    rooted = staged(rooted, "simhash-roots")
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = staged(rooted.join(least, "root").select("fp", "component_id"), "simhash-classes")
    return marked.join(classes, "fp").select("doc_id", "fp", "component_id")


def drop_near_copies(
    docs: DataFrame, words: int = 4, max_bits: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The document with the smallest id of each near-duplicate group, with all its columns.

    Rows leave by id and fingerprint: of an id that carries several texts, only those go that belong to a
    group with a smaller id. Rows that share the smallest id of a group are one document and stay together.
    Rows with a null id stay: they cannot be named.
    """
    groups = staged(simhash_groups(docs, words, max_bits, id_col=id_col, text_col=text_col), "simhash-groups")
    gone = groups.filter("doc_id != component_id")
    gone_id, several_id, same_text = unused(docs, "gone_id", "several_id", "same_text")
    ids = gone.select(F.col("doc_id").alias(gone_id)).distinct()
    several = groups.groupBy("doc_id").agg(F.min("fp").alias("a"), F.max("fp").alias("b")).filter("a != b")
    several = staged(several.select(F.col("doc_id").alias(several_id)), "simhash-several")
    own_id = F.col(id_col).cast("long")
    if several.isEmpty():
        return docs.join(ids, own_id == F.col(gone_id), "left_anti")
    # Ids with several texts are rare: only their rows meet their fingerprints again, by the text itself.
    once = ids.join(several, F.col(gone_id) == F.col(several_id), "left_anti")
    plain = docs.join(several, own_id == F.col(several_id), "left_anti").join(once, own_id == F.col(gone_id), "left_anti")
    rows = docs.join(several, own_id == F.col(several_id), "left_semi")
    rows = staged(rows.withColumn(same_text, F.sha2(F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")), 256)), "simhash-rows")
    marks = fingerprints(rows, words, id_col, text_col, keep=same_text)
    bad = marks.join(gone.select("doc_id", "fp"), ["doc_id", "fp"], "left_semi").select(
        F.col("doc_id").alias(gone_id), F.col(same_text).alias(several_id)
    )
    same = (own_id == F.col(gone_id)) & (F.col(same_text) == F.col(several_id))
    return plain.unionByName(rows.join(bad.distinct(), same, "left_anti").drop(same_text))
