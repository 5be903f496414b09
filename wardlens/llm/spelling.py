"""Spelling variants of the corpus vocabulary by finite-state composition.

The pairs of words at one edit are what  A o T o A  accepts: the vocabulary acceptor A, a transducer T
that replaces, deletes or inserts one code point, and the acceptor again. A state of the composition is
(p, edits, q). Until the edit both sides read the same, so the state is (p, 0, p); after it they must
read the same remainder, from (p, 1, q). An edit is made where the two words first differ: of a run of
equal letters the last one is deleted. So every pair has one path and is enumerated once.

The composition is split by initial states. A prefix with few words below it is one initial state
(p, 0, p): its task builds the minimised acceptor of the remainders, composes it and enumerates what it
accepts; an edit is looked at once per state of the acceptor, not once per word. Prefixes with many
words are read one letter further, until every initial state has at most `most` words, so no
task holds more, however many words begin alike. Pairs that differ within the letters read by then are
the initial states (p, 1, q): both sides must accept the same remainder, which is an equality join on
the place of the edit and what is left of the word without it. A group of that join has at most
one word per letter of the alphabet and one without.

A word is a maximal run of letters (ASCII and U+00C0 to U+00FF), lower-cased in A-Z only. If 31
divides the CRC-32 of `<doc_id>:<run>`, one code point is deleted from it. Null text has no words; a
null id counts as an empty string; repeated rows count again. Only the id and text columns are read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlens.llm.staging import partitions, ship_package, staged

MOST = 5_000
RATIO = 10
#: Prefixes that may be broadcast; each stands for over MOST words.
MAX_PREFIXES = 100_000
_FLUSH = 200_000
#: A run whose checksum this divides loses a letter.
VARIED = 31
_BATCH = 20_000
#: Stands after the last letter; no letter of a word, and smaller than all of them.
END = "$"


def varied(run: str, checksum: int) -> str:
    """The run without the code point at checksum mod length."""
    at = checksum % len(run)
    return run[:at] + run[at + 1 :]


def vocabulary(
    docs: DataFrame, least_letters: int = 7, least_uses: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """word and n: the words of the corpus and how often they occur. Counts are combined in every task."""
    runs = re.compile("[a-zÀ-ÿ]{%d,}" % least_letters)

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def emptied() -> pa.RecordBatch:
            kept = {w: n for w, n in total.items() if n}
            total.clear()
            return pa.record_batch([pa.array(list(kept), pa.string()), pa.array(list(kept.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                # bytes.lower() knows A-Z only. Shorter runs are no words, whether they lose a letter or not.
                found = runs.findall((text.as_py() or b"").lower().decode(errors="replace"))
                total.update(found)
                start = zlib.crc32(f"{doc_id}:".encode())
                changed = [(w, h) for w in set(found) if not (h := zlib.crc32(w.encode(), start)) % VARIED]
                for run, h in changed:
                    n = found.count(run)
                    total[run] -= n
                    if len(run) > least_letters:
                        total[varied(run, h)] += n
                if len(total) >= _FLUSH:
                    yield emptied()
        if total:
            yield emptied()

    ship_package(docs.sparkSession)
    picked = docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("doc_id"), F.col(text_col).cast("binary").alias("text")
    )
    found = picked.mapInArrow(counts, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_uses)


class Acceptor:
    """The minimised deterministic acceptor of a sorted list of words (incremental construction).

    States are numbers; `arcs[state]` maps letters to states. Every word ends in END, so the state
    after END is the only final one and acceptance needs no flag.
    """

    def __init__(self, words: list[str]):
        self.arcs: list[dict[str, int]] = [{}]
        self.register: dict[tuple, int] = {}
        path, last = [{}], ""  # arcs of the states along the last word, the last letter's target still open
        letters: list[str] = []
        for word in words:
            shared = 0
            while shared < min(len(word), len(last)) and word[shared] == last[shared]:
                shared += 1
            self._close(path, letters, shared)
            for letter in word[shared:]:
                letters.append(letter)
                path.append({})
            last = word
        self._close(path, letters, 0)
        self.root = self._number(path[0])

    def _number(self, arcs: dict[str, int]) -> int:
        key = tuple(arcs.items())  # built from sorted words: in letter order
        if key not in self.register:
            if key:
                self.arcs.append(arcs)
            self.register[key] = len(self.arcs) - 1 if key else 0
        return self.register[key]

    def _close(self, path: list[dict[str, int]], letters: list[str], upto: int) -> None:
        while len(letters) > upto:
            arcs = path.pop()
            path[-1][letters.pop()] = self._number(arcs)


def spelt(read: tuple | None) -> str:
    """The letters of a path that is kept as (path before, letter)."""
    letters = []
    while read is not None:
        read, letter = read
        letters.append(letter)
    return "".join(reversed(letters))


class OneEdit:
    """What the acceptor composed with the one-edit transducer and itself accepts."""

    def __init__(self, acceptor: Acceptor):
        self.arcs, self.root = acceptor.arcs, acceptor.root
        self.common: dict[tuple[int, int], bool] = {}

    def _meets(self, p: int, q: int) -> bool:
        """Whether state (p, 1, q) accepts anything. Depth first without recursion: words may be long."""
        known = self.common
        if p == q:
            return True
        if (found := known.get((p, q))) is not None:
            return found
        path = [(p, q, self._steps(p, q))]
        while path:
            a, b, steps = path[-1]
            for t, u in steps:
                state = known.get((t, u))
                if t == u or state:
                    known.update(((x, y), True) for x, y, _ in path)
                    return True
                if state is None:
                    path.append((t, u, self._steps(t, u)))
                    break
            else:
                known[a, b] = False
                path.pop()
        return False

    def _steps(self, p: int, q: int) -> Iterator[tuple[int, int]]:
        a, b = self.arcs[p], self.arcs[q]
        if len(a) <= len(b):
            return ((t, b[c]) for c, t in a.items() if c in b)
        return ((a[c], u) for c, u in b.items() if c in a)

    def _remainders(self, p: int, q: int, but: str = "") -> Iterator[str]:
        """What both p and q accept, except what begins with `but`."""
        stack = [(None, p, q)]
        while stack:
            read, p, q = stack.pop()
            if not self.arcs[p] and p == q:
                yield spelt(read)
                continue
            a, b = self.arcs[p], self.arcs[q]
            for c, t in a.items():
                if c in b and not (read is None and c == but) and self._meets(t, b[c]):
                    stack.append(((read, c), t, b[c]))

    def edits(self, p: int) -> list[tuple[str, str]]:
        """Pairs of remainders that differ in their first place, by an edit made in state (p, 0, p)."""
        arcs = list(self.arcs[p].items())
        out = []
        for i, (c, t) in enumerate(arcs):
            if c == END:
                continue
            for d, u in arcs[i + 1 :]:
                if d != END and self._meets(t, u):
                    out += [(c + rest, d + rest) for rest in self._remainders(t, u)]
            if any(e != c and e in self.arcs[t] for e, _ in arcs):
                out += [(c + rest, rest) for rest in self._remainders(t, p, but=c)]
        return out

    def pairs(self) -> Iterator[tuple[str, str]]:
        """All accepted pairs, END included. States are left as soon as nothing below them has an edit."""
        order, seen, stack = [], set(), [self.root]
        while stack:
            p = stack.pop()
            if p not in seen:
                seen.add(p)
                order.append(p)
                stack += self.arcs[p].values()
        made = {p: self.edits(p) for p in order}
        # Targets are numbered before the states that lead to them.
        live = {}
        for p in sorted(seen):
            live[p] = bool(made[p]) or any(live[t] for t in self.arcs[p].values())
        walk = [(None, self.root)]
        while walk:
            read, p = walk.pop()
            if made[p]:
                start = spelt(read)
                yield from ((start + a, start + b) for a, b in made[p])
            walk += [((read, c), t) for c, t in self.arcs[p].items() if live[t]]


def initial_states(words: DataFrame, most: int = MOST) -> DataFrame:
    """word, n and read: the letters (with the end mark) of the prefix whose words stay together.

    A prefix with more than `most` words is read one letter further. Only counts of prefixes are
    shuffled, and of those only the ones that are too full come back.
    """
    done, depth = [], 1
    rest = staged(words, "spelling-words")
    while True:
        prefix = F.substring(F.concat("word", F.lit(END)), 1, depth)
        rest = rest.withColumn("prefix", prefix)
        full = staged(rest.groupBy("prefix").count().filter(F.col("count") > most).select("prefix"), "spelling-full")
        few = full.limit(MAX_PREFIXES + 1).count()
        if not few:
            return _union([*done, rest.withColumn("read", F.lit(depth))]).select("word", "n", "read")
        full = F.broadcast(full) if few <= MAX_PREFIXES else full
        done.append(rest.join(full, "prefix", "left_anti").withColumn("read", F.lit(depth)))
        rest = staged(rest.join(full, "prefix", "left_semi").select("word", "n"), "spelling-deeper")
        depth += 1


def _union(frames: list[DataFrame]) -> DataFrame:
    first, *others = frames
    for other in others:
        first = first.unionByName(other)
    return first


def _below(rows: DataFrame) -> DataFrame:
    """Pairs (word, other) whose edit lies behind their common initial state."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefix, rests = None, []
        left: list[str] = []
        right: list[str] = []

        def accepted() -> None:
            rests.sort()
            for a, b in OneEdit(Acceptor(rests)).pairs():
                left.append((prefix + a)[:-1])
                right.append((prefix + b)[:-1])

        def out() -> pa.RecordBatch:
            made = pa.record_batch([pa.array(left, pa.string()), pa.array(right, pa.string())], names=["word", "other"])
            left.clear()
            right.clear()
            return made

        for batch in it:
            for word, read in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                word += END
                if word[:read] != prefix:
                    if len(rests) > 1:
                        accepted()
                    prefix, rests = word[:read], []
                    if len(left) >= _BATCH:
                        yield out()
                rests.append(word[read:])
        if len(rests) > 1:
            accepted()
        yield out()

    ship_package(rows.sparkSession)
    prefix = F.substring(F.concat("word", F.lit(END)), F.lit(1), F.col("read"))
    dealt = (
        rows.select("word", "read", prefix.alias("prefix"))
        .repartition(partitions(rows.sparkSession), "prefix")
        .sortWithinPartitions("prefix")
        .select("word", "read")
    )
    return dealt.mapInArrow(batches, "word string, other string")


def _above(rows: DataFrame) -> DataFrame:
    """Pairs (word, other) that differ within the letters their initial states have read."""

    def letters(start: Column, n: Column | int) -> Column:
        return F.substring(F.col("marked"), start, n if isinstance(n, Column) else F.lit(n))

    at = F.col("at")
    places = rows.select(
        "word", F.concat("word", F.lit(END)).alias("marked"), F.explode(F.sequence(F.lit(0), F.col("read") - 1)).alias("at")
    )
    rest = F.char_length("marked")
    cut = places.select(
        "word",
        "at",
        letters(at + 1, 1).alias("letter"),
        F.concat(letters(F.lit(1), at), letters(at + 2, rest)).alias("key"),
        (letters(at + 1, 1) != letters(at + 2, 1)).alias("last"),
    ).filter(F.col("letter") != END)
    whole = places.select("word", "at", F.col("marked").alias("key"))
    replaced = cut.alias("a").join(cut.alias("b"), ["at", "key"]).filter("a.letter < b.letter")
    deleted = cut.filter("last").alias("a").join(whole.alias("b"), ["at", "key"])
    pairs = [x.select(F.col("a.word").alias("word"), F.col("b.word").alias("other")) for x in (replaced, deleted)]
    return pairs[0].unionByName(pairs[1])


def near_words(words: DataFrame, most: int = MOST) -> DataFrame:
    """word, other: every pair of the vocabulary at one edit, once."""
    rows = staged(initial_states(words.select("word", "n"), most), "spelling-states")
    return _below(rows).unionByName(_above(rows))


def variant_forms(words: DataFrame, pairs: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, n, n_near, form, form_n and root of every word.

    form is the near word with the largest n (of equal ones the first in code-point order) if it occurs
    `ratio` times as often; root is what following the forms ends at. A form occurs more often than
    its word, so there are no circles, and following two steps at a time takes as many rounds as the
    logarithm of the longest way.
    """
    pairs = staged(pairs, "spelling-pairs")
    both = pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("word").alias("other")))
    counted = both.join(words.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")
    best = counted.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form"))).alias("best"),
    )
    rows = words.join(best, "word", "left").withColumn("form_n", -F.col("best.less"))
    true_form = F.col("form_n") >= ratio * F.col("n")
    rows = staged(
        rows.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(true_form, F.col("best.form")).alias("form"),
            F.when(true_form, F.col("form_n")).alias("form_n"),
        ),
        "spelling-forms",
    )
    ways = rows.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        steps = ways.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = F.col("further").isNotNull().alias("moved")
        ways = ways.join(steps, "root", "left").select("word", F.coalesce("further", "root").alias("root"), moved)
        ways = staged(ways, "spelling-roots")
        if ways.filter("moved").isEmpty():
            break
        ways = ways.drop("moved")
    return rows.join(ways.drop("moved"), "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(
    docs: DataFrame, least_letters: int = 7, least_uses: int = 2, ratio: int = RATIO, most: int = MOST,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word of the corpus."""
    words = staged(vocabulary(docs, least_letters, least_uses, id_col, text_col), "spelling-vocabulary")
    return variant_forms(words, near_words(words, most), ratio)
