"""Mixing sources to target weights by hash-threshold histograms.

Every document has a size in words and a 60-bit hash of its id and text. A source's target is its
share of the budget by weight; it stops at `limit` times the source's size, and what is left over is
shared again by weight among the others. A source is taken `target / size` times: whole passes first,
then the documents whose hash lies below a threshold. The passes' thresholds are nested, so the
documents of a later pass are among those of the pass before.

The threshold comes from histograms: words are summed by source and hash bucket, the bucket in which
the running sum crosses the budget is the boundary, and only its documents are dealt into finer
buckets, until it holds a single hash. That hash is taken if it brings the sum nearer to the budget.
Documents are then filtered by comparing two numbers; nothing is sorted by hash. A source's words
differ from its target by at most half of the words at its boundary hash.

Sums are combined before every shuffle, so a source that holds most rows sends a row per bucket and
task. Per-source tables are broadcast only after their size has been checked. Built-in expressions
only; each step is written to the shared folder.

Null text counts as empty, size zero; such documents are returned, nothing is taken of them. A null
source is a source of its own, the last one. Null ids hash as empty ids. Rows that repeat an id and
text share a hash: they are taken together or not at all. Without documents the result is empty.
Only the id, text and source columns are read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardlens.llm.staging import partitions, staged

HASH_DIGITS = 15
HASH_BITS = 4 * HASH_DIGITS
BUCKET_BITS = 10
#: Per-source rows of a few longs, and bytes of source names, that may be broadcast.
MAX_SOURCES = 100_000
MAX_NAME_BYTES = 4 << 20
_WORD = r"[^\x20\x09-\x0D]+"


def stable_hash(doc_id: Column, text: Column) -> Column:
    """60 bits of the MD5 of id and text: the same in every run and in other engines."""
    key = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, HASH_DIGITS), 16, 10).cast("long")


def _small(table: DataFrame, name: str) -> DataFrame:
    """A stored per-source table of longs, marked for broadcast if it has few rows."""
    stored = staged(table, name)
    return F.broadcast(stored) if stored.limit(MAX_SOURCES + 1).count() <= MAX_SOURCES else stored


def ranked_sources(sized: DataFrame) -> DataFrame:
    """source, source_size and place (from 0) in code-point order, null last.

    Places are counted within ranges of names and offset by the rows of the ranges before, so that the
    names of a corpus with very many sources never meet in one task.
    """
    order = [F.col("source").isNull(), F.col("source")]
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranges = sums.repartitionByRange(partitions(sized.sparkSession), *order).withColumn(
        "part", F.spark_partition_id()
    )
    ranges = staged(ranges, "mix-sources")
    counts = ranges.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    # One row per range: their number is a setting, not the input's size.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    within = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    return ranges.withColumn("n", within).join(F.broadcast(starts), "part").select(
        "source", "source_size", (F.col("start") + F.col("n") - 1).alias("place")
    )


def targets(sources: DataFrame, weights: tuple[int, ...], limit: int) -> DataFrame:
    """Adds target: the share by weight of all words, at most `limit` times the source's size.

    A level (words per weight) is raised until the sources that stop below it no longer change; each
    round is one aggregate of which four numbers reach the driver. Decisions are made on integers.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    sources = staged(sources.withColumn("weight", weight.cast("long")), "mix-ranked")
    most = F.col("source_size") * limit

    def sums(rows: DataFrame) -> tuple[int, int]:
        row = rows.agg(F.sum("source_size"), F.sum("weight")).first()
        return row[0] or 0, row[1] or 0

    words, weighed = sums(sources)
    capped = (0, 0)
    while True:
        left, over = words - limit * capped[0], weighed - capped[1]

        def exact(n: Column) -> Column:
            return n.cast("decimal(19,0)")

        full = exact(most) * exact(F.lit(over)) < exact(F.col("weight")) * exact(F.lit(left))
        now = sums(sources.filter(full))
        if now == capped:
            break
        capped = now
    share = (F.col("weight") * left).cast("double") / F.lit(float(over or 1))
    return sources.withColumn("target", F.when(full, most.cast("double")).otherwise(share))


def thresholds(sized: DataFrame, budgets: DataFrame) -> DataFrame:
    """place and cut: the documents of a source with a hash below cut have about `budget` words.

    sized: place, size, h. budgets: place, budget. Sources whose documents all fit get no row.
    """
    rows, bounds, below, bits, found = sized, budgets, F.lit(0).cast("long"), HASH_BITS, []
    while bits:
        bits -= BUCKET_BITS
        bucket = F.shiftright("h", bits)
        sums = rows.groupBy("place", bucket.alias("bucket")).agg(
            F.sum("size").alias("words"), F.min("h").alias("first"), F.max("h").alias("last")
        )
        running = F.sum("words").over(Window.partitionBy("place").orderBy("bucket"))
        crossed = (
            sums.withColumn("upto", running)
            .join(bounds, "place")
            .withColumn("upto", F.col("upto") + below)
            .filter((F.col("upto") > F.col("budget")) & (F.col("upto") - F.col("words") <= F.col("budget")))
            .withColumn("below", F.col("upto") - F.col("words"))
        )
        crossed = _small(crossed.select("place", "budget", "bucket", "below", "upto", "first", "last"), "mix-boundary")
        nearer = F.col("upto") - F.col("budget") < F.col("budget") - F.col("below")
        found.append(
            crossed.filter("first = last").select("place", F.when(nearer, F.col("first") + 1).otherwise(F.col("first")).alias("cut"))
        )
        bounds = crossed.filter("first < last").select("place", "budget", "below", "bucket")
        if bounds.isEmpty():
            break
        below = F.col("below")
        inner = rows.withColumn("bucket", bucket).join(bounds.select("place", "bucket"), ["place", "bucket"], "left_semi")
        rows = staged(inner.select("place", "size", "h"), "mix-inner")
        bounds = bounds.drop("bucket")
    return reduce(DataFrame.unionByName, found)


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = (5, 2, 1),
    limit: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """doc_id, source, size, source_size, target (its source's) and taken (words the mix takes) of every row.

    Weights go to the sources in code-point order, null last, and repeat. The targets share all words.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    sized = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        F.regexp_count(text, F.lit(_WORD)).cast("long").alias("size"),
        stable_hash(F.col(id_col), text).alias("h"),
    )
    sized = staged(sized, "mix-sizes")
    sources = targets(ranked_sources(sized), weights, limit)
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    budget = F.greatest(F.lit(0.0), F.col("target") - F.col("passes") * F.col("source_size"))
    sources = staged(sources.withColumn("passes", passes).withColumn("budget", budget), "mix-targets")
    names = sources.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(F.coalesce("source", F.lit("")))), F.lit(0))
    ).first()
    few = names[0] <= MAX_SOURCES and names[1] <= MAX_NAME_BYTES
    placed = sources.select(F.col("source").alias("name"), "place")
    placed = F.broadcast(placed) if few else placed
    sized = staged(
        sized.join(placed, F.col("source").eqNullSafe(F.col("name"))).drop("name"),
        "mix-placed",
    )
    cuts = thresholds(sized.select("place", "size", "h"), sources.select("place", "budget"))
    last = _small(
        sources.select("place", "source_size", "target", "passes").join(cuts, "place", "left"), "mix-cuts"
    )
    again = (F.col("h") < F.coalesce("cut", F.lit(1 << HASH_BITS))).cast("long")
    return sized.join(last, "place").select(
        "doc_id", "source", "size", "source_size", "target", (F.col("size") * (F.col("passes") + again)).alias("taken")
    )
