"""Exact dedup against a persistent digest index.

The index is a table of (digest, keep_id), bucketed and sorted by digest. A batch of documents is
folded to one row per digest, anti-joined with the index by sort-merge over the buckets, and the
digests that are new are appended. The texts never move: only 32-byte digests are shuffled.

Texts are equal if identical after lower-casing A-Z; null counts as empty. Of equal texts in one
batch the largest id stays, unless an earlier batch has put the text into the index: then nothing of
the batch stays. A batch that is run again under its name, after a failure at any point, gets the verdicts
of its first run. Appending leaves a file per batch and bucket; `compacted` merges them.
Rows repeated with the same id and text are copies of each other; exactly one of them can stay. A
null id loses against any other; if all ids are null, one row stays. An empty batch adds nothing.
Only the id and text columns are read; others may have any name.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlens.llm.staging import ascii_lower, partitions, staged, unused
from wardlens.session import shared_path


def text_digest(text: str):
    return F.unhex(F.sha2(ascii_lower(F.col(text)), 256))


class DigestIndex:
    """Digests seen so far, in a bucketed table at `path`.

    An existing folder is attached, in any session, with the buckets it was written with. For a new one
    choose `buckets` so that a bucket of some 60-byte rows fits an executor's memory: 4,096 for ten
    billion documents. Unless given, it is the session's number of shuffle partitions.
    """

    def __init__(self, spark: SparkSession, path: str, name: str | None = None, buckets: int | None = None):
        self.spark, self.path = spark, path
        self.name = name or f"digest_index_{uuid.uuid4().hex[:12]}"
        kept = f"{path}/_buckets"  # not a data file by its name
        try:
            self.buckets = spark.read.schema("buckets int").parquet(kept).first().buckets
        except AnalysisException:
            self.buckets = buckets or partitions(spark)
            spark.createDataFrame([(self.buckets,)], "buckets int").coalesce(1).write.parquet(kept)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (digest BINARY, keep_id BIGINT, batch STRING) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{path}'"
        )

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def _dealt(self, groups: DataFrame) -> DataFrame:
        """Co-partitioned with the buckets, so that the index itself is not shuffled."""
        return groups.repartition(self.buckets, "digest").hint("merge")

    def _append(self, rows: DataFrame) -> None:
        rows.select("digest", "keep_id", "batch").sortWithinPartitions("digest").write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)

    def add(
        self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batch: str | None = None
    ) -> DataFrame:
        """Deduplicate a batch and append what is new. A batch with a name may be run again.

        Returns a row per document: doc_id, keep_id, group_size (rows of the batch with this text),
        kept, digest, n_rows (of the batch with this id and text).
        """
        batch = batch or uuid.uuid4().hex
        rows = staged(
            docs.select(F.col(id_col).cast("long").alias("doc_id"), text_digest(text_col).alias("digest"))
            .groupBy("digest", "doc_id")
            .agg(F.count(F.lit(1)).alias("n_rows")),
            "dedup-rows",
        )
        groups = staged(
            rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.sum("n_rows").alias("group_size")),
            "dedup-groups",
        )
        known = self._dealt(groups).join(
            self.table().select("digest", F.col("keep_id").alias("old_id"), (F.col("batch") != batch).alias("old")),
            "digest",
            "left",
        )
        winners = staged(
            known.select(
                "digest",
                F.when(F.col("old"), F.col("old_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                "group_size",
                F.coalesce("old", F.lit(False)).alias("old"),
            ),
            "dedup-winners",
        )
        new = self._dealt(groups.select("digest", "keep_id")).join(self.table(), "digest", "left_anti")
        self._append(new.withColumn("batch", F.lit(batch)))
        copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_rows"))).alias("copy")
        return (
            rows.join(winners, "digest")
            .select("*", copies)
            .select(
                "doc_id",
                "keep_id",
                "group_size",
                (~F.col("old") & F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
                "digest",
                "n_rows",
            )
        )

    def compacted(self, path: str, buckets: int | None = None) -> DigestIndex:
        """The same index at a new path, with one sorted file per bucket; also to change their number."""
        new = DigestIndex(self.spark, path, buckets=buckets or self.buckets)
        new._append(new._dealt(self.table()))
        return new

    def drop(self) -> None:
        """Forget the table; its files stay and can be attached again."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None
) -> DataFrame:
    """One batch against an index of its own."""
    spark = docs.sparkSession
    index = DigestIndex(spark, shared_path(spark, "digest-index"), buckets=buckets)
    verdicts = index.add(docs, id_col, text_col)
    index.drop()
    return verdicts


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns.

    Rows repeated with the same id and text are rare and told apart only where they occur.
    """
    own, key, of, rows = unused(docs, "own_digest", "kept_id", "kept_digest", "n_rows")
    stay = exact_dedup(docs, id_col, text_col).filter("kept")
    stay = staged(stay.select(F.col("doc_id").alias(key), F.col("digest").alias(of), F.col("n_rows").alias(rows)), "dedup-kept")
    marked = docs.withColumn(own, text_digest(text_col))
    same = F.col(id_col).cast("long").eqNullSafe(F.col(key)) & (F.col(own) == F.col(of))
    kept = marked.join(stay.filter(F.col(rows) == 1), same, "left_semi")
    repeated = stay.filter(F.col(rows) > 1)
    if not repeated.isEmpty():
        again = marked.join(repeated, same, "left_semi")
        kept = kept.unionByName(again.dropDuplicates([id_col, own]))
    return kept.drop(own)
