"""Incremental bronze ingest: every new file is loaded exactly once."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlens.operators.broadcasting import checked_broadcast
from wardlens.sources.bronze import SOURCES
from wardlens.sources.delimited import FILE, RAW, REASON, Load, as_rows, options, raw_schema
from wardlens.sources.tables import RejectLimitExceeded, loaded, put_files, record_load, record_rejects
from wardlens.session import remove_path, shared_path

# Files are told apart by name alone, however old: the source's default would drop a file whose
# modification time lies a week before the newest one it has seen.
ANY_AGE = "36500d"


def _new_lines(
    spark: SparkSession, folder: str, schema: T.StructType, sep: str, charset: str, files: int
) -> DataFrame:
    return (
        spark.readStream.schema(raw_schema(schema))
        .options(**options(sep, charset, header=True))
        .option("maxFilesPerTrigger", files)
        .option("maxFileAge", ANY_AGE)
        .csv(folder)
    )


def ingest_available(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    sep: str = ",",
    charset: str = "UTF-8",
    files_per_batch: int = 1000,
) -> Load:
    """Append the checked rows of files not seen before to Parquet at `target`, then stop.

    The checkpoint remembers the files seen and the sink's log the batches committed, so
    running again, or after a failure, neither repeats nor loses a file, of any age. The stream
    is stateless: rows are checked and appended, nothing is kept between batches.
    """
    lines = _new_lines(spark, folder, schema, sep, charset, files_per_batch)
    query = (
        as_rows(lines, schema, sep, charset)
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return ingested(spark, schema, target)


def ingested(spark: SparkSession, schema: T.StructType, target: str) -> Load:
    """Everything ingested so far: good rows, rejects and the per-file report."""
    return Load(spark.read.parquet(target), schema)


def quarantine_table(table: str) -> str:
    return f"{table}_quarentena"


def keep_aside(bad: Load, table: str, run: str, sep: str) -> None:
    """All lines of files over their limit: file, line, the reason if the line has one, and the load."""
    fields = F.to_csv(F.struct(*[F.col(f.name) for f in bad.schema]), {"sep": sep, "escape": '"'})
    bad.rows.select(
        F.col(FILE).alias("arquivo"), F.coalesce(F.col(RAW), fields).alias("linha"), F.col(REASON).alias("motivo"), F.lit(run).alias("carga")
    ).write.mode("append").partitionBy("carga").saveAsTable(table)


def ingest_table(
    spark: SparkSession,
    folder: str,
    database: str,
    checkpoint: str,
    source: str = "admissions",
    files_per_batch: int = 1000,
    reject_limit: int | None = None,
    quarantine: bool = False,
) -> str:
    """Load files not seen before into a source's bronze table and its load report, then stop.

    A batch of files behaves as one load: over the reject limit nothing of it is added, it is
    reported as failed, and the run stops with the error; the next run takes up the same files.
    With `quarantine` the limit is each file's own: a file over it is reported as failed, all its lines
    are kept in the table `quarantine_table` names, and the others are loaded, now and in later
    runs. It is taken up again when it comes under another name.

    The table holds a partition for each file, as `load_files` writes it: loads and streams share it,
    and a batch run twice after a failure replaces its own rows. Returns the table's name.
    """
    spec = SOURCES[source]
    table = f"{database}.{spec.table}"
    limit = spec.reject_limit if reject_limit is None else reject_limit
    stream = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]
    def add(rows: DataFrame, number: int) -> None:
        session = rows.sparkSession
        name = f"{stream}-{number}"
        stage = shared_path(session, "stage")
        try:
            rows.write.parquet(stage)
            staged = Load(session.read.schema(rows.schema).parquet(stage), spec.schema)
            if quarantine:
                # Counted first: a shuffle join would bring all lines of a file into one task.
                over = checked_broadcast(staged.rejected.groupBy(FILE).count().where(F.col("count") > limit).select(FILE))
                sound, bad = (Load(staged.rows.join(over, FILE, how), spec.schema) for how in ("left_anti", "left_semi"))
                failed = 0
            else:
                sound, bad, failed = staged, None, staged.rejected.count()
                failed = failed if failed > limit else 0
            if not failed:
                put_files(sound.good_by_file, table)
            record_rejects(staged, table, name, spec.sep)
            if not loaded(session, table, name):
                if bad is not None:
                    keep_aside(bad, quarantine_table(table), name, spec.sep)
                    record_load(bad, table, name, True)
                record_load(sound, table, name, bool(failed))
        finally:
            remove_path(session, stage)
        if failed:
            raise RejectLimitExceeded(f"{table}: {failed} rows rejected, limit {limit}")

    lines = _new_lines(spark, folder, spec.schema, spec.sep, spec.charset, files_per_batch)
    query = (
        as_rows(lines, spec.schema, spec.sep, spec.charset)
        .writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return table
