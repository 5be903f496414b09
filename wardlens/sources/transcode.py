"""Batch re-encoding of delimited files: legacy character set in, UTF-8 with header out."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlens.session import cut_lineage
from wardlens.sources.delimited import FILE, file_name
from wardlens.sources.tables import listing

STATUS = "pasta string, arquivo string, linhas bigint, bytes bigint, situacao string, erro string"


def _encoded(spark: SparkSession, files: list[str], sep: str, charset: str, out: str) -> DataFrame:
    """Write files of one layout below `out`, a folder for each; their names and numbers of rows."""
    source = spark.read.csv(files, sep=sep, header=True, encoding=charset, escape='"', enforceSchema=False)
    rows = source.withColumn(FILE, file_name())
    rows.write.mode("append").partitionBy(FILE).csv(out, header=True, encoding="UTF-8", escape='"')
    return rows.groupBy(FILE).count()


def transcode_files(
    spark: SparkSession,
    folders: list[str],
    target: str,
    pattern: str = "*.csv",
    sep: str = ";",
    charset: str = "ISO-8859-1",
) -> DataFrame:
    """Rewrite each file as a UTF-8 CSV folder below `target`; returns one status row per file.

    A folder is one read and one write, whatever the number of its files: rows are dealt to a folder
    `_arquivo=<name>` each, and the numbers of rows come from one aggregate, joined with the listing.
    If that fails, because a file cannot be read or names other columns than the rest, the files are
    halved until the ones that fail alone are found; a failed write leaves nothing behind. The driver
    holds file names only.
    """
    status: list[DataFrame] = []
    for number, folder in enumerate(folders):
        path = F.lit(folder).alias("pasta")
        try:
            files = listing(spark, f"{folder}/{pattern}")
            waiting = [sorted(r.caminho for r in files.select("caminho").collect())]
        except PySparkException:
            status.append(spark.createDataFrame([(folder, None, None, None, "PASTA AUSENTE OU VAZIA", None)], STATUS))
            continue
        counts, errors = [], []
        while waiting:
            part = waiting.pop()
            try:
                counts.append(_encoded(spark, part, sep, charset, f"{target}/{number:03d}"))
            except Exception as error:  # any failure of some files leaves the others alone
                if len(part) == 1:
                    errors.append((part[0], str(error).split("\n")[0][:300]))
                else:
                    waiting += [part[: len(part) // 2], part[len(part) // 2 :]]
        rows = reduce(DataFrame.unionByName, counts) if counts else spark.createDataFrame([], f"{FILE} string, count bigint")
        failed = spark.createDataFrame(errors, "caminho string, erro string")
        done = files.join(failed, "caminho", "left").join(rows.withColumnRenamed(FILE, "arquivo"), "arquivo", "left")
        ok = F.col("erro").isNull()
        status.append(
            done.select(
                path,
                "arquivo",
                F.when(ok, F.coalesce("count", F.lit(0))).alias("linhas"),
                "bytes",
                F.when(ok, "OK").otherwise("ERRO").alias("situacao"),
                "erro",
            )
        )
    return cut_lineage(reduce(DataFrame.unionByName, status)) if status else spark.createDataFrame([], STATUS)
