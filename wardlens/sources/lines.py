"""Delimited text as one array of fields per line, next to the names its own file's header gives.

Nothing here depends on which columns a file has, so files with different columns or different
windows of months are read by one plan, and no header passes through the driver.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlens.operators.broadcasting import checked_broadcast
from wardlens.sources.delimited import FILE, WINDOWS, file_name, from_windows

PATH = "_caminho"
LINE, FIELDS, NAMES = "linha", "campos", "nomes"
# A quoted or a plain field behind its separator. No step back is ever needed: time is linear.
_FIELD = '{sep}("[^"]*+(?:""[^"]*+)*+"|[^{sep}]*+)'


class UnknownLayout(ValueError):
    """A file whose header does not name the columns of its layout."""


def split_fields(line: Column, sep: str) -> Column:
    """The fields of a line, without the quotes around them; empty ones are NULL."""
    pattern = _FIELD.format(sep=re.escape(sep))
    quoted = F.regexp_extract_all(F.concat(F.lit(sep), line), F.lit(pattern), F.lit(1))
    found = F.when(F.contains(line, F.lit('"')), quoted).otherwise(F.split(line, re.escape(sep)))

    def bare(field: Column) -> Column:
        inner = F.replace(F.substring(field, F.lit(2), F.char_length(field) - 2), F.lit('""'), F.lit('"'))
        return F.nullif(F.when(field.startswith('"'), inner).otherwise(field), F.lit(""))

    return F.transform(found, bare)


def _lines(spark: SparkSession, path: str | list[str], charset: str) -> DataFrame:
    """Decoded lines with their file and place. The text reader keeps a line's bytes as they are."""
    decoded = F.decode(F.col("value").cast("binary"), "ISO-8859-1" if charset == WINDOWS else charset)
    return spark.read.text(path).select(
        (from_windows(decoded) if charset == WINDOWS else decoded).alias(LINE),
        F.col("_metadata.file_path").alias(PATH),
        file_name().alias(FILE),
        (F.col("_metadata.file_block_start") == 0).alias("primeiro"),
        F.monotonically_increasing_id().alias("posicao"),
    )


def lines_under_headers(
    spark: SparkSession,
    path: str | list[str],
    skip: int,
    sep: str,
    charset: str = WINDOWS,
    of_names: dict[str, Column] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Lines below line `skip` of each file: the line, its fields, the names in line `skip`, the file.

    Also returned are the names alone, a row per file. `of_names` are more columns, made of the names once
    per file and given to each of its lines.

    Positions grow by one along a split, so a line's number is its distance from the first line of
    its file's first split. Only that position and the header, a row per file each, are aggregated
    and joined back (broadcast if few); the lines themselves are not shuffled, however large a file.
    A file of fewer than `skip` lines has no rows.
    """
    lines = _lines(spark, path, charset)
    starts = lines.where("primeiro").groupBy(PATH).agg(F.min("posicao").alias("inicio"))
    starts = checked_broadcast(starts)
    numbered = lines.join(starts, PATH).withColumn(
        "numero", F.when(F.col("primeiro"), F.col("posicao") - F.col("inicio") + 1)
    )
    # A mark in front of the first name and separators behind the last one are no names.
    header = F.rtrim(F.regexp_replace(LINE, "^(﻿|ï»¿)", ""), F.lit(sep))
    names = F.transform(split_fields(header, sep), lambda n: F.lower(F.trim(n)))
    headers = numbered.where(F.col("numero") == skip).select(F.col(PATH).alias("_de"), names.alias(NAMES))
    headers = checked_broadcast(headers.withColumns(of_names or {}))
    below = numbered.where((~F.col("primeiro") | (F.col("numero") > skip)) & (F.trim(LINE) != ""))
    # Filters over fields stop above the explode; below it they would split a line once for every field.
    rows = below.join(headers, F.col(PATH) == F.col("_de")).select(
        LINE, F.explode(F.array(split_fields(F.col(LINE), sep))).alias(FIELDS), NAMES, *(of_names or {}), FILE
    )
    return rows, headers


def demand(headers: DataFrame, holds: Column, what: str) -> None:
    """Fail if there is no header, or one that does not do; of those a single row reaches the driver."""
    wrong = headers.where(~F.coalesce(holds, F.lit(False))).select("_de", NAMES).first()
    if wrong is not None:
        raise UnknownLayout(f"{wrong[0]}: {what}: {wrong[1]!r}")
    if headers.isEmpty():
        raise UnknownLayout("no header line in any file")
