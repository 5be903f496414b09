"""Written intermediate tables in the folder the cluster shares."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlens.session import shared_path

_PACKAGE = Path(__file__).resolve().parents[1]
_shipped: set[str] = set()
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a plan as Parquet and read it back.

    A lost executor costs a re-read, not the work behind it; and, unlike a checkpoint, the scan
    promises no partitioning, so that the adaptive skew join can still split a hot key in it.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, which they may not have installed.

    The archive is built where the driver runs and served to the executors by Spark.
    """
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        base = f"{tempfile.mkdtemp(prefix='package-')}/{_PACKAGE.name}"
        context.addPyFile(shutil.make_archive(base, "zip", _PACKAGE.parent, _PACKAGE.name))
        _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower case for A-Z only; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())


def unused(df: DataFrame, *names: str) -> list[str]:
    """Column names like these that the frame does not have."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
