"""Bronze loads: which layout, file format and reject limit each source has."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from wardlens.sources import schemas
from wardlens.sources.delimited import WINDOWS, Load, read_delimited
from wardlens.sources.report import read_month_rows, read_report
from wardlens.sources.tables import load_files


@dataclass
class Source:
    table: str
    schema: T.StructType | None  # None: every file's header declares it
    sep: str = ";"
    charset: str = WINDOWS
    preamble: int = 0
    reject_limit: int = 100

    def read(self, spark: SparkSession, path: str | list[str], names: str = "skip") -> Load:
        if self.schema is None:
            return read_month_rows(spark, path, self.preamble, self.sep, self.charset)
        if self.preamble:
            return read_report(spark, path, self.schema, self.preamble, self.sep, self.charset)
        return read_delimited(spark, path, self.schema, self.sep, self.charset, names=names)


# Table names, separators, preamble lines and reject limits of the sources.
SOURCES = {
    "stays": Source("brz_sih_tabnet_raw", None, preamble=4),
    "beds": Source("brz_cnes_leitos_raw", schemas.BEDS),
    "admissions": Source(
        "brz_sih_rd_raw", schemas.ADMISSIONS, sep=",", charset="UTF-8", reject_limit=10_000
    ),
    "codes": Source("brz_cid_subcategorias_raw", schemas.DISEASE_CODES),
    "chapters": Source("brz_cid_capitulos_raw", schemas.DISEASE_CHAPTERS),
}
TABLES = {name: source.table for name, source in SOURCES.items()}


def load(
    spark: SparkSession,
    database: str,
    source: str,
    path: str,
    replace: bool = False,
    again: bool = False,
    names: str = "skip",
    reject_limit: int | None = None,
) -> DataFrame:
    """Load files (a path, folder or wildcard) of one source; returns their load report.

    A file whose rows are in the table is passed over, unless it is to be loaded `again`: then it takes
    the place of its own earlier rows. `replace` puts the files in place of the whole table.
    """
    spec = SOURCES[source]
    limit = spec.reject_limit if reject_limit is None else reject_limit
    return load_files(
        spark,
        lambda paths: spec.read(spark, paths, names),
        path,
        f"{database}.{spec.table}",
        limit,
        "table" if replace else "files" if again else "new",
        spec.sep,
    )
