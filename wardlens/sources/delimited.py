"""Delimited text files into declared layouts, with reject accounting.

A file is read once, every field as text. Type and width checks are columns on that
DataFrame, so good rows, rejects and the load report are three views of one parse.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlens.sources.schemas import WIDTH, as_text

FILE = "_arquivo"
RAW = "_linha"
REASON = "_motivo"
SURPLUS = "_excedente"
WINDOWS = "windows-1252"

# Windows-1252 differs from ISO-8859-1 in 0x80-0x9F only. Spark reads the latter natively;
# these are the control characters it yields there and the characters they stand for.
_PAIRS = [
    (chr(code), bytes([code]).decode("cp1252", "ignore"))
    for code in range(0x80, 0xA0)
    if bytes([code]).decode("cp1252", "ignore")
]
_LATIN1 = "".join(latin for latin, _ in _PAIRS)
_CP1252 = "".join(windows for _, windows in _PAIRS)


def from_windows(value: Column) -> Column:
    """Text decoded as ISO-8859-1, corrected to Windows-1252."""
    return F.translate(value, _LATIN1, _CP1252)


def file_name() -> Column:
    """Name of the file a row comes from. The reader gives it as part of a URL."""
    return F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))


def options(sep: str, charset: str, header: bool) -> dict[str, str]:
    return {
        "sep": sep,
        "header": str(header).lower(),
        "encoding": "ISO-8859-1" if charset == WINDOWS else charset,
        "escape": '"',
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": RAW,
        # The reader notices surplus fields only when it parses whole rows; the checks need
        # every column anyway.
        "columnPruning": "false",
    }


def raw_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([*as_text(schema), T.StructField(RAW, T.StringType())])


def as_rows(lines: DataFrame, schema: T.StructType, sep: str, charset: str) -> DataFrame:
    """Adds the source file and the checks to rows read with `raw_schema`."""
    decode = from_windows if charset == WINDOWS else (lambda c: c)
    rows = lines.select(
        *[decode(F.col(f.name)).alias(f.name) for f in schema],
        decode(F.col(RAW)).alias(RAW),
        file_name().alias(FILE),
    )
    return checked(rows, schema, sep)


def checked(rows: DataFrame, schema: T.StructType, sep: str) -> DataFrame:
    return rows.withColumn(REASON, reject_reason(schema)).withColumn(
        SURPLUS, surplus_fields(len(schema), sep)
    )


def reject_reason(schema: T.StructType) -> Column:
    """The first declared rule a row breaks, or NULL. Missing fields break none.

    The rules are gone through only for rows that may break one: texts of one width are first held
    against it by the longest of them.
    """
    rules, suspect = [], []
    lengths: dict[int, list[Column]] = {}
    for field in schema:
        value = F.col(field.name)
        if isinstance(field.dataType, T.StringType):
            width = field.metadata[WIDTH]
            # A text has at most as many characters as bytes; counting bytes decodes nothing.
            wide = (F.octet_length(value) > width) & (F.length(value) > width)
            rules.append(F.when(wide, f"{field.name}: mais de {width} caracteres"))
            lengths.setdefault(width, []).append(F.octet_length(value))
        else:
            kind = field.dataType.simpleString()
            broken = value.isNotNull() & value.try_cast(kind).isNull()
            rules.append(F.when(broken, f"{field.name}: nao numerico"))
            suspect.append(broken)
    suspect += [(F.greatest(*found) if len(found) > 1 else found[0]) > width for width, found in lengths.items()]
    return F.when(reduce(or_, suspect), F.coalesce(*rules))


def surplus_fields(fields: int, sep: str) -> Column:
    """Whether a row has more fields than declared. Such rows are kept without the surplus.

    The reader keeps the raw line of rows whose field count differs, in either direction;
    separators outside quotes tell the two apart.
    """
    bare = F.regexp_replace(F.col(RAW), '"[^"]*"', "")
    surplus = F.regexp_count(bare, F.lit(f"[{sep}]")) >= fields
    return F.when(F.col(RAW).isNull(), False).otherwise(surplus)


@dataclass
class Load:
    """One load: the checked rows of some files and the layout they were checked against."""

    rows: DataFrame
    schema: T.StructType

    def _typed(self, *more: str) -> DataFrame:
        typed = [
            F.col(f.name)
            if isinstance(f.dataType, (T.StringType, T.ArrayType))
            else F.col(f.name).try_cast(f.dataType.simpleString()).alias(f.name)
            for f in self.schema
        ]
        return self.rows.where(F.col(REASON).isNull()).select(*typed, *more)

    @property
    def good(self) -> DataFrame:
        return self._typed()

    @property
    def good_by_file(self) -> DataFrame:
        """The good rows and, last, the name of the file each came from."""
        return self._typed(FILE)

    @property
    def rejected(self) -> DataFrame:
        return self.rows.where(F.col(REASON).isNotNull())

    def rejected_lines(self, sep: str = ";") -> DataFrame:
        """Rejected rows as text: file, line and reason.

        The reader keeps the raw line only of rows with another number of fields; others are written
        out again from their fields.
        """
        again = F.to_csv(F.struct(*[F.col(f.name) for f in self.schema]), {"sep": sep, "escape": '"'})
        return self.rejected.select(
            F.col(FILE).alias("arquivo"), F.coalesce(F.col(RAW), again).alias("linha"), F.col(REASON).alias("motivo")
        )

    @property
    def audit(self) -> DataFrame:
        """Load report: per file, rows read, rejected, and kept without surplus fields.

        Rows are counted by file and reason first: the least of texts would be found by sorting the rows.
        """
        counted = self.rows.groupBy(F.col(FILE).alias("arquivo"), F.col(REASON).alias("motivo")).agg(
            F.count("*").alias("linhas"), F.count_if(F.col(SURPLUS)).alias("com_excedente")
        )
        return counted.groupBy("arquivo").agg(
            F.sum("linhas").alias("lidas"),
            F.sum(F.when(F.col("motivo").isNotNull(), F.col("linhas")).otherwise(0)).alias("rejeitadas"),
            F.sum("com_excedente").alias("com_excedente"),
            F.min("motivo").alias("motivo"),
        )


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    sep: str = ";",
    charset: str = WINDOWS,
    header: bool = True,
    names: str = "skip",
) -> Load:
    """Files, folders or wildcards of one layout.

    `names` says what a file's header line is for: "skip" it and match fields by position, as the
    source does; "check" that it names the layout's columns in their order, else the load fails; or
    "map" fields by it, file by file, in any order. Names are compared without regard to case. Mapped
    files may lack columns, which stay NULL, and have others, which count as surplus; a file that names
    none of the layout's columns fails. Mapped fields cannot hold line breaks.
    """
    if names == "map":
        return _read_by_name(spark, path, schema, sep, charset)
    if names not in ("skip", "check"):
        raise ValueError(f"names is skip, check or map, not {names}")
    reader = spark.read.schema(raw_schema(schema)).options(**options(sep, charset, header))
    if names == "check":
        reader = reader.option("enforceSchema", "false")
    return Load(as_rows(reader.csv(path), schema, sep, charset), schema)


def _read_by_name(
    spark: SparkSession, path: str | list[str], schema: T.StructType, sep: str, charset: str
) -> Load:
    from wardlens.sources.lines import FIELDS, LINE, NAMES, demand, lines_under_headers

    declared = F.array(*[F.lit(f.name.lower()) for f in schema])
    # Where a file has each declared column (from 1; 0: nowhere), and what else its header says.
    of_names = {
        "lugares": F.array(*[F.array_position(NAMES, f.name.lower()).cast("int") for f in schema]),
        "estranhas": F.size(F.array_except(NAMES, declared)) > 0,
        "largura": F.size(NAMES),
    }
    lines, headers = lines_under_headers(spark, path, 1, sep, charset, of_names)
    demand(headers, F.arrays_overlap(NAMES, declared), "the header names no column of the layout")

    def field(name: str, number: int) -> Column:
        at = F.get("lugares", F.lit(number))
        return F.when(at > 0, F.get(FIELDS, at - 1)).alias(name)

    fields = [field(f.name, k) for k, f in enumerate(schema)]
    surplus = F.col("estranhas") | (F.size(FIELDS) > F.col("largura"))
    rows = lines.select(*fields, F.col(LINE).alias(RAW), FILE, surplus.alias(SURPLUS))
    return Load(rows.withColumn(REASON, reject_reason(schema)), schema)
