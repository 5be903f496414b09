"""Tabulated reports: a preamble of some lines, then delimited rows.

The preamble's last line names the columns. A report of months takes its layout from there: every
file says itself which months it holds, and files with different windows load together.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlens.sources.delimited import FILE, RAW, REASON, SURPLUS, WINDOWS, Load, checked, file_name, from_windows, raw_schema
from wardlens.sources.lines import FIELDS, LINE, NAMES, PATH, UnknownLayout, demand, lines_under_headers
from wardlens.sources.schemas import MONTH_ROWS, WIDTH, month_report

# Month abbreviations of the published reports.
MONTH_NAMES = "jan fev mar abr mai jun jul ago set out nov dez".split()
_YEAR_FIRST = re.compile(r"(\d{4})\W*(\d{2}|[a-z]{3})[a-z]*")
_YEAR_LAST = re.compile(r"(\d{2}|[a-z]{3})[a-z]*\W*(\d{4})")


def month_of(name: str) -> str | None:
    """YYYYMM of a column name such as 2024/Out, Out/2024, 2024-10 or 202410; else None."""
    name = name.strip().lower()
    if found := _YEAR_FIRST.fullmatch(name):
        year, month = found[1], found[2]
    elif found := _YEAR_LAST.fullmatch(name):
        year, month = found[2], found[1]
    else:
        return None
    number = MONTH_NAMES.index(month) + 1 if month in MONTH_NAMES else int(month) if month.isdigit() else 0
    return f"{year}{number:02d}" if 1 <= number <= 12 else None


def month_column(name: Column) -> Column:
    """`month_of` as a column expression over lower-case names."""
    year_first, year_last = _YEAR_FIRST.pattern, _YEAR_LAST.pattern

    def either(first: int, last: int) -> Column:
        return F.when(name.rlike(f"^{year_first}$"), F.regexp_extract(name, f"^{year_first}$", first)).when(
            name.rlike(f"^{year_last}$"), F.regexp_extract(name, f"^{year_last}$", last)
        )

    month = either(2, 1)
    named = F.array_position(F.array(*[F.lit(m) for m in MONTH_NAMES]), month)
    number = F.when(named > 0, named.cast("int")).otherwise(month.try_cast("int"))
    return F.when(number.between(1, 12), F.concat(either(1, 2), F.lpad(number.cast("string"), 2, "0")))


def month_layout(header: str, sep: str = ";") -> T.StructType:
    """The layout that a report's header line declares."""
    names = [n.strip().strip('"') for n in header.split(sep)]
    while names and not names[-1]:
        names.pop()
    total = len(names) > 1 and names[-1].lower() == "total"
    months = [month_of(n) for n in names[1 : len(names) - total]]
    if not months or None in months:
        raise UnknownLayout(f"not a label, months and a total: {header!r}")
    if len(set(months)) < len(months):
        raise UnknownLayout(f"a month is named twice: {header!r}")
    return month_report(months, total)


def numbered_lines(
    spark: SparkSession, path: str, skip: int, charset: str
) -> tuple[DataFrame, DataFrame]:
    """Physical lines of each file after its first `skip`, decoded; and line `skip` itself.

    Only the split at the start of a file can hold its preamble, and ids grow along a split.
    Lines of that one split (at most spark.sql.files.maxPartitionBytes of them) are numbered;
    all other splits pass straight through, so a large report stays parallel. The text reader
    keeps a line's bytes as they are, which lets the decoding happen here.
    """
    decoded = F.decode(
        F.col("value").cast("binary"), "ISO-8859-1" if charset == WINDOWS else charset
    )
    lines = spark.read.text(path).select(
        (from_windows(decoded) if charset == WINDOWS else decoded).alias("linha"),
        F.col("_metadata.file_path").alias(PATH),
        file_name().alias(FILE),
        F.col("_metadata.file_block_start").alias("inicio"),
        F.monotonically_increasing_id().alias("posicao"),
    )
    order = Window.partitionBy(PATH).orderBy("posicao")
    first_split = lines.where("inicio = 0").withColumn("numero", F.row_number().over(order))
    below = first_split.where(F.col("numero") > skip).select("linha", FILE, PATH)
    header = first_split.where(F.col("numero") == skip).select("linha", PATH)
    return below.unionByName(lines.where("inicio > 0").select("linha", FILE, PATH)), header


def lines_after(spark: SparkSession, path: str, skip: int, charset: str) -> DataFrame:
    return numbered_lines(spark, path, skip, charset)[0].select("linha", FILE)


def _parsed(lines: DataFrame, schema: T.StructType, sep: str) -> DataFrame:
    parsed = F.from_csv(
        F.col("linha"),
        F.lit(raw_schema(schema).simpleString()[len("struct<") : -1].replace(":", " ")),
        {"sep": sep, "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": RAW},
    )
    rows = lines.select(parsed.alias("r"), FILE).select(
        *[F.col(f"r.{f.name}").alias(f.name) for f in schema], F.col(f"r.{RAW}").alias(RAW), FILE
    )
    return checked(rows, schema, sep)


def read_month_rows(
    spark: SparkSession, path: str | list[str], skip: int = 4, sep: str = ";", charset: str = WINDOWS
) -> Load:
    """Reports of any windows of months: a line is its label, its months and their cells, and its total.

    The months come from the file's own header, joined to its lines by file. The plan is the same for
    one month or a hundred, and for one window or one per file.
    """
    lines, headers = lines_under_headers(spark, path, skip, sep, charset)
    has_total = (F.size(NAMES) > 1) & (F.get(NAMES, F.size(NAMES) - 1) == "total")
    count = F.greatest(F.size(NAMES) - 1 - has_total.cast("int"), F.lit(0))
    months = F.transform(F.slice(NAMES, 2, count), month_column)
    sound = (F.size(months) > 0) & F.forall(months, lambda m: m.isNotNull())
    demand(headers, sound & (F.size(F.array_distinct(months)) == F.size(months)), "not a label, different months and a total")
    lines = lines.withColumns(
        {
            "competencias": months,
            "celulas": F.slice(FIELDS, 2, count),
            "total": F.when(has_total, F.get(FIELDS, count + 1)),
        }
    )
    label_width, cell_width = MONTH_ROWS["estab_cidade"].metadata[WIDTH], MONTH_ROWS["celulas"].metadata[WIDTH]
    # A short line lacks its last cells.
    cells = F.transform("competencias", lambda _, k: F.get("celulas", k))
    rows = lines.select(
        F.get(FIELDS, F.lit(0)).alias("estab_cidade"), "competencias", cells.alias("celulas"), "total",
        F.col(LINE).alias(RAW), FILE, (F.size(FIELDS) > F.size(NAMES)).alias(SURPLUS),
    )
    wide = F.filter(F.arrays_zip("competencias", "celulas"), lambda c: F.length(c["celulas"]) > cell_width)
    reason = F.when(
        F.length("estab_cidade") > label_width, F.lit(f"estab_cidade: mais de {label_width} caracteres")
    ).when(
        F.size(wide) > 0,
        F.concat(F.lit("m_"), F.get(wide, F.lit(0))["competencias"], F.lit(f": mais de {cell_width} caracteres")),
    )
    return Load(rows.withColumn(REASON, reason), MONTH_ROWS)


def read_report(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    skip: int = 4,
    sep: str = ";",
    charset: str = WINDOWS,
) -> Load:
    """Rows of one or more reports, by a declared layout or else by the months each file names.

    Only the distinct header lines reach the driver, one for each window of months.
    """
    lines, headers = numbered_lines(spark, path, skip, charset)
    lines = lines.where(F.length(F.trim("linha")) > 0)
    if schema is not None:
        return Load(_parsed(lines, schema, sep), schema)
    texts = sorted(r.linha for r in headers.select("linha").distinct().collect())
    if not texts:
        raise UnknownLayout(f"no header line in {path}")
    layouts = [month_layout(t, sep) for t in texts]
    parts = []
    for text, layout in zip(texts, layouts):
        own = headers.where(F.col("linha") == text).select(PATH)
        parts.append(_parsed(lines if len(texts) == 1 else lines.join(own, PATH, "left_semi"), layout, sep))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    months = sorted({f.name[2:] for layout in layouts for f in layout if f.name.startswith("m_")})
    whole = month_report(months, any("total" in layout.names for layout in layouts))
    return Load(rows, whole)
