"""Tables and views: appends behind a reject limit, overwrites, layouts, late-binding views."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlens.operators.selection import first_rows
from wardlens.session import remove_path, shared_path
from wardlens.sources.delimited import FILE, Load, file_name

OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
# A task that writes by file keeps a writer open for each file its rows came from, instead of sorting its
# rows by file, and reads one staged part, which holds what one split of the text held. Its memory then
# does not grow with the load. Rows of more files than that are sorted.
BY_FILE = {"spark.sql.maxConcurrentOutputFileWriters": "64", "spark.sql.files.openCostInBytes": str(2**30)}


class RejectLimitExceeded(RuntimeError):
    """A load had more rejected rows than allowed; nothing was added to the table."""


def scratch_database(spark: SparkSession) -> str:
    """A database of its own in the shared folder."""
    name = f"wardlens_{uuid.uuid4().hex[:12]}"
    spark.sql(f"create database {name} location '{shared_path(spark, name)}'")
    return name


def _matched(df: DataFrame, table: str) -> DataFrame:
    """The columns of an existing table, which gains those it lacks; absent ones stay NULL."""
    spark = df.sparkSession
    present = {f.name for f in spark.table(table).schema}
    new = [f for f in df.schema if f.name not in present]
    if new:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"alter table {table} add columns ({columns})")
    return df.select(
        *[
            F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in spark.table(table).schema
        ]
    )


def append_load(
    load: Load, table: str, reject_limit: int = 100, replace: bool = False
) -> DataFrame:
    """Append the good rows of a load, or put them in place of the table's; returns its report.

    The checked rows are staged as Parquet first: the text is parsed once, the report reads
    three staged columns, and a lost executor costs staged blocks, not another parse. Over the
    reject limit the table is not touched. The report, one row per file, is kept in a table next
    to the loaded one, for failed loads too; "OK" is written once the rows are in the table. A
    table takes up months it has no column for yet.
    """
    spark = load.rows.sparkSession
    stage = shared_path(spark, "stage")
    run = stage.rsplit("-", 1)[-1]
    try:
        load.rows.write.parquet(stage)
        staged = Load(spark.read.schema(load.rows.schema).parquet(stage), load.schema)
        rejected = staged.rejected.count()
        failed = rejected > reject_limit
        if not failed:
            if spark.catalog.tableExists(table):
                _matched(staged.good, table).write.insertInto(table, overwrite=replace)
            else:
                staged.good.write.saveAsTable(table)
        record_rejects(staged, table, run)
        record_load(staged, table, run, failed)
    finally:
        remove_path(spark, stage)
    if failed:
        raise RejectLimitExceeded(f"{table}: {rejected} rows rejected, limit {reject_limit}")
    return spark.table(reports_table(table)).where(F.col("carga") == run)


def put_files(rows: DataFrame, table: str, whole: bool = False) -> None:
    """Write rows that carry their file's name into a table with a partition for each file.

    Rows of a file that is already there are replaced, those of other files stay, so that the same
    write may be repeated after a failure. With `whole` nothing else stays. Made for sources that
    deliver some files a month; a file is known by its name.
    """
    spark = rows.sparkSession
    exists = spark.catalog.tableExists(table)
    if exists and FILE not in spark.table(table).columns:
        raise ValueError(f"{table} does not keep its rows by file; load into a database of its own")
    settings = {**BY_FILE, OVERWRITE_MODE: "static" if whole else "dynamic"}
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        if exists:
            _matched(rows, table).write.insertInto(table, overwrite=True)
        else:
            rows.write.partitionBy(FILE).saveAsTable(table)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def files_in(spark: SparkSession, table: str) -> DataFrame:
    """Names (arquivo) of the files that a table holds, or that were loaded and had no good row."""
    if not spark.catalog.tableExists(table):
        return spark.createDataFrame([], "arquivo string")
    value = F.replace(F.split_part("partition", F.lit("="), F.lit(2)), F.lit("+"), F.lit("%2B"))
    names = spark.sql(f"show partitions {table}").select(F.url_decode(value).alias("arquivo"))
    if spark.catalog.tableExists(reports_table(table)):
        without = spark.table(reports_table(table)).where("situacao = 'OK' and lidas = rejeitadas")
        names = names.unionByName(without.select("arquivo"))
    return names.distinct()


def listing(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """arquivo, caminho and bytes of the files at a path, folder or wildcard; none is opened."""
    found = spark.read.format("binaryFile").load(path)
    return found.select(
        file_name().alias("arquivo"), F.col("path").alias("caminho"), F.col("length").alias("bytes")
    )


def load_files(
    spark: SparkSession,
    read: Callable[[list[str]], Load],
    path: str | list[str],
    table: str,
    reject_limit: int = 100,
    which: str = "new",
    sep: str = ";",
) -> DataFrame:
    """Load files into a table that knows which row came from which file; returns their load report.

    `which`: "new" passes over files whose rows the table has, and does not even read them; "files" puts
    every file in place of its own earlier rows; "table" puts the files in place of all rows. Over the
    reject limit the table is not touched. Rejected lines are kept in either case (`rejected_rows`).
    Only the paths of the files to read reach the driver.
    """
    files = listing(spark, path)
    if which == "new":
        files = files.join(files_in(spark, table), "arquivo", "left_anti")
    elif which not in ("files", "table"):
        raise ValueError(f"which is new, files or table, not {which}")
    found = sorted((r.arquivo, r.caminho) for r in files.collect())
    names = [n for n, _ in found]
    if len(set(names)) < len(names):
        raise ValueError("two files of one load have the same name")
    stage = shared_path(spark, "stage")
    run = stage.rsplit("-", 1)[-1]
    if not found:
        return empty_report(spark, table)
    load = read([p for _, p in found])
    try:
        load.rows.write.parquet(stage)
        staged = Load(spark.read.schema(load.rows.schema).parquet(stage), load.schema)
        rejected = staged.rejected.count()
        failed = rejected > reject_limit
        if not failed:
            put_files(staged.good_by_file, table, whole=which == "table")
        record_rejects(staged, table, run, sep)
        record_load(staged, table, run, failed, spark.createDataFrame([(n,) for n in names], "arquivo string"))
    finally:
        remove_path(spark, stage)
    if failed:
        raise RejectLimitExceeded(f"{table}: {rejected} rows rejected, limit {reject_limit}")
    return spark.table(reports_table(table)).where(F.col("carga") == run)


def empty_report(spark: SparkSession, table: str) -> DataFrame:
    if spark.catalog.tableExists(reports_table(table)):
        return spark.table(reports_table(table)).limit(0)
    return spark.createDataFrame([], "arquivo string, lidas bigint, rejeitadas bigint, com_excedente bigint, motivo string, situacao string, carga string, carregado_em timestamp")


def record_load(load: Load, table: str, run: str, failed: bool, files: DataFrame | None = None) -> None:
    """Keep a load's report, one row per file; with `files` also of those that have no row at all."""
    audit = load.audit
    if files is not None:
        audit = files.join(audit, "arquivo", "left").fillna(0, ["lidas", "rejeitadas", "com_excedente"])
    audit.withColumns(
        {
            "situacao": F.lit("FALHA" if failed else "OK"),
            "carga": F.lit(run),
            "carregado_em": F.current_timestamp(),
        }
    ).write.mode("append").saveAsTable(reports_table(table))


def rejects_table(table: str) -> str:
    return f"{table}_rejeitadas"


def record_rejects(load: Load, table: str, run: str, sep: str = ";") -> None:
    """Keep a load's rejected lines next to its table, a partition for each load, failed ones too.

    A load that is run again under its name replaces its lines.
    """
    lines = load.rejected_lines(sep).withColumns({"rejeitada_em": F.current_timestamp(), "carga": F.lit(run)})
    spark, kept = lines.sparkSession, rejects_table(table)
    if not spark.catalog.tableExists(kept):
        lines.write.partitionBy("carga").saveAsTable(kept)
        return
    before = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, "dynamic")
    try:
        lines.write.insertInto(kept, overwrite=True)
    finally:
        spark.conf.set(OVERWRITE_MODE, before)


def rejected_rows(spark: SparkSession, table: str, run: str | None = None) -> DataFrame:
    """arquivo, linha, motivo, rejeitada_em and carga of a table's rejected lines, of one load or all."""
    kept = spark.table(rejects_table(table))
    return kept if run is None else kept.where(F.col("carga") == run)


def loaded(spark: SparkSession, table: str, run: str) -> bool:
    """Whether a load is recorded as done."""
    reports = reports_table(table)
    if not spark.catalog.tableExists(reports):
        return False
    return not spark.table(reports).where((F.col("carga") == run) & (F.col("situacao") == "OK")).isEmpty()


def reports_table(table: str) -> str:
    return f"{table}_cargas"


def recent_loads(spark: SparkSession, table: str, n: int = 5) -> DataFrame:
    """The newest rows of a table's load report."""
    order = F.desc("carregado_em"), "arquivo", "carga"
    return first_rows(spark.table(reports_table(table)), n, *order)


def reload(load: Load, table: str, reject_limit: int = 100) -> DataFrame:
    """Put a load in place of the table's rows; over the reject limit the old rows stay."""
    return append_load(load, table, reject_limit, replace=True)


def _replace(writer: DataFrameWriter, spark: SparkSession, table: str, schema: T.StructType | None = None) -> None:
    """Write a table beside the one it replaces, then put it in its place; `schema` declares more columns than are written.

    The old rows stay until all new ones are written: a failed write leaves them as they were, and the
    plan may read the table it replaces. The swap itself only changes the catalog. Each version has a
    folder of its own in the database's; the one before is removed.
    """
    database, _, name = table.rpartition(".")
    version = uuid.uuid4().hex[:8]
    new = f"{table}_{version}"
    place = f"{spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri}/{name}-{version}"
    try:
        writer.option("path", place).saveAsTable(new)
        if schema is not None:
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            spark.sql(f"drop table {new}")  # its files stay
            spark.sql(f"create table {new} ({columns}) using parquet location '{place}'")
    except BaseException:
        spark.sql(f"drop table if exists {new}")
        remove_path(spark, place)
        raise
    parts = spark.sql(f"show create table {new}").first()[0].split("\n", 1)
    old = None
    if spark.catalog.tableExists(table):
        details = spark.sql(f"describe table extended {table}").where("col_name in ('Location', 'Type')")
        kind = {r.col_name: r.data_type for r in details.collect()}
        old = kind.get("Location") if kind.get("Type") == "EXTERNAL" else None
        spark.sql(f"drop table {table}")
    spark.sql(f"create table {table} (\n{parts[1]}")
    if any(c.isPartition for c in spark.catalog.listColumns(table)):
        spark.sql(f"msck repair table {table}")
    spark.sql(f"drop table {new}")  # the files are the table's now
    if old:
        remove_path(spark, old)


def materialize(df: DataFrame, table: str, schema: T.StructType | None = None) -> None:
    """Replace a table by the result of a plan.

    With `schema` the table has these columns, in their order. Those that the plan lacks are declared and
    read as NULL, as where a table has gained columns, instead of a NULL being written for every row.
    """
    if schema is not None:
        unknown = set(df.columns) - set(schema.fieldNames())
        if unknown:
            raise ValueError(f"{table} has no column {', '.join(sorted(unknown))}")
        df = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema if f.name in df.columns])
    _replace(df.write if schema is None else df.write.format("parquet"), df.sparkSession, table, schema)


def materialize_by_hospital(
    df: DataFrame, table: str, key: str, period: str = "competencia", buckets: int | None = None
) -> None:
    """Replace a hospital-month table, bucketed by hospital and sorted by month in a bucket.

    Joins, windows and aggregates keyed by hospital then read it without an exchange, and a
    month filter skips row groups. For tables with few rows per hospital and month. Buckets
    default to the session's shuffle partitions; size them to the table (some 100 MB each).
    """
    n = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    writer = df.repartition(n, key).write.bucketBy(n, key).sortBy(period, key)
    _replace(writer, df.sparkSession, table)


def materialize_by_month(
    df: DataFrame,
    table: str,
    key: str,
    *more: str,
    period: str = "competencia",
    partitions: int | None = None,
    finish: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Replace a table, partitioned by month and range-clustered by hospital inside it.

    Ranges over (month, hospital, more) keep files few and balanced, and split a hot hospital
    over several of them; min/max statistics serve hospital filters. Ranges default to the
    session's shuffle partitions.

    Spark makes all rows once to sample the ranges and once more to deal them out. What `finish` makes of
    the rows, row by row and without touching these keys, is made only once, after both.
    """
    count = [] if partitions is None else [partitions]
    ranged = df.repartitionByRange(*count, period, key, *more)
    ranged = ranged.sortWithinPartitions(period, key, *more)
    if finish is not None:
        ranged = finish(ranged)
    _replace(ranged.write.partitionBy(period), df.sparkSession, table)


def define_view(spark: SparkSession, view: str, sql: str, comments: dict[str, str] | None = None) -> None:
    """Create or replace a catalog view. It is stored as text and always reads current tables.

    `comments` are kept with the columns of these names, where the catalog's readers find them.
    """

    def column(name: str) -> str:
        quoted = "`" + name.replace("`", "``") + "`"
        if name not in (comments or {}):
            return quoted
        text = comments[name].replace("\\", "\\\\").replace("'", "\\'")
        return f"{quoted} comment '{text}'"

    columns = ", ".join(map(column, spark.sql(sql).columns)) if comments else ""
    spark.sql(f"create or replace view {view} {f'({columns}) ' if columns else ''}as {sql}")
