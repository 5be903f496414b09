"""Ingest, table and pipeline queries.

Each writes files of a declared layout from the whole mapped tables into the shared folder and
loads them back, so its work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlens.catalog.inputs import Inputs, Query, over
from wardlens.operators.selection import at_latest
from wardlens.plans import gold, pipeline, questions, reports, silver
from wardlens.session import shared_path
from wardlens.sources import driver_tables, tables
from wardlens.sources.delimited import Load, read_delimited
from wardlens.sources.bronze import SOURCES
from wardlens.sources.bronze import load as load_bronze
from wardlens.sources.report import MONTH_NAMES, read_month_rows, read_report
from wardlens.sources.schemas import ADMISSIONS, BEDS, DISEASE_CODES
from wardlens.sources.transcode import transcode_files
from wardlens.streaming.ingest import ingest_table

PREAMBLE = ["Internacoes hospitalares", "Dias de permanencia", "Periodo"]
# Above the bad rows of the dirty registry at every scale factor in use.
DIRTY_LIMIT = 100_000_000


def _full_layout(df: DataFrame, schema: T.StructType) -> DataFrame:
    """All columns of a layout in file order; those the mapping does not fill are empty."""
    present = set(df.columns)
    return df.select(
        *[
            F.col(f.name) if f.name in present else F.lit(None).cast("string").alias(f.name)
            for f in schema
        ]
    )


def _beds_files(i: Inputs, df: DataFrame | None = None) -> str:
    path = shared_path(i.spark, "leitos")
    rows = _full_layout(i.beds_raw, BEDS) if df is None else df
    rows.write.csv(path, sep=";", header=True, encoding="ISO-8859-1", escape='"')
    return path


def _admission_files(i: Inputs) -> str:
    path = shared_path(i.spark, "rd")
    _full_layout(i.admissions_raw, ADMISSIONS).write.csv(path, header=True, escape='"')
    return path


def _beds_load(i: Inputs) -> Load:
    return read_delimited(i.spark, _beds_files(i), BEDS)


def _report_files(i: Inputs, wide: DataFrame) -> str:
    """Report files whose last preamble line names their months."""
    path = shared_path(i.spark, "tabnet")
    cells = [F.coalesce(F.col(c), F.lit("")) for c in wide.columns]
    line = F.concat_ws(";", *cells)
    names = [f"{c[2:6]}/{MONTH_NAMES[int(c[6:]) - 1].title()}" for c in wide.columns if c.startswith("m_")]
    header = ";".join(["Estab", *names, "Total"])
    # Ids restart in every partition, and a partition becomes a file.
    starts_file = F.monotonically_increasing_id() % 2**33 == 0
    preamble = F.array(*[F.lit(p) for p in [*PREAMBLE, header]], line)
    wide.select(
        F.explode(F.when(starts_file, preamble).otherwise(F.array(line)))
    ).write.text(path)
    return path


def _report_months(i: Inputs) -> DataFrame:
    """Two reports whose windows overlap; in the older one the shared months are not final yet."""
    wide = i.stays_wide
    months = [c for c in wide.columns if c.startswith("m_")]
    early, late = months[:60], months[36:]
    draft = [F.concat(c, F.lit("9")).alias(c) if c in late else F.col(c) for c in early]
    paths = [
        _report_files(i, part)
        for part in (wide.select("estab_cidade", *draft, "total"), wide.select("estab_cidade", *late, "total"))
    ]
    return silver.patient_days(read_month_rows(i.spark, paths).good_by_file)


def _report(i: Inputs) -> DataFrame:
    return silver.patient_days(read_report(i.spark, _report_files(i, i.stays_wide)).good)


def _glob(i: Inputs) -> DataFrame:
    load = read_delimited(
        i.spark, f"{_admission_files(i)}/*.csv", ADMISSIONS, sep=",", charset="UTF-8"
    )
    return reports.bronze_volume(load.good)


def _mapped_names(i: Inputs) -> DataFrame:
    """A registry whose columns stand in another order, matched by the header of each file."""
    full = _full_layout(i.beds_raw, BEDS)
    turned = full.select(*reversed(full.columns))
    load = read_delimited(i.spark, _beds_files(i, turned), BEDS, names="map")
    return silver.beds(load.good)


def _short_rows(i: Inputs) -> DataFrame:
    """Files that end after the adult intensive-care columns."""
    kept = [f.name for f in BEDS][: BEDS.fieldNames().index("uti_adulto_sus") + 1]
    load = read_delimited(i.spark, _beds_files(i, _full_layout(i.beds_raw, BEDS).select(kept)), BEDS)
    return load.good.groupBy("comp").agg(
        F.count("*").alias("linhas"),
        F.sum("uti_adulto_sus").alias("uti_adulto_sus"),
        F.count("uti_neonatal_sus").alias("com_neonatal"),
    )


def _dirty_beds(i: Inputs) -> Load:
    """A registry with a non-numeric count and an over-wide text in some of its months."""
    full = _full_layout(i.beds_raw, BEDS)
    even = F.substring("comp", 6, 1).isin("2", "4")
    dirty = full.withColumns(
        {
            "leitos_sus": F.when(even & (F.col("leitos_sus") == 5), "n/d").otherwise(
                F.col("leitos_sus").cast("string")
            ),
            "uf": F.when(F.col("leitos_sus") == 6, "S.P.").otherwise("SP"),
        }
    )
    return read_delimited(i.spark, _beds_files(i, dirty), BEDS)


def _rejects(i: Inputs) -> DataFrame:
    return _dirty_beds(i).rejected.groupBy(F.col("_motivo").alias("motivo")).agg(
        F.count("*").alias("linhas")
    )


def _fractional(i: Inputs) -> DataFrame:
    """Counts with a fraction, and beyond 32 bits, are numbers like others."""
    beds = F.col("leitos_sus")
    odd = F.when(beds == 4, "4.5").when(beds == 3, "3000000000").otherwise(beds.cast("string"))
    files = _beds_files(i, _full_layout(i.beds_raw, BEDS).withColumn("leitos_sus", odd))
    table = f"{tables.scratch_database(i.spark)}.brz_cnes_leitos_raw"
    tables.append_load(read_delimited(i.spark, files, BEDS), table, reject_limit=0)
    loaded = silver.beds(i.spark.table(table))
    return silver.occupancy(i.stays, loaded).select("co_cnes", "competencia", "leito_dia", "taxa_ocupacao")


def _load_report(i: Inputs) -> DataFrame:
    table = f"{tables.scratch_database(i.spark)}.brz_cnes_leitos_raw"
    load = _dirty_beds(i)
    report = tables.append_load(load, table, DIRTY_LIMIT)
    return report.agg(
        F.sum("lidas").alias("lidas"),
        F.sum("rejeitadas").alias("rejeitadas"),
        F.sum("com_excedente").alias("com_excedente"),
    ).withColumn("na_tabela", i.spark.table(table).agg(F.count("*")).scalar())


def _rejected_rows(i: Inputs) -> DataFrame:
    """The lines a load has turned down, taken apart again from the table that keeps them."""
    table = f"{tables.scratch_database(i.spark)}.brz_cnes_leitos_raw"
    try:
        tables.append_load(_dirty_beds(i), table, reject_limit=0)
    except tables.RejectLimitExceeded:
        field = F.split("linha", ";")
        return tables.rejected_rows(i.spark, table).select(
            field[0].alias("comp"), field[6].alias("cnes"), field[22].alias("leitos_sus"), "motivo"
        )
    raise AssertionError("the dirty registry has rejects")


def _load_once(i: Inputs) -> DataFrame:
    """The same files loaded twice: the second load finds nothing new."""
    database, path = tables.scratch_database(i.spark), f"{_admission_files(i)}/*.csv"
    for _ in range(2):
        load_bronze(i.spark, database, "admissions", path)
    return reports.bronze_volume(i.spark.table(f"{database}.{SOURCES['admissions'].table}"))


def _replace_file(i: Inputs) -> DataFrame:
    """Files of two spans, one of them a draft at first; loading its final version leaves the other alone."""
    database, late = tables.scratch_database(i.spark), F.col("comp") >= "199901"
    full = _full_layout(i.beds_raw, BEDS).repartition(1)
    early = _beds_files(i, full.where(~late))
    draft = _beds_files(i, full.where(late).withColumn("leitos_sus", F.col("leitos_sus") + 100))
    final = _beds_files(i, full.where(late))
    # A file is known by its name: the final one takes the draft's.
    names = [sorted(tables.listing(i.spark, f"{p}/*.csv").select("arquivo", "caminho").collect()) for p in (draft, final)]
    for old, new in zip(*names):
        _rename(i, new.caminho, new.caminho.rsplit("/", 1)[0] + "/" + old.arquivo)
    for path in (early, draft):
        load_bronze(i.spark, database, "beds", f"{path}/*.csv")
    load_bronze(i.spark, database, "beds", f"{final}/*.csv", again=True)
    return silver.beds(i.spark.table(f"{database}.{SOURCES['beds'].table}"))


def _rename(i: Inputs, path: str, to: str) -> None:
    jvm = i.spark.sparkContext._jvm
    old, new = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, to))
    if not old.getFileSystem(i.spark.sparkContext._jsc.hadoopConfiguration()).rename(old, new):
        raise OSError(f"{path} was not renamed")


def _append(i: Inputs) -> DataFrame:
    """Two files into one table: the later years first, then the earlier ones."""
    table = f"{tables.scratch_database(i.spark)}.brz_cnes_leitos_raw"
    full = _full_layout(i.beds_raw, BEDS)
    late = F.col("comp") >= "199901"
    for part in (full.where(late), full.where(~late)):
        tables.append_load(read_delimited(i.spark, _beds_files(i, part), BEDS), table)
    return silver.beds(i.spark.table(table))


def _reload(i: Inputs) -> DataFrame:
    """Loading again after emptying the table leaves one copy."""
    table = f"{tables.scratch_database(i.spark)}.brz_cnes_leitos_raw"
    load = _beds_load(i)
    tables.append_load(load, table)
    tables.reload(load, table)
    return silver.beds(i.spark.table(table))


def _reload_over_limit(i: Inputs) -> DataFrame:
    """A reload with too many rejects leaves what was there."""
    table = f"{tables.scratch_database(i.spark)}.brz_cnes_leitos_raw"
    tables.append_load(_beds_load(i), table)
    try:
        tables.reload(_dirty_beds(i), table, reject_limit=0)
    except tables.RejectLimitExceeded:
        return silver.beds(i.spark.table(table))
    raise AssertionError("the dirty registry has rejects")


def _overwrite(i: Inputs) -> DataFrame:
    table = f"{tables.scratch_database(i.spark)}.slv_cnes_leitos"
    tables.materialize(i.beds_raw, table)
    tables.materialize(i.beds, table)
    return i.spark.table(table)


def _late_binding(i: Inputs) -> DataFrame:
    """A view defined over an earlier version of its table shows the current one."""
    database = tables.scratch_database(i.spark)
    table, view = f"{database}.slv_ocupacao", f"{database}.gld_ocupacao_mensal"
    tables.materialize(i.occupancy.where(F.col("competencia") < "199901"), table)
    tables.define_view(i.spark, view, gold.MONTHLY.format(ocupacao=table))
    tables.materialize(i.occupancy, table)
    return i.spark.table(view)


def _month_layout(i: Inputs) -> DataFrame:
    table = f"{tables.scratch_database(i.spark)}.slv_internacao"
    tables.materialize_by_month(i.admissions, table, "co_cnes", "n_aih")
    return at_latest(i.spark.table(table)).select(i.admissions.columns)


def _hospital_layout(i: Inputs) -> DataFrame:
    database = tables.scratch_database(i.spark)
    stays, beds = f"{database}.slv_sih_diasperm", f"{database}.slv_cnes_leitos"
    tables.materialize_by_hospital(i.stays, stays, "co_cnes")
    tables.materialize_by_hospital(i.beds, beds, "cnes")
    return gold.trend(silver.occupancy(i.spark.table(stays), i.spark.table(beds))).select(
        "co_cnes", "nome_estabelecimento", "competencia", "taxa_ocupacao", "media_movel_3m"
    )


def _monthly_on_tables(i: Inputs) -> DataFrame:
    table = f"{tables.scratch_database(i.spark)}.slv_ocupacao"
    tables.materialize_by_hospital(i.occupancy, table, "co_cnes")
    return gold.monthly_occupancy(i.spark.table(table), store_ranks=True)


def _transcode(i: Inputs) -> DataFrame:
    """One file cannot be read; it is reported and the others are written."""
    target, folder = shared_path(i.spark, "utf8"), _beds_files(i)
    broken = shared_path(i.spark, "ruim")
    i.spark.range(1).selectExpr("'not compressed' AS value").coalesce(1).write.text(broken)
    for file in tables.listing(i.spark, f"{broken}/*.txt").collect():
        _rename(i, file.caminho, f"{folder}/{file.arquivo}.csv.gz")
    status = transcode_files(i.spark, [folder], target, pattern="*.csv*")
    failed = status.where("situacao <> 'OK'").agg(F.count("*")).scalar()
    load = read_delimited(i.spark, f"{target}/000/*", BEDS, sep=",", charset="UTF-8")
    return (
        load.good.groupBy("comp")
        .agg(F.count("*").alias("linhas"), F.sum("leitos_sus").alias("leitos_sus"))
        .withColumn("arquivos_com_erro", failed)
    )


def _stream(i: Inputs) -> DataFrame:
    """Two drops of files and a run with nothing new, into the bronze table."""
    folder, checkpoint = (shared_path(i.spark, n) for n in ("chegada", "controle"))
    database = tables.scratch_database(i.spark)
    rows = _full_layout(i.admissions_raw, ADMISSIONS)
    late = F.col("ano_cmpt") >= "1999"
    table = None
    for part in (rows.where(late), rows.where(~late), None):
        if part is not None:
            part.write.mode("append").csv(folder, header=True, escape='"')
        table = ingest_table(i.spark, folder, database, checkpoint)
    return reports.bronze_volume(i.spark.table(table))


def _stream_with_bad_files(i: Inputs) -> DataFrame:
    """Three drops of files, the second with nothing but over-wide keys: it is put aside, the rest counts."""
    folder, checkpoint = (shared_path(i.spark, n) for n in ("chegada", "controle"))
    database = tables.scratch_database(i.spark)
    rows = _full_layout(i.admissions_raw, ADMISSIONS)
    late = F.col("ano_cmpt") >= "1999"
    bad = rows.where("ano_cmpt = '1997'").withColumn("cnes", F.lpad("cnes", 16, "0"))
    table = None
    for part in (rows.where(late), bad, rows.where(~late)):
        part.write.mode("append").csv(folder, header=True, escape='"')
        table = ingest_table(i.spark, folder, database, checkpoint, reject_limit=0, quarantine=True)
    admissions = silver.admissions(i.spark.table(table))
    return gold.hospital_features(i.occupancy, admissions, i.beds)


def _built(i: Inputs) -> str:
    """The pipeline over bronze tables made of the mapped inputs."""
    database = tables.scratch_database(i.spark)
    bronze = {
        "admissions": (i.admissions_raw, ADMISSIONS),
        "beds": (i.beds_raw, BEDS),
        "stays": (i.stays_wide, None),
        "codes": (driver_tables.disease_codes_raw(i.spark, i.sf_dir), DISEASE_CODES),
        "chapters": (driver_tables.disease_chapters_raw(i.spark), None),
    }
    for name, (df, layout) in bronze.items():
        # The tables have all columns of their layouts.
        schema = layout and _full_layout(df, layout).schema
        tables.materialize(df, f"{database}.{pipeline.BRONZE[name]}", schema)
    pipeline.build(i.spark, database)
    return database


def _view_prompts(i: Inputs) -> DataFrame:
    """Questions over every gold view of a finished build, as the catalog describes them."""
    asked = i.conversations.where(F.col("role") == "user").select("conv_id", "turn", "text")
    told = questions.describe_views(i.spark, _built(i))
    return questions.with_prompts(asked, "text", told).select("conv_id", "turn", "prompt")


BRONZE: dict[str, Query] = {
    "s1_read_delimited": over(lambda i: silver.beds(_beds_load(i).good)),
    "s1_header_map": over(_mapped_names),
    "s2_read_report": over(_report),
    "s2_report_months": over(_report_months),
    "s3_read_glob": over(_glob),
    "s3_load_once": over(_load_once),
    "s4_pad_short_rows": over(_short_rows),
    "s5_rejects": over(_rejects),
    "s6_load_report": over(_load_report),
    "s8_fractional_counts": over(_fractional),
    "s6_rejected_rows": over(_rejected_rows),
    "s7_append_load": over(_append),
    "s7_reload": over(_reload),
    "s7_replace_file": over(_replace_file),
    "s7_reload_over_limit": over(_reload_over_limit),
    "s9_materialize": over(_overwrite),
    "s10_view_late_binding": over(_late_binding),
    "s12_transcode_files": over(_transcode),
    "s13_month_layout": over(_month_layout),
    "s13_hospital_layout": over(_hospital_layout),
    "s13_monthly_on_tables": over(_monthly_on_tables),
    "g1_incremental_ingest": over(_stream),
    "g1_quarantine": over(_stream_with_bad_files),
    "pipeline_features_view": over(
        lambda i: i.spark.table(f"{_built(i)}.gld_features_hospital")
    ),
    "pipeline_view_prompts": over(_view_prompts),
    "pipeline_clinical_profile": over(
        lambda i: i.spark.table(f"{_built(i)}.gld_perfil_clinico")
    ),
}
