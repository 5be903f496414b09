"""The loading layer: headers, lineage, rejected lines, files loaded once, files put aside."""

import csv
import io

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import rows
from tests.test_ingest import beds_line, report_file, write
from wardlens.functions.decode import ATTENTION, CRITICAL
from wardlens.plans import gold, questions, silver
from wardlens.sources import bronze, driver_tables, schemas, tables
from wardlens.sources.delimited import FILE, REASON, SURPLUS, Load, read_delimited, reject_reason
from wardlens.sources.lines import FIELDS, NAMES, UnknownLayout, lines_under_headers, split_fields
from wardlens.sources.report import MONTH_NAMES, month_column, month_of, read_month_rows
from wardlens.sources.schemas import ADMISSIONS, BEDS, DISEASE_CHAPTERS
from wardlens.sources.transcode import transcode_files
from wardlens.streaming.ingest import ingest_table, quarantine_table

HEADER = ";".join(BEDS.fieldNames())


@settings(max_examples=20, deadline=None)
@given(st.lists(st.lists(st.text('a;"é ,x', max_size=6), min_size=1, max_size=6), min_size=1, max_size=20))
def test_fields_as_the_csv_module_reads_them(spark, lines):
    text = []
    for fields in lines:
        out = io.StringIO()
        csv.writer(out, delimiter=";", lineterminator="").writerow(fields)
        text.append((out.getvalue(), [f or None for f in fields]))
    df = spark.createDataFrame(text, "l string, f array<string>").select(split_fields(F.col("l"), ";").alias("g"), "f")
    assert [r.g for r in df.collect()] == [r.f for r in df.collect()]


def test_a_long_quoted_field_is_read_without_recursion(spark):
    line = 'a;"' + 'x""' * 200_000 + '";b'
    got = spark.createDataFrame([(line,)], "l string").select(split_fields(F.col("l"), ";").alias("g")).first().g
    assert got[0] == "a" and got[2] == "b" and got[1] == 'x"' * 200_000


@pytest.mark.parametrize("size", ["400", "100000"])
def test_each_line_stands_under_its_own_header(spark, tmp_path, size):
    for n in range(7):
        write(tmp_path / f"f{n}.csv", ["p", "p", f"A{n};\xc1;", *(f"{n};{k}" for k in range(20 * n))])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        lines, headers = lines_under_headers(spark, str(tmp_path), 3, ";")
        got = sorted((r[FILE], r[NAMES], r[FIELDS]) for r in lines.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == sorted((f"f{n}.csv", [f"a{n}", "á"], [str(n), str(k)]) for n in range(7) for k in range(20 * n))
    assert headers.count() == 7


def test_month_names_as_columns(spark):
    names = ["2024/out", "out/2024", "2025-01", "202512", "12/2024", "total", "2024/13", "jan", "", "2024/xyz", "outubro/2024", "00/2024"]
    df = spark.createDataFrame([(n,) for n in names], "n string").select("n", month_column(F.col("n")).alias("m"))
    assert {r.n: r.m for r in df.collect()} == {n: month_of(n) for n in names}


def months(first, n):
    return [f"{2024 + m // 12}/{MONTH_NAMES[m % 12].title()}" for m in range(first, first + n)]


def test_reports_of_any_window_and_their_overlap(spark, tmp_path):
    report_file(tmp_path / "a.csv", months(0, 3), ["0000001 A;1;2;3;6", "0000002 B;4;-;5;9", "Total;5;2;8;15"])
    report_file(tmp_path / "b.csv", months(1, 3), ["0000001 A;20;;40;60", "0000003 C;7"], total=False)
    load = read_month_rows(spark, str(tmp_path / "*.csv"))
    got = {(r.estab_cidade, r[FILE]): (r.competencias, r.celulas, r.total) for r in load.good_by_file.collect()}
    assert got["0000002 B", "a.csv"] == (["202401", "202402", "202403"], ["4", "-", "5"], "9")
    assert got["0000003 C", "b.csv"] == (["202402", "202403", "202404"], ["7", None, None], None)
    assert {r.estab_cidade for r in load.rows.where(SURPLUS).collect()} == {"0000001 A"}  # one cell too many in b
    days = sorted((r.co_cnes, r.no_estabelecimento, r.competencia, int(r.dias_perm)) for r in silver.patient_days(load.good_by_file).collect())
    assert days == [
        ("0000001", "A", "202401", 1), ("0000001", "A", "202402", 20), ("0000001", "A", "202404", 40),
        ("0000002", "B", "202401", 4), ("0000002", "B", "202403", 5), ("0000003", "C", "202402", 7),
    ]


def test_over_wide_cells_and_labels_of_a_report_are_rejected(spark, tmp_path):
    path = report_file(tmp_path / "a.csv", months(0, 2), ["0000001 A;1;2;3", f"0000002 B;1;{'9' * 21};3", f"{'x' * 301};1;2;3"])
    load = read_month_rows(spark, path)
    assert load.good.count() == 1
    assert sorted(r.motivo for r in load.rejected_lines().collect()) == ["estab_cidade: mais de 300 caracteres", "m_202402: mais de 20 caracteres"]
    assert f"0000002 B;1;{'9' * 21};3" in {r.linha for r in load.rejected_lines().collect()}


@pytest.mark.parametrize("names", [["Jan", "Fev"], ["2024/Out", "2024/Out"], [], ["2024/Out", "leitos"]])
def test_a_wrong_report_header_fails_whatever_the_other_files_say(spark, tmp_path, names):
    report_file(tmp_path / "a.csv", months(0, 3), ["0000001 A;1;2;3;6"])
    report_file(tmp_path / "b.csv", names, ["0000001 A;1;2;3"])
    with pytest.raises(UnknownLayout, match="b.csv"):
        read_month_rows(spark, str(tmp_path / "*.csv"))


def test_a_report_without_a_header_fails(spark, tmp_path):
    write(tmp_path / "a.csv", ["t", "s"])
    with pytest.raises(UnknownLayout, match="no header"):
        read_month_rows(spark, str(tmp_path))


def test_the_plan_does_not_grow_with_the_months_or_windows(spark, tmp_path):
    def plan(*windows):
        folder = tmp_path / str(len(list(tmp_path.iterdir())))
        folder.mkdir()
        for k, w in enumerate(windows):
            report_file(folder / f"{k}.csv", w, ["0000001 A;" + ";".join("1" for _ in w)])
        days = silver.patient_days(read_month_rows(spark, str(folder)).good_by_file)
        return days._jdf.queryExecution().optimizedPlan().toString().count("\n")

    assert plan(months(0, 2)) == plan(months(0, 100)) == plan(*(months(k, 20) for k in range(12)))


def test_stay_reports_load_into_one_table_whatever_their_windows(spark, tmp_path):
    db = tables.scratch_database(spark)
    a = report_file(tmp_path / "a.csv", months(0, 3), ["0000001 A;1;2;3;6"])
    b = report_file(tmp_path / "b.csv", months(2, 30), ["0000001 A;" + ";".join(map(str, range(30))) + ";99"])
    for path in (a, b, a):
        bronze.load(spark, db, "stays", path)
    table = spark.table(f"{db}.brz_sih_tabnet_raw")
    assert table.count() == 2
    got = {r.competencia: int(r.dias_perm) for r in silver.patient_days(table).collect()}
    assert got["202401"] == 1 and got["202403"] == 0 and got["202608"] == 29 and len(got) == 32


def test_swapped_columns_fail_the_check_and_are_mapped_by_name(spark, tmp_path):
    names = BEDS.fieldNames()
    turned = names[::-1]
    line = dict(zip(names, beds_line().split(";")))
    write(tmp_path / "a.csv", [";".join(names).upper(), beds_line()])
    bad = write(tmp_path / "b.csv", [";".join(turned), ";".join(line[n] for n in turned)])
    assert read_delimited(spark, str(tmp_path / "a.csv"), BEDS, names="check").good.count() == 1
    with pytest.raises(Exception, match="(?i)header"):
        read_delimited(spark, bad, BEDS, names="check").good.collect()
    got = read_delimited(spark, str(tmp_path), BEDS, names="map").good.distinct().collect()
    assert len(got) == 1 and got[0].cnes == "1234567" and got[0].leitos_existentes == 10


def test_mapped_files_may_lack_columns_and_have_others(spark, tmp_path):
    write(tmp_path / "a.csv", ["cnes;outra;leitos_sus", "1;x;5.25", '"2";y;n/d', "3", "4;;6;7"])
    load = read_delimited(spark, str(tmp_path), BEDS, names="map")
    got = {r.cnes: (r.leitos_sus, r.uf) for r in load.good.collect()}
    assert got == {"1": (5.25, None), "3": (None, None), "4": (6, None)}
    assert [(r.linha, r.motivo) for r in load.rejected_lines().collect()] == [('"2";y;n/d', "leitos_sus: nao numerico")]
    assert load.audit.first().com_excedente == 4  # a column of its own is a surplus
    write(tmp_path / "b.csv", ["x;y", "1;2"])
    with pytest.raises(UnknownLayout, match="b.csv"):
        read_delimited(spark, str(tmp_path), BEDS, names="map")


def test_names_must_be_a_known_mode(spark, tmp_path):
    with pytest.raises(ValueError):
        read_delimited(spark, str(tmp_path), BEDS, names="guess")


def test_rejected_lines_are_kept_for_good_and_failed_loads(spark, tmp_path):
    table = f"{tables.scratch_database(spark)}.beds"
    path = write(tmp_path / "beds.csv", [HEADER, beds_line(), beds_line(cnes="2", beds="n/d"), beds_line(cnes="3", uf="S.P.") + ";mais"])
    load = read_delimited(spark, path, BEDS)
    with pytest.raises(tables.RejectLimitExceeded):
        tables.append_load(load, table, reject_limit=1)
    tables.append_load(load, table, reject_limit=2)
    kept = tables.rejected_rows(spark, table)
    assert kept.select("carga").distinct().count() == 2 and kept.count() == 4
    run = tables.recent_loads(spark, table).first().carga
    got = {r.motivo: r.linha for r in tables.rejected_rows(spark, table, run).collect()}
    assert got["uf: mais de 2 caracteres"].endswith(";mais")  # the line as it was read
    assert got["leitos_existentes: nao numerico"].split(";")[6] == "2"
    assert [f for f in spark.table(tables.rejects_table(table)).columns] == ["arquivo", "linha", "motivo", "rejeitada_em", "carga"]


def test_a_load_recorded_twice_has_its_rejects_once(spark, tmp_path):
    table = f"{tables.scratch_database(spark)}.beds"
    load = read_delimited(spark, write(tmp_path / "b.csv", [HEADER, beds_line(uf="S.P.")]), BEDS)
    for _ in range(2):
        tables.record_rejects(load, table, "run")
    tables.record_rejects(load, table, "other")
    assert tables.rejected_rows(spark, table).count() == 2


def bed_file(folder, name, *keys, beds="10"):
    return write(folder / name, [HEADER, *(beds_line(cnes=k, beds=beds) for k in keys)])


def loaded(spark, db):
    return sorted((r[FILE], r.cnes, r.leitos_existentes) for r in spark.table(f"{db}.brz_cnes_leitos_raw").collect())


def test_a_file_is_loaded_once_and_replaced_on_demand(spark, tmp_path):
    db = tables.scratch_database(spark)
    bed_file(tmp_path, "jan 01+a.csv", "1", "2")
    bed_file(tmp_path, "fev.csv", "3")
    bed_file(tmp_path, "vazio.csv")
    both = [("fev.csv", "3", 10), ("jan 01+a.csv", "1", 10), ("jan 01+a.csv", "2", 10)]
    report = bronze.load(spark, db, "beds", str(tmp_path))
    assert sorted((r.arquivo, r.lidas) for r in report.collect()) == [("fev.csv", 1), ("jan 01+a.csv", 2), ("vazio.csv", 0)]
    assert bronze.load(spark, db, "beds", str(tmp_path)).count() == 0
    assert loaded(spark, db) == both
    bed_file(tmp_path, "fev.csv", "3", "4", beds="7")
    bed_file(tmp_path, "mar.csv", "5")
    report = bronze.load(spark, db, "beds", str(tmp_path / "*.csv"))  # the changed file is known by its name
    assert [r.arquivo for r in report.collect()] == ["mar.csv"]
    assert loaded(spark, db) == [*both, ("mar.csv", "5", 10)]
    bronze.load(spark, db, "beds", str(tmp_path / "fev.csv"), again=True)
    assert loaded(spark, db) == [("fev.csv", "3", 7), ("fev.csv", "4", 7), *both[1:], ("mar.csv", "5", 10)]
    bronze.load(spark, db, "beds", str(tmp_path / "fev.csv"), replace=True)
    assert loaded(spark, db) == [("fev.csv", "3", 7), ("fev.csv", "4", 7)]
    bronze.load(spark, db, "beds", str(tmp_path))  # what a reload has removed is new again
    assert len(loaded(spark, db)) == 5


def test_over_the_limit_a_replaced_file_keeps_its_rows(spark, tmp_path):
    db = tables.scratch_database(spark)
    path = bed_file(tmp_path, "jan.csv", "1")
    bronze.load(spark, db, "beds", path)
    bed_file(tmp_path, "jan.csv", "1", "2", beds="n/d")
    with pytest.raises(tables.RejectLimitExceeded):
        bronze.load(spark, db, "beds", path, again=True, reject_limit=1)
    assert loaded(spark, db) == [("jan.csv", "1", 10)]
    assert tables.rejected_rows(spark, f"{db}.brz_cnes_leitos_raw").count() == 2


def test_two_files_of_one_name_fail(spark, tmp_path):
    for folder in ("a", "b"):
        (tmp_path / folder).mkdir()
        bed_file(tmp_path / folder, "jan.csv", "1")
    with pytest.raises(ValueError, match="same name"):
        bronze.load(spark, tables.scratch_database(spark), "beds", f"{tmp_path}/*/jan.csv")


def test_a_table_without_files_is_not_mixed(spark, tmp_path):
    db = tables.scratch_database(spark)
    path = bed_file(tmp_path, "jan.csv", "1")
    tables.append_load(read_delimited(spark, path, BEDS), f"{db}.brz_cnes_leitos_raw")
    with pytest.raises(ValueError, match="by file"):
        bronze.load(spark, db, "beds", path, again=True)


def admission_file(folder, name, *lines):
    return write(folder / name, [",".join(ADMISSIONS.fieldNames()), *lines])


def test_a_bad_file_is_put_aside_and_the_others_go_on(spark, tmp_path):
    folder, db, checkpoint = tmp_path / "in", tables.scratch_database(spark), str(tmp_path / "c")
    folder.mkdir()
    table = f"{db}.brz_sih_rd_raw"

    def run():
        assert ingest_table(spark, str(folder), db, checkpoint, reject_limit=1, quarantine=True) == table
        return sorted(r.mes_cmpt for r in spark.table(table).collect())

    wide = "X" * 16
    admission_file(folder, "a.csv", "SP,2024,01", f"{wide},2024,01")  # one reject is within the limit
    admission_file(folder, "bad.csv", f"{wide},2024,02", f"{wide},2024,02", "SP,2024,02")
    admission_file(folder, "c.csv", "SP,2024,03")
    assert run() == ["01", "03"]
    admission_file(folder, "d.csv", "SP,2024,04")
    assert run() == run() == ["01", "03", "04"]
    aside = spark.table(quarantine_table(table)).collect()
    assert sorted((r.arquivo, r.motivo or "") for r in aside) == [
        ("bad.csv", ""), ("bad.csv", "uf_zi: mais de 15 caracteres"), ("bad.csv", "uf_zi: mais de 15 caracteres"),
    ]
    status = {r.arquivo: r.situacao for r in tables.recent_loads(spark, table, 10).collect()}
    assert status == {"a.csv": "OK", "bad.csv": "FALHA", "c.csv": "OK", "d.csv": "OK"}
    assert tables.rejected_rows(spark, table).count() == 3
    # A load shares the stream's table: it passes over what is there and takes what is not.
    admission_file(folder, "bad.csv", "SP,2024,02")
    bronze.load(spark, db, "admissions", str(folder))
    assert sorted(r.mes_cmpt for r in spark.table(table).collect()) == ["01", "02", "03", "04"]


def jobs_of(spark, step):
    context = spark.sparkContext
    group = f"jobs-{id(step)}"
    context.setJobGroup(group, "")
    try:
        out = step()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    return out, len(context.statusTracker().getJobIdsForGroup(group))


def test_transcoding_a_folder_does_not_take_a_job_per_file(spark, tmp_path):
    counts = []
    for n in (25, 75):
        folder = tmp_path / f"f{n}"
        folder.mkdir()
        for k in range(n):
            write(folder / f"{k}.csv", ["nome;n", f"S\xe3o {k};{k}", '"a;b";2'])
        status, jobs = jobs_of(spark, lambda: transcode_files(spark, [str(folder)], str(tmp_path / f"out{n}")))
        assert {(r.arquivo, r.linhas, r.situacao) for r in status.collect()} == {(f"{k}.csv", 2, "OK") for k in range(n)}
        counts.append(jobs)
    assert max(counts) <= 20
    back = spark.read.csv(f"{tmp_path}/out75/000/_arquivo=7.csv", header=True)
    assert sorted(rows(back)) == [("São 7", "7"), ("a;b", "2")]


def test_files_with_other_columns_are_told_apart(spark, tmp_path):
    folder = tmp_path / "f"
    folder.mkdir()
    for k in range(6):
        write(folder / f"{k}.csv", ["nome;n", f"x{k};{k}"] if k != 3 else ["m;nome;z", "1;2;3"])
    write(folder / "vazio.csv", ["nome;n"])
    status = transcode_files(spark, [str(folder)], str(tmp_path / "o"))
    assert {r.arquivo: (r.linhas, r.situacao) for r in status.collect()} == {
        **{f"{k}.csv": (1, "OK") for k in range(6)}, "vazio.csv": (0, "OK"),
    }
    assert spark.read.csv(f"{tmp_path}/o/000/_arquivo=3.csv", header=True).columns == ["m", "nome", "z"]
    assert spark.read.csv(f"{tmp_path}/o/000/_arquivo=5.csv", header=True).columns == ["nome", "n"]


def test_a_missing_name_is_a_name_of_its_own(spark):
    occupancy = spark.createDataFrame(
        [("1", None, "GERAL", "202401", 10, 100, "10.0"), ("1", "A", "GERAL", "202402", 20, 100, "20.0")],
        "co_cnes string, nome_estabelecimento string, ds_tipo_unidade string, competencia string, paciente_dia int, leito_dia long, taxa string",
    ).withColumn("taxa_ocupacao", F.col("taxa").cast("decimal(18,1)"))
    admissions = spark.createDataFrame(
        [], "co_cnes string, dias_perm int, diarias_uti int, carater_internacao string, complexidade string, fl_obito int, idade_anos decimal(5,2)"
    )
    beds = spark.createDataFrame([("1", 5, 1, "GERAL")], "cnes string, leitos_sus int, uti_total_sus int, ds_tipo_unidade string")
    got = gold.hospital_features(occupancy, admissions, beds).collect()
    assert sorted((r.nome_estabelecimento or "", str(r.taxa_media)) for r in got) == [("", "15.0"), ("A", "15.0")]
    assert gold.hospital_features(occupancy, admissions, beds, single_name=True).count() == 1


def test_the_prompt_tells_the_bands_in_use(spark):
    view = gold.with_meanings(spark.createDataFrame([], "semaforo string, outra int"))
    text = questions.describe("v", view.schema)
    assert f"above {CRITICAL} %" in text and f"from {ATTENTION} %" in text
    assert text.endswith("; outra int. ")


def test_views_keep_their_comments_in_the_catalog(spark):
    db = tables.scratch_database(spark)
    assert questions.describe_views(spark, db) == ""
    comments = {"co_cnes": "it's a \\ code; \"7\" digits", "missing": "x"}
    tables.define_view(spark, f"{db}.gld_ocupacao_mensal", "select 1 as co_cnes, 'a' as `od``d`", comments)
    kept = {c.name: c.description for c in spark.catalog.listColumns(f"{db}.gld_ocupacao_mensal")}
    assert kept == {"co_cnes": comments["co_cnes"], "od`d": None}
    told = questions.describe_views(spark, db)
    assert told == f"View gld_ocupacao_mensal: co_cnes int ({comments['co_cnes']}); od`d string. "
    tables.define_view(spark, f"{db}.gld_ocupacao_mensal", "select 2 as co_cnes")
    assert questions.describe_views(spark, db) == "View gld_ocupacao_mensal: co_cnes int. "


def test_every_column_of_the_gold_views_has_a_meaning(spark):
    assert set(gold.FEATURE_COLUMNS) <= set(gold.MEANINGS)
    assert {name for sql in gold.VIEWS.values() for name in gold.MEANINGS if name in sql} == set(gold.MEANINGS)


def test_chapter_files_load_by_position_under_any_header(spark, tmp_path):
    db = tables.scratch_database(spark)
    bronze.load(spark, db, "chapters", write(tmp_path / "c.csv", ["h", "I;A00;B99;Infecciosas;Inf"]))
    assert spark.table(f"{db}.brz_cid_capitulos_raw").columns == [*DISEASE_CHAPTERS.fieldNames(), FILE]


@pytest.mark.parametrize("write", [
    tables.materialize,
    lambda df, t: tables.materialize_by_month(df, t, "h", period="m"),
    lambda df, t: tables.materialize_by_hospital(df, t, "h", period="m", buckets=3),
])
def test_a_failed_build_keeps_the_table_and_a_plan_may_read_what_it_replaces(spark, write):
    db = tables.scratch_database(spark)
    table = f"{db}.t"
    first = spark.range(20).selectExpr("id AS h", "id % 3 AS m", "id AS v")
    write(first, table)
    before = sorted(rows(spark.table(table)))
    assert before == sorted(rows(first.select(*spark.table(table).columns)))
    with pytest.raises(Exception, match="(?i)divi"):
        write(first.withColumn("v", F.expr("1 div (v - 7)")), table)
    assert sorted(rows(spark.table(table))) == before
    assert [t.name for t in spark.catalog.listTables(db)] == ["t"]
    tables.define_view(spark, f"{db}.v", f"select sum(v) as s from {table}")
    write(spark.table(table).withColumn("v", F.col("v") + 1).where("h < 10"), table)
    assert sorted(r.v for r in spark.table(table).collect()) == list(range(1, 11))
    assert spark.table(f"{db}.v").first().s == 55
    write(spark.table(table).withColumn("novo", F.lit("x")), table)
    assert spark.table(table).where("m = 1").count() == 3 and "novo" in spark.table(table).columns
    folders = spark.sql(f"describe database {db}").where("info_name = 'Location'").first().info_value
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folders)
    left = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    assert len(left) == 1  # versions that were replaced, or not finished, are gone


def test_a_line_is_split_once_whatever_is_asked_of_its_fields(spark, tmp_path):
    write(tmp_path / "a.csv", ["CNES;COMP;LEITOS_SUS", '1;202401;"2"', "2;202401;x", "3;2024011;4"])
    load = read_delimited(spark, str(tmp_path), BEDS, names="map")
    plan = load.good._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1
    assert [(r.cnes, r.comp, int(r.leitos_sus)) for r in load.good.collect()] == [("1", "202401", 2)]
    assert load.rejected.count() == 2


def test_rows_are_written_by_file_without_sorting_them(spark, monkeypatch):
    """Writers of several files stay open in a task, which reads one staged part; more files are written too."""
    table, seen = f"{tables.scratch_database(spark)}.t", []
    matched = tables._matched

    def watched(*given):
        seen.append({key: int(spark.conf.get(key)) for key in watch})
        return matched(*given)

    watch = "spark.sql.maxConcurrentOutputFileWriters", "spark.sql.files.openCostInBytes"
    before = [spark.conf.get(key) for key in watch]
    monkeypatch.setattr(tables, "_matched", watched)
    for add in (0, 1000):
        tables.put_files(
            spark.range(2000).coalesce(1).select((F.col("id") + add).alias("n"), F.concat(F.lit("f"), F.col("id") % 100).alias(FILE)), table
        )
    assert all(0 < s[watch[0]] < 100 and s[watch[1]] >= 2**27 for s in seen) and len(seen) == 1
    assert [spark.conf.get(key) for key in watch] == before
    assert sorted(r.n for r in spark.table(table).collect()) == list(range(1000, 3000))



def test_the_load_report_counts_rows_without_sorting_them(spark):
    lines = [("a", "x" * 16, False), ("a", "x", True), ("a", None, False), ("b", "y", False), ("b", "é" * 15, False)]
    schema = T.StructType([schemas.text("chave", 15), schemas.text("nome", 30)])
    rows = spark.createDataFrame([(k, None, f, s) for f, k, s in lines], f"chave string, nome string, {FILE} string, {SURPLUS} boolean")
    load = Load(rows.withColumn(REASON, reject_reason(schema)), schema)
    plan = load.audit._jdf.queryExecution().executedPlan().toString()
    first = [line for line in plan.splitlines() if "Aggregate(" in line][-1]
    assert "HashAggregate" in first
    assert {tuple(r) for r in load.audit.collect()} == {("a", 3, 1, 1, "chave: mais de 15 caracteres"), ("b", 2, 0, 0, None)}


def test_the_first_broken_rule_is_named_and_bytes_are_not_characters(spark):
    schema = T.StructType([schemas.text("a", 2), schemas.text("b", 3), schemas.text("c", 2), schemas.count("n")])
    cases = [
        (("xx", "xxx", "xx", "1"), None),
        (("éé", "ééé", "éé", None), None),
        ((None, None, None, None), None),
        (("xx", "xxxx", "xxx", "z"), "b: mais de 3 caracteres"),
        (("xx", None, "ééé", "z"), "c: mais de 2 caracteres"),
        (("xx", None, "éé", "z"), "n: nao numerico"),
    ]
    found = spark.createDataFrame([c for c, _ in cases], "a string, b string, c string, n string").select(reject_reason(schema))
    assert [r[0] for r in found.collect()] == [reason for _, reason in cases]


def test_dates_of_the_mapped_admissions_need_no_formatter(spark):
    days = ["1995-01-02", "1999-12-31", "0999-05-06", "0001-01-01", "9999-12-31", None]
    dates = spark.createDataFrame([(d,) for d in days], "d string").select(F.col("d").cast("date").alias("d"))
    parts = driver_tables._parts(F.col("d"))
    patterns = ("yyyy", "MM", "yyyyMMdd")
    got = dates.select(*parts, *[F.date_format("d", p) for p in patterns]).collect()
    assert [tuple(r[:3]) for r in got] == [tuple(r[3:]) for r in got]
