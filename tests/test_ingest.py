"""Byte-exact files: preambles, legacy characters, short and long rows, rejects, reloads."""

import os
import time

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from wardlens.plans import pipeline
from wardlens.sources import bronze, tables
from wardlens.sources.delimited import FILE, REASON, SURPLUS, read_delimited
from wardlens.sources.report import MONTH_NAMES, UnknownLayout, lines_after, month_of, read_report
from wardlens.sources.schemas import (
    ADMISSIONS,
    BEDS,
    DISEASE_CHAPTERS,
    DISEASE_CODES,
    WIDTH,
    stay_report,
)
from wardlens.sources.transcode import transcode_files
from wardlens.streaming.ingest import ingest_available, ingest_table

THREE = stay_report("202401", 3)


def beds_line(cnes="1234567", uf="SP", beds="10", upto=35):
    fields = ["202401", "SUDESTE", uf, "355030", "SAO PAULO", "", cnes, "HOSPITAL \x96 Á"]
    fields += [""] * 13 + [beds, "8"] + ["1"] * 12
    return ";".join(fields[:upto])


def write(path, lines, encoding="latin-1"):
    path.write_bytes("\r\n".join(lines).encode(encoding) + b"\r\n")
    return str(path)


@pytest.fixture
def beds_file(tmp_path):
    return write(
        tmp_path / "beds.csv",
        [
            ";".join(BEDS.fieldNames()).upper(),
            beds_line(),
            beds_line(cnes="2", beds="n/d"),
            beds_line(cnes="3", uf="S.P."),
            beds_line(cnes="4", upto=23),
            beds_line(cnes="5") + ";a mais",
            beds_line(cnes='"6"'),
        ],
    )


def test_declared_layouts():
    assert [len(s) for s in (BEDS, ADMISSIONS, DISEASE_CODES, DISEASE_CHAPTERS)] == [35, 114, 8, 5]
    assert len(stay_report()) == 22
    assert stay_report().fieldNames()[1] == "m_202410" and stay_report().fieldNames()[-2] == "m_202605"
    assert ADMISSIONS["n_aih"].metadata[WIDTH] == 20 and ADMISSIONS["aud_just"].metadata[WIDTH] == 100


def test_delimited_types_characters_and_rejects(spark, beds_file):
    load = read_delimited(spark, beds_file, BEDS)
    good = {r.cnes: r for r in load.good.collect()}
    assert set(good) == {"1234567", "4", "5", "6"}
    assert good["1234567"].nome_estabelecimento == "HOSPITAL – Á"
    assert good["1234567"].leitos_existentes == 10
    assert good["4"].leitos_sus == 8 and good["4"].uti_coronariana_sus is None
    assert good["5"].uti_coronariana_sus == 1
    assert good["1234567"].motivo_desabilitacao is None
    assert {r.cnes: r[REASON] for r in load.rejected.collect()} == {
        "2": "leitos_existentes: nao numerico",
        "3": "uf: mais de 2 caracteres",
    }
    assert rows(load.rows.where(SURPLUS).select("cnes", FILE)) == [("5", "beds.csv")]
    assert rows(load.audit.drop("motivo")) == [("beds.csv", 6, 2, 1)]


def test_report_skips_its_preamble(spark, tmp_path):
    path = write(
        tmp_path / "report.csv",
        [
            "Internações Hospitalares \x96 SUS",
            "Dias Perm",
            "Período:Jan/2024-Mar/2024",
            "Estab;Jan;Fev;Mar;Total",
            "0000012 HOSPITAL S\xc3O \x96 JOS\xc9;1;-;3;4",
            "0000013 CURTO;5",
            "Total;6;0;3;9",
        ],
    )
    got = rows(read_report(spark, path, THREE).good)
    assert sorted(got) == [
        ("0000012 HOSPITAL SÃO – JOSÉ", "1", "-", "3", "4"),
        ("0000013 CURTO", "5", None, None, None),
        ("Total", "6", "0", "3", "9"),
    ]


def test_preamble_is_skipped_once_per_file_however_it_is_split(spark, tmp_path):
    for name in ("a", "b"):
        write(tmp_path / f"{name}.csv", ["p"] * 4 + [f"{name}{i:04d}" for i in range(500)])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    try:
        lines = lines_after(spark, str(tmp_path), 4, "UTF-8")
        got = sorted(r.linha for r in lines.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == [f"{n}{i:04d}" for n in ("a", "b") for i in range(500)]


def test_wildcard_empty_quoted_short_and_long_rows(spark, tmp_path):
    header = ",".join(ADMISSIONS.fieldNames())
    blank = [""] * 114

    def line(**values):
        fields = list(blank)
        for name, value in values.items():
            fields[ADMISSIONS.fieldNames().index(name)] = value
        return fields

    write(tmp_path / "rd_01.csv", [header, ",".join(line(uf_zi="SP", ano_cmpt='""', cnes="1"))])
    write(
        tmp_path / "rd_02.csv",
        [header, "RJ,2024", ",".join(line(uf_zi="MG", fonte_orc="9")) + ",x,y"],
    )
    load = read_delimited(spark, f"{tmp_path}/rd_*.csv", ADMISSIONS, sep=",", charset="UTF-8")
    got = {r.uf_zi: r for r in load.good.collect()}
    assert got["SP"].ano_cmpt is None and got["SP"].mes_cmpt is None and got["SP"].cnes == "1"
    assert got["RJ"].ano_cmpt == "2024" and got["RJ"].fonte_orc is None
    assert got["MG"].fonte_orc == "9"
    assert sorted(rows(load.audit.drop("motivo"))) == [("rd_01.csv", 1, 0, 0), ("rd_02.csv", 2, 0, 1)]


def test_reject_limit_fails_without_a_trace(spark, beds_file):
    table = f"{tables.scratch_database(spark)}.beds"
    load = read_delimited(spark, beds_file, BEDS)
    with pytest.raises(tables.RejectLimitExceeded):
        tables.append_load(load, table, reject_limit=1)
    assert not spark.catalog.tableExists(table)
    failed = tables.recent_loads(spark, table).first()
    assert (failed.arquivo, failed.rejeitadas, failed.situacao) == ("beds.csv", 2, "FALHA")
    report = tables.append_load(load, table, reject_limit=2).first()
    assert (report.lidas, report.rejeitadas, report.com_excedente) == (6, 2, 1)
    tables.append_load(load, table, reject_limit=2)
    assert spark.table(table).count() == 8
    tables.reload(load, table, reject_limit=2)
    assert spark.table(table).count() == 4
    assert [r.situacao for r in tables.recent_loads(spark, table).collect()] == ["OK"] * 3 + ["FALHA"]


def test_failed_reload_keeps_the_old_rows(spark, beds_file):
    table = f"{tables.scratch_database(spark)}.beds"
    load = read_delimited(spark, beds_file, BEDS)
    tables.append_load(load, table, reject_limit=2)
    before = sorted(map(repr, spark.table(table).collect()))
    with pytest.raises(tables.RejectLimitExceeded):
        tables.reload(load, table, reject_limit=1)
    assert sorted(map(repr, spark.table(table).collect())) == before


def report_file(path, months, rows_, total=True):
    header = ";".join(["Estab", *months, *(["Total"] if total else [])])
    return write(path, ["t", "Dias Perm", "p", header, *rows_])


@pytest.mark.parametrize(
    "name, month",
    [("2024/Out", "202410"), ("Out/2024", "202410"), ("2025-01", "202501"), ("202512", "202512"),
     ("12/2024", "202412"), ("Total", None), ("2024/13", None), ("Jan", None), ("", None)],
)
def test_month_names(name, month):
    assert month_of(name) == month


def test_report_months_come_from_each_header(spark, tmp_path):
    report_file(tmp_path / "a.csv", ["2024/Out", "2024/Nov"], ["0000001 A;1;2;3"])
    shifted = [f"{2024 + m // 12}/{MONTH_NAMES[m % 12]}" for m in range(10, 31)]  # 21 months
    report_file(tmp_path / "b.csv", shifted, ["0000002 B;" + ";".join(map(str, range(21))) + ";99"])
    load = read_report(spark, str(tmp_path / "*.csv"))
    got = {r.estab_cidade: r for r in load.good.collect()}
    a, b = got["0000001 A"], got["0000002 B"]
    assert (a.m_202410, a.m_202411, a.m_202412, a.total) == ("1", "2", None, "3")
    assert (b.m_202410, b.m_202411, b.m_202607, b.total) == (None, "0", "20", "99")
    assert load.rows.where(SURPLUS).count() == 0
    table = f"{tables.scratch_database(spark)}.stays"
    tables.append_load(read_report(spark, str(tmp_path / "a.csv")), table)
    tables.append_load(read_report(spark, str(tmp_path / "b.csv")), table)
    stored = {r.estab_cidade: r for r in spark.table(table).collect()}
    assert (stored["0000001 A"].m_202411, stored["0000001 A"].m_202607) == ("2", None)
    assert (stored["0000002 B"].m_202411, stored["0000002 B"].m_202607) == ("0", "20")


@pytest.mark.parametrize("months", [["Jan", "Fev"], ["2024/Out", "2024/Out"], [], ["2024/Out", "leitos"]])
def test_wrong_report_header_fails(spark, tmp_path, months):
    path = report_file(tmp_path / "r.csv", months, ["0000001 A;1;2;3"])
    with pytest.raises(UnknownLayout):
        read_report(spark, path)


def test_view_follows_its_table(spark):
    db = tables.scratch_database(spark)
    tables.materialize(spark.range(3), f"{db}.t")
    tables.define_view(spark, f"{db}.v", f"select sum(id) as s from {db}.t")
    assert spark.table(f"{db}.v").first().s == 3
    tables.materialize(spark.range(5), f"{db}.t")
    assert spark.table(f"{db}.v").first().s == 10


def test_transcode_reports_bad_files_and_missing_folders(spark, tmp_path):
    good, bad = tmp_path / "um", tmp_path / "dois"
    good.mkdir(), bad.mkdir()
    write(good / "a.csv", ["nome;n", "S\xe3o;1", '"a;b";2'])
    (bad / "x.csv.gz").write_bytes(b"not gzip at all")
    write(bad / "y.csv", ["nome;n", "fim;3"])
    target = str(tmp_path / "saida")
    status = transcode_files(
        spark, [str(good), str(bad), str(tmp_path / "nada")], target, pattern="*.csv*"
    )
    got = {(r.pasta.rsplit("/", 1)[-1], r.arquivo): (r.linhas, r.situacao) for r in status.collect()}
    assert got == {
        ("um", "a.csv"): (2, "OK"),
        ("dois", "x.csv.gz"): (None, "ERRO"),
        ("dois", "y.csv"): (1, "OK"),
        ("nada", None): (None, "PASTA AUSENTE OU VAZIA"),
    }
    back = spark.read.csv(f"{target}/000/_arquivo=a.csv", header=True)
    assert sorted(rows(back)) == [("São", "1"), ("a;b", "2")]


def test_stream_loads_each_file_once(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    header = ",".join(ADMISSIONS.fieldNames())
    write(folder / "rd_01.csv", [header, "SP,2024,01", "X" * 16 + ",2024,01"])
    target, checkpoint = str(tmp_path / "t"), str(tmp_path / "c")

    def run():
        load = ingest_available(spark, str(folder), ADMISSIONS, target, checkpoint)
        good = sorted(rows(load.good.select("uf_zi", "ano_cmpt", "mes_cmpt")))
        return good, load.rejected.count()

    assert run() == ([("SP", "2024", "01")], 1)
    assert run() == ([("SP", "2024", "01")], 1)
    write(folder / "rd_02.csv", [header, "SP,2024,02"])
    assert run() == ([("SP", "2024", "01"), ("SP", "2024", "02")], 1)
    assert run()[0] == [("SP", "2024", "01"), ("SP", "2024", "02")]


def test_stream_takes_files_of_any_age_once_and_stops_over_the_limit(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    header = ",".join(ADMISSIONS.fieldNames())
    db, checkpoint = tables.scratch_database(spark), str(tmp_path / "c")

    def drop(name, *lines, days_old=0):
        path = write(folder / name, [header, *lines])
        then = time.time() - days_old * 86_400
        os.utime(path, (then, then))

    def run(limit=10):
        table = ingest_table(spark, str(folder), db, checkpoint, reject_limit=limit)
        return sorted(r.mes_cmpt for r in spark.table(table).collect())

    drop("b.csv", "SP,2024,02")
    assert run() == ["02"]
    drop("a.csv", "SP,2024,01", days_old=30)
    assert run() == ["01", "02"]
    drop("old.csv", "SP,2024,00", days_old=400)
    assert run() == run() == ["00", "01", "02"]
    drop("bad.csv", "X" * 16 + ",2024,03", "SP,2024,03")
    with pytest.raises(Exception, match="rows rejected"):
        run(limit=0)
    assert sorted(r.mes_cmpt for r in spark.table(f"{db}.brz_sih_rd_raw").collect()) == ["00", "01", "02"]
    assert run() == ["00", "01", "02", "03"]
    loads = tables.recent_loads(spark, f"{db}.brz_sih_rd_raw", 10).collect()
    assert sorted((r.arquivo, r.situacao) for r in loads) == [
        ("a.csv", "OK"), ("b.csv", "OK"), ("bad.csv", "FALHA"), ("bad.csv", "OK"), ("old.csv", "OK"),
    ]


def test_audit_survives_column_pruning(spark, beds_file):
    load = read_delimited(spark, beds_file, BEDS)
    assert load.rejected.agg(F.count("*")).first()[0] == 2
    assert load.good.count() == 4
    assert load.good.select("cnes").distinct().count() == 4


def test_files_to_gold(spark, tmp_path, capsys):
    """Every source from a file, through the whole build, to the printed reports."""
    db = tables.scratch_database(spark)
    months = [f.name[2:] for f in stay_report() if f.name.startswith("m_")]
    named = [f"{m[:4]}/{MONTH_NAMES[int(m[4:]) - 1].title()}" for m in months]
    stay_lines = ["t", "s", "p", "Estab;" + ";".join(named) + ";Total"]
    bed_lines, adm_lines = [";".join(BEDS.fieldNames())], [",".join(ADMISSIONS.fieldNames())]
    for n in range(1, 13):
        stay_lines.append(f"{n:07d} HOSP {n};" + ";".join(str(n * 20 + i) for i in range(20)) + ";0")
        for month in months:
            fields = dict.fromkeys(BEDS.fieldNames(), "")
            fields |= {"comp": month, "co_ibge": "355030", "cnes": f"{n:07d}"}
            fields |= {"nome_estabelecimento": f"HOSP {n}", "ds_tipo_unidade": "GERAL"}
            fields |= {"leitos_sus": str(n % 5), "uti_total_sus": "1"}
            bed_lines.append(";".join(fields.values()))
            fields = dict.fromkeys(ADMISSIONS.fieldNames(), "")
            fields |= {"cnes": str(n), "ano_cmpt": month[:4], "mes_cmpt": month[4:], "n_aih": str(n)}
            fields |= {"dias_perm": str(n), "uti_mes_to": "1", "cod_idade": "4", "idade": str(n * 5)}
            fields |= {"munic_mov": "355030", "diag_princ": "A000", "car_int": "02", "complex": "03"}
            adm_lines.append(",".join(fields.values()))
    files = {
        "stays": write(tmp_path / "stays.csv", stay_lines),
        "beds": write(tmp_path / "beds.csv", bed_lines),
        "admissions": write(tmp_path / "RDSP2401.csv", adm_lines, "utf-8"),
        "codes": write(tmp_path / "sub.csv", ["h", "A000;;;;C\xf3lera;Colera;;"]),
        "chapters": write(tmp_path / "cap.csv", ["h", "I;A00;B99;Infecciosas;Inf"]),
    }
    for source, path in files.items():
        bronze.load(spark, db, source, path)
    pipeline.build(spark, db)
    monthly = spark.table(f"{db}.gld_ocupacao_mensal")
    assert monthly.count() == 12 * 20
    # Hospital 1, first month: 20 days over 1 bed and 31 days.
    first = monthly.where("co_cnes = '0000001' and competencia = '202410'").first()
    assert (str(first.taxa_ocupacao), first.semaforo) == ("64.5", "OK")
    assert spark.table(f"{db}.gld_features_hospital").count() == 12
    assert rows(spark.table(f"{db}.dim_cid")) == [("A000", "Cólera", "I", "Infecciosas")]
    pipeline.build_clusters(spark, db)
    assert spark.table(f"{db}.gld_fatores_hospital").count() == 12
    pipeline.show_reports(spark, db)
    printed = capsys.readouterr().out
    assert "Fullest hospitals now" in printed and "Newest loads of stays" in printed
    assert spark.table(f"{db}.gld_perfil_clinico").count() > 0
