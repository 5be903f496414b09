"""The plans that matter at scale: pushdown, pruning, exchanges, windows, joins."""

import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import SMALL
from wardlens.operators.selection import at_latest
from wardlens.plans import clinical, gold, pipeline, reports, silver
from wardlens.session import shared_path
from wardlens.sources import driver_tables, schemas, tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """Plan as if no side were small."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


@pytest.fixture(scope="module")
def silver_tables(spark, inputs):
    db = tables.scratch_database(spark)
    tables.materialize_by_hospital(inputs.stays, f"{db}.stays", "co_cnes")
    tables.materialize_by_hospital(inputs.beds, f"{db}.beds", "cnes")
    tables.materialize_by_hospital(inputs.occupancy, f"{db}.occupancy", "co_cnes")
    tables.materialize_by_month(inputs.admissions, f"{db}.admissions", "co_cnes", "n_aih")
    return db


def test_city_filter_and_columns_reach_the_scan(spark, inputs):
    path = shared_path(spark, "raw")
    inputs.admissions_raw.write.parquet(path)
    text = plan(reports.admissions_by_month(silver.admissions(spark.read.parquet(path))))
    assert "EqualTo(munic_mov,355030)" in text
    read = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in read.split(",")} == {
        "ano_cmpt",
        "mes_cmpt",
        "dias_perm",
        "morte",
        "munic_mov",
    }


def test_bucketed_tables_join_and_trend_without_exchange(spark, silver_tables, no_broadcast):
    joined = silver.occupancy(
        spark.table(f"{silver_tables}.stays"), spark.table(f"{silver_tables}.beds")
    )
    text = plan(gold.trend(joined))
    assert "SortMergeJoin" in text and "Window" in text
    assert "Exchange" not in text


def test_occupancy_passes_neither_side_through_the_driver(spark):
    """Rows made by adding or unpivoting months are not in the planner's estimates, before or during the run."""
    hospitals = [("0000001", "A", 10), ("0000001", "B", 20), ("0000002", None, 0), (None, "C", 1)]
    registry = spark.createDataFrame(hospitals, "cnes string, nome_estabelecimento string, leitos_sus int").select(
        "*", F.lit("G").alias("ds_tipo_unidade"), F.explode(F.array(F.lit("202401"), F.lit("202402"))).alias("competencia")
    )
    report = [("0000001 X", "155", "-"), ("0000002 Y", "31", "0"), ("0000003 Z", "9", "9"), ("Total", "195", "9")]
    wide = spark.createDataFrame(report, "estab_cidade string, m_202401 string, m_202402 string")
    joined = silver.occupancy(silver.patient_days(wide), registry)
    rows = [(r.co_cnes, r.nome_estabelecimento, r.competencia, r.leito_dia) for r in joined.collect()]
    assert sorted(rows, key=str) == [
        ("0000001", "A", "202401", 310),
        ("0000001", "B", "202401", 620),
        ("0000002", None, "202401", 0),
        ("0000002", None, "202402", 0),
    ]
    text = plan(joined)
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text


@pytest.mark.parametrize("single_name", [False, True])
def test_feature_matrix_merges_stays_and_beds(inputs, single_name):
    text = plan(gold.hospital_features(inputs.occupancy, inputs.admissions, inputs.beds, single_name))
    joins = re.findall(r"(\w+Join) \[co_cnes#\d+, competencia#\d+\]", text)
    assert len(joins) == 2 - single_name and set(joins) == {"SortMergeJoin"}


def test_trend_windows_share_one_sort(spark, silver_tables):
    text = plan(gold.trend(spark.table(f"{silver_tables}.occupancy")))
    assert len(re.findall(r"\bWindow \[", text)) == 1 and "Exchange" not in text


def test_rank_window_sees_counts_not_rows(spark, silver_tables):
    text = plan(gold.monthly_occupancy(spark.table(f"{silver_tables}.occupancy")))
    windows = re.findall(r"Window \[.*", text)
    by_month = [w for w in windows if "windowspecdefinition(mes" in w]
    assert len(by_month) == 1 and "sum(linhas" in by_month[0]
    assert not any("windowspecdefinition(competencia" in w for w in windows)


def test_stored_ranks_leave_the_rows_in_place(spark, silver_tables):
    occupancy = spark.table(f"{silver_tables}.occupancy")
    text = plan(gold.monthly_occupancy(occupancy, store_ranks=True))
    assert re.findall(r"\w*Exchange\b", text) == ["BroadcastExchange"]


def test_latest_month_prunes_partitions(spark, silver_tables):
    text = plan(at_latest(spark.table(f"{silver_tables}.admissions")))
    assert re.search(r"PartitionFilters: \[.*competencia#\d+ = .*subquery", text)


def test_lights_need_no_window(spark, silver_tables):
    assert "Window" not in plan(reports.lights_now(spark.table(f"{silver_tables}.occupancy")))


def test_limits_are_per_partition_top_n(spark, silver_tables):
    text = plan(reports.occupancy_sample(spark.table(f"{silver_tables}.occupancy")))
    assert "TakeOrderedAndProject(limit=20" in text


def test_no_nested_loops_or_products(spark, inputs, no_broadcast):
    plans = [
        gold.monthly_occupancy(inputs.occupancy),
        gold.hospital_features(inputs.occupancy, inputs.admissions, inputs.beds),
        inputs.diseases,
        clinical.clinical_profile(inputs.admissions, inputs.diseases),
        reports.dictionary_counts(
            driver_tables.disease_codes_raw(spark, SMALL), driver_tables.disease_chapters_raw(spark)
        ),
        reports.ranking_board(inputs.occupancy),
    ]
    for df in plans:
        text = plan(df)
        assert "NestedLoop" not in text and "CartesianProduct" not in text
        assert "BroadcastHashJoin" not in text
        assert "Python" not in text and "Pandas" not in text


def test_month_layout_clusters_hospitals(spark, silver_tables):
    table = spark.table(f"{silver_tables}.admissions")
    files = table.groupBy("competencia", F.input_file_name().alias("f")).agg(F.count("*"))
    months = table.select("competencia").distinct().count()
    assert files.count() < months + 8


def test_the_month_table_samples_its_ranges_on_filed_text(spark, monkeypatch):
    """Values are parsed once, above the exchange whose sampling makes the rows below it a second time."""
    seen, wanted = {}, ("co_cnes", "competencia", "n_aih", "dt_internacao", "val_total")

    def watched(writer, session, table, schema=None):
        if table.endswith("slv_internacao"):
            seen["plan"] = writer._df._jdf.queryExecution().optimizedPlan().toString()
            seen["rows"] = sorted(tuple(r) for r in writer._df.select(*wanted).collect())
        return replace(writer, session, table, schema)

    replace = tables._replace
    monkeypatch.setattr(tables, "_replace", watched)
    db = tables.scratch_database(spark)
    row = {"cnes": "7", "ano_cmpt": "2024", "mes_cmpt": "03", "n_aih": "1", "dt_inter": "20240301", "val_tot": "12.50", "munic_mov": silver.CITY}
    rows = [row, {**row, "n_aih": "2", "dt_inter": "20240230", "val_tot": "x"}, {**row, "n_aih": None, "munic_mov": None}]
    filed = spark.createDataFrame([tuple(r.values()) for r in rows], ", ".join(f"{n} string" for n in row))
    tables.materialize(filed, f"{db}.brz_sih_rd_raw", schemas.ADMISSIONS)
    layouts = {"beds": schemas.BEDS, "stays": schemas.stay_report(), "codes": schemas.DISEASE_CODES, "chapters": schemas.DISEASE_CHAPTERS}
    for name, layout in layouts.items():
        tables.materialize(spark.createDataFrame([], layout), f"{db}.{pipeline.BRONZE[name]}")
    pipeline.build_silver(spark, db)
    above, below = seen["plan"].split("RepartitionByExpression")
    assert "dt_internacao" in above and "dt_internacao" not in below and "val_total" not in below
    typed = silver.admissions(spark.table(f"{db}.brz_sih_rd_raw"))
    assert seen["rows"] == sorted(tuple(r) for r in typed.select(*wanted).collect()) and len(seen["rows"]) == 2


def test_declared_columns_without_values_are_not_written(spark):
    db = tables.scratch_database(spark)
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.IntegerType()), T.StructField("c", T.StringType())])
    table = f"{db}.t"
    for given in ([("x", 1)], [("y", None), ("y", None)]):
        tables.materialize(spark.createDataFrame([(b, a) for a, b in given], "b int, a string"), table, schema)
        got = spark.table(table)
        assert got.columns == ["a", "b", "c"] and [t for _, t in got.dtypes] == ["string", "int", "string"]
        assert sorted(map(tuple, got.collect())) == sorted((a, b, None) for a, b in given)
        files = got.select(F.input_file_name()).distinct().collect()
        assert "c" not in spark.read.parquet(*[f[0] for f in files]).columns
    with pytest.raises(ValueError, match="no column d"):
        tables.materialize(spark.createDataFrame([(1,)], "d int"), table, schema)


def test_invariants(spark, silver_tables, inputs):
    occupancy = spark.table(f"{silver_tables}.occupancy")
    assert occupancy.where("(taxa_ocupacao is null) <> (leito_dia = 0)").count() == 0
    newest = at_latest(occupancy).count()
    assert reports.lights_now(occupancy).agg(F.sum("hospitais")).first()[0] == newest
    trend = gold.trend(occupancy)
    first = trend.groupBy("co_cnes").agg(F.min("competencia").alias("competencia"))
    assert (
        trend.join(first, ["co_cnes", "competencia"]).where("var_vs_mes_anterior is not null").count()
        == 0
    )
    wide = inputs.stays_wide.where("estab_cidade rlike '^[0-9]'")
    cells = [c for c in wide.columns if c.startswith("m_")]
    filled = sum((F.expr(f"if({c} is not null and {c} <> '-', 1, 0)") for c in cells), F.lit(0))
    assert wide.agg(F.sum(filled)).first()[0] == spark.table(f"{silver_tables}.stays").count()
