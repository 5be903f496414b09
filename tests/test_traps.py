"""One small table per semantic trap, with results typed by hand."""

from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import rows
from wardlens.functions import casts, decode, keys, rounding
from wardlens.operators.reshape import unpivot_months
from wardlens.operators.selection import at_latest, first_rows
from wardlens.plans import gold, reports, silver, situation

D = Decimal


def one(spark, values, expression, name="x", kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {name} {kind}")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def occupancy(spark, data):
    """Rows of (hospital, month, rate in tenths or None) as slv_ocupacao."""
    full = [
        (h, f"Nome {h}", "GERAL", m, D("10.0000"), 100, None if t is None else D(t) / 10)
        for h, m, t in data
    ]
    return spark.createDataFrame(
        full,
        "co_cnes string, nome_estabelecimento string, ds_tipo_unidade string, competencia string, "
        "paciente_dia decimal(18,4), leito_dia bigint, taxa_ocupacao decimal(18,1)",
    )


def test_t1_empty_text_is_null(spark):
    assert one(spark, ["", None, "7"], keys.pad_key(F.col("x"))) == [None, None, "0000007"]
    assert one(spark, ["12", "12 A"], keys.name_after_code(F.col("x"))) == [None, "A"]


def test_key_is_cut_at_its_width(spark):
    assert one(spark, ["12345678"], keys.pad_key(F.col("x"))) == ["1234567"]


def test_t2_missing_part_of_period(spark):
    df = spark.createDataFrame([("2024", None), ("2024", "01"), (None, None)], "a string, m string")
    assert rows(df.select(keys.period_key(F.col("a"), F.col("m")))) == [
        ("2024",),
        ("202401",),
        (None,),
    ]


def test_t3_missing_rate_ranks_first_or_last(spark):
    o = occupancy(spark, [("1", "202401", 900), ("2", "202401", None), ("3", "202401", 900)])
    rank = {r.co_cnes: r.ranking_no_mes for r in gold.monthly_occupancy(o).collect()}
    assert rank == {"2": 1, "1": 2, "3": 2}
    rank = {r.co_cnes: r.ranking_no_mes for r in gold.monthly_occupancy(o, "last").collect()}
    assert rank == {"1": 1, "3": 1, "2": 3}


def test_t4_traffic_light(spark):
    rates = [D("69.9"), D("70.0"), D("85.0"), D("85.1"), None]
    light = one(spark, rates, decode.traffic_light("x"), kind="decimal(18,1)")
    assert light == ["OK", "ATENCAO", "ATENCAO", "CRITICO", "OK"]


def test_t5_deviation_of_one_row_is_zero(spark, inputs):
    o = occupancy(
        spark,
        [
            ("0000001", "202401", 500),
            ("0000002", "202401", None),
            ("0000003", "202401", 100),
            ("0000003", "202402", 200),
            ("0000003", "202403", None),
        ],
    )
    f = gold.hospital_features(o, inputs.admissions.limit(0), inputs.beds.limit(0))
    result = {r.co_cnes: (r.taxa_media, r.taxa_max, r.taxa_desvio, r.meses_com_dado) for r in f.collect()}
    assert result == {
        "0000001": (D("50.0"), D("50.0"), D("0.0"), 1),
        "0000002": (None, None, None, 1),
        "0000003": (D("15.0"), D("20.0"), D("7.1"), 3),
    }


def test_t6_unpivot_drops_missing_cells(spark):
    wide = spark.createDataFrame(
        [("1 A", "5", None), ("2 B", "-", "7")], "estab string, m_202401 string, m_202402 string"
    )
    long = unpivot_months(wide, ["estab"], "competencia", "dias")
    assert sorted(rows(long)) == [
        ("1 A", "202401", "5"),
        ("2 B", "202401", "-"),
        ("2 B", "202402", "7"),
    ]


@settings(max_examples=5, deadline=None)
@given(
    st.lists(
        st.tuples(st.integers(-(10**9), 10**9), st.integers(-(10**6), 10**6)),
        min_size=50,
        max_size=200,
    )
)
def test_t7_ratio_rounds_half_away_from_zero(spark, pairs):
    pairs = pairs + [(1005, 1000), (-1005, 1000), (5, 100), (-5, 100), (1, 0), (0, 3)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, n bigint, d bigint")
    for scale in (0, 1, 2):
        got = df.orderBy("i").select(rounding.ratio("n", "d", scale)).collect()
        for (n, d), (value,) in zip(pairs, got):
            if d == 0:
                assert value is None
                continue
            size = (2 * abs(n) * 10**scale + abs(d)) // (2 * abs(d))
            exact = size if n * d >= 0 else -size
            assert D(value) * 10**scale == exact


def test_t7_fractional_days_keep_their_fraction(spark):
    df = spark.createDataFrame([(D("3.5000"), 28)], "n decimal(18,4), d bigint")
    assert rows(df.select(rounding.percent("n", "d", 1))) == [(D("12.5"),)]


def test_t8_tolerant_casts(spark):
    numbers = one(spark, ["3.5", "x", "", None, "7"], casts.number_or_null(F.col("x")))
    assert numbers == [D("3.5"), None, None, None, D("7")]
    dates = one(
        spark, ["20240229", "20240230", "2024022", " 20240229", None], casts.date_or_null(F.col("x"))
    )
    assert [d and d.isoformat() for d in dates] == ["2024-02-29", None, None, None, None]


def test_t9_strict_cast_fails_the_job(spark):
    wide = spark.createDataFrame([("1 A", "12x")], "estab_cidade string, m_202401 string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        silver.patient_days(wide).collect()


def test_t10_money_has_two_decimals(spark):
    text = ["1234", "1234.5", "-5.00", "1.239", "1e2", "", "999999999999.99"]
    assert one(spark, text, casts.money_or_null(F.col("x"))) == [
        D("1234.00"),
        D("1234.50"),
        D("-5.00"),
        None,
        None,
        None,
        D("999999999999.99"),
    ]


def test_t11_no_beds_gives_no_rate(spark):
    stays = spark.createDataFrame(
        [("0000001", "A", "202402", D(29)), ("0000002", "B", "202402", D(5))],
        "co_cnes string, no_estabelecimento string, competencia string, dias_perm decimal(18,4)",
    )
    beds = spark.createDataFrame(
        [("0000001", "202402", "A", "GERAL", 2), ("0000002", "202402", "B", "GERAL", 0)],
        "cnes string, competencia string, nome_estabelecimento string, ds_tipo_unidade string, leitos_sus int",
    )
    got = {r.co_cnes: (r.leito_dia, r.taxa_ocupacao) for r in silver.occupancy(stays, beds).collect()}
    assert got == {"0000001": (58, D("50.0")), "0000002": (0, None)}


def test_fractional_beds_give_fractional_bed_days(spark):
    stays = spark.createDataFrame(
        [("1", "A", "202402", D("29")), ("2", "B", "202402", D("5"))],
        "co_cnes string, no_estabelecimento string, competencia string, dias_perm decimal(18,4)",
    )
    beds = spark.createDataFrame(
        [("1", "202402", "A", "GERAL", D("10.5")), ("2", "202402", "B", "GERAL", D("3000000000"))],
        "cnes string, competencia string, nome_estabelecimento string, ds_tipo_unidade string, leitos_sus decimal(18,4)",
    )
    got = {r.co_cnes: (r.leito_dia, r.taxa_ocupacao) for r in silver.occupancy(stays, beds).collect()}
    assert got == {"1": (D("304.5"), D("9.5")), "2": (D("87000000000"), D("0.0"))}


def test_registry_key_padding_is_optional(spark):
    stays = spark.createDataFrame(
        [("0000001", "A", "202402", D(29))],
        "co_cnes string, no_estabelecimento string, competencia string, dias_perm decimal(18,4)",
    )
    beds = spark.createDataFrame(
        [("1", "202402", "A", "GERAL", 2)],
        "cnes string, competencia string, nome_estabelecimento string, ds_tipo_unidade string, leitos_sus int",
    )
    assert silver.occupancy(stays, beds).count() == 0
    assert silver.occupancy(stays, beds, padded_keys=True).count() == 1


def test_t12_city_count_is_null_without_matches(spark):
    raw = spark.createDataFrame(
        [("2024", "01", "350000"), ("2024", "02", "355030")],
        "ano_cmpt string, mes_cmpt string, munic_mov string",
    )
    assert rows(reports.bronze_volume(raw)) == [("2024", "01", 1, None), ("2024", "02", 1, 1)]


def test_t13_no_leading_code_is_null(spark):
    assert one(spark, ["Total", "12 A"], keys.leading_code(F.col("x"))) == [None, "12"]


def test_t16_ties_have_one_order(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", 1)], "k string, v int")
    assert rows(first_rows(df.repartition(3), 2, "v", "k")) == [("a", 1), ("b", 1)]


def test_t17_trend_counts_rows_not_months(spark):
    o = occupancy(
        spark,
        [("1", "202401", 100), ("1", "202402", None), ("1", "202405", 205), ("1", "202406", 300)],
    )
    got = rows(
        gold.trend(o).orderBy("competencia").select("var_vs_mes_anterior", "media_movel_3m")
    )
    assert got == [
        (None, D("10.0")),
        (None, D("10.0")),
        (None, D("15.3")),
        (D("9.5"), D("25.3")),
    ]


def test_domains(spark):
    assert one(spark, ["1", "3", "0", None], decode.sex(F.col("x"))) == ["M", "F", "IGN", "IGN"]
    assert one(spark, ["02", "03", "01", None], decode.complexity(F.col("x"))) == [
        "MEDIA",
        "ALTA",
        "OUTRA",
        "OUTRA",
    ]
    assert one(spark, ["01", "02", "05", None], decode.admission_kind(F.col("x"))) == [
        "ELETIVO",
        "URGENCIA",
        "OUTRO",
        "OUTRO",
    ]
    assert one(spark, ["1", "0", None], decode.death_flag(F.col("x"))) == [1, 0, 0]


def test_age_units(spark):
    data = [("4", "30"), ("3", "7"), ("2", "100"), ("1", "5"), ("4", "x"), (None, "3"), ("3", "3")]
    df = spark.createDataFrame([(i, *d) for i, d in enumerate(data)], "i int, u string, a string")
    ages = df.orderBy("i").select(decode.age_in_years(F.col("u"), F.col("a"))).collect()
    # 7/12 = 0.583 -> 0.6, 100/365 = 0.27397 -> 0.27, 3/12 = 0.25 -> 0.3
    assert [a[0] for a in ages] == [D(30), D("0.6"), D("0.27"), None, None, None, D("0.3")]


def test_sentinels_and_total_row_are_dropped(spark):
    wide = spark.createDataFrame(
        [("0000012 A", "5", "-"), ("Total", "5", "0"), ("0000013", None, "8")],
        "estab_cidade string, m_202401 string, m_202402 string",
    )
    assert sorted(rows(silver.patient_days(wide)), key=str) == [
        ("0000012", "A", "202401", D("5.0000")),
        ("0000013", None, "202402", D("8.0000")),
    ]


def test_signed_difference(spark):
    kinds = "competencia string, dias_perm decimal(18,4)"
    rd = spark.createDataFrame([("202401", D(95)), ("202402", D(5)), ("202403", D(1))], kinds)
    tab = spark.createDataFrame([("202401", D(100)), ("202402", D(0)), ("202404", D(1))], kinds)
    assert rows(reports.reconciliation(rd, tab)) == [
        ("202401", D(95), D(100), D("-5.0")),
        ("202402", D(5), D(0), None),
    ]


def test_name_change_fans_out_unless_single(spark, inputs):
    o = occupancy(spark, [("1", "202401", 100), ("1", "202402", 200)]).withColumn(
        "nome_estabelecimento", F.concat(F.lit("N"), "competencia")
    )
    none = inputs.admissions.limit(0), inputs.beds.limit(0)
    both = gold.hospital_features(o, *none)
    assert {r.nome_estabelecimento for r in both.collect()} == {"N202401", "N202402"}
    single = gold.hospital_features(o, *none, single_name=True)
    assert [r.nome_estabelecimento for r in single.collect()] == ["N202402"]


def test_latest_and_direction(spark):
    o = occupancy(
        spark,
        [
            ("1", "202401", 100),
            ("1", "202402", 200),
            ("2", "202401", 300),
            ("2", "202402", 250),
            ("3", "202402", 900),
            ("4", "202401", 900),
        ],
    )
    assert {r.co_cnes for r in at_latest(o).collect()} == {"1", "2", "3"}
    assert {r.co_cnes: r.direcao for r in situation.direction(o).collect()} == {
        "1": "PIORANDO",
        "2": "MELHORANDO",
        "3": None,
    }
    assert [r.co_cnes for r in situation.above_limit(o).collect()] == ["3"]


def test_enormous_rates_do_not_overflow(spark, inputs):
    """One bed and a third of all admissions: squares of the rate pass 64 bits."""
    o = occupancy(spark, [("1", "202401", 4 * 10**12), ("1", "202402", 2 * 10**12)])
    f = gold.hospital_features(o, inputs.admissions.limit(0), inputs.beds.limit(0)).first()
    assert f.taxa_media == D("300000000000.0")
    assert f.taxa_desvio == D("141421356237.3")
    assert gold.monthly_occupancy(o).agg(F.max("media_movel_3m")).first()[0] == D("400000000000.0")


def test_d3_patient_days_of_every_hospital_count(spark, tmp_path):
    """Line items of any hospital reach the report, those whose key ends in 5 too."""
    from wardlens.sources.driver_tables import stays_wide

    hospitals = range(1, 31)
    spark.createDataFrame([(h, f"Hospital {h}") for h in hospitals], "s_suppkey bigint, s_name string").write.parquet(
        f"{tmp_path}/supplier.parquet"
    )
    # Ten months each: no hospital has all of them in cells that are empty or '-'.
    spark.createDataFrame(
        [(h, 2.0, f"1996-{m:02d}-10") for h in hospitals for m in range(1, 11)],
        "l_suppkey bigint, l_quantity double, day string",
    ).select("l_suppkey", "l_quantity", F.col("day").cast("timestamp").alias("l_shipdate")).write.parquet(
        f"{tmp_path}/lineitem.parquet"
    )
    stays = silver.patient_days(stays_wide(spark, str(tmp_path)))
    assert rows(stays.select("co_cnes").distinct().orderBy("co_cnes")) == [(f"{h:07d}",) for h in hospitals]
