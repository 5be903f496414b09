"""The check and business reports over silver and gold.

Every limited report ends its sort with key columns, so ties have one order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlens.functions.rounding import percent, ratio, tenths_sql
from wardlens.operators.selection import at_latest, first_rows, highest_first
from wardlens.plans import gold
from wardlens.plans.silver import CITY

# Fixed values below: the column names of every report, which readers of the reports rely on.
BANDS = ("CRITICO", "ATENCAO", "OK")

# --- admissions -----------------------------------------------------------------------


def admissions_by_month(internacao: DataFrame) -> DataFrame:
    return (
        internacao.groupBy("competencia")
        .agg(
            F.count("*").alias("aihs"),
            F.sum("dias_perm").alias("paciente_dia"),
            F.count("dias_perm").alias("n"),
            F.sum("fl_obito").alias("obitos"),
        )
        .select(
            "competencia",
            "aihs",
            "paciente_dia",
            ratio("paciente_dia", "n", 1).alias("perm_media"),
            "obitos",
        )
        .orderBy("competencia")
    )


def reconciliation(internacao: DataFrame, diasperm: DataFrame) -> DataFrame:
    """Patient days of the two admission sources by month, aggregated before they meet."""
    left = internacao.groupBy("competencia").agg(F.sum("dias_perm").alias("pd_rd"))
    right = diasperm.groupBy("competencia").agg(F.sum("dias_perm").alias("pd_tabnet"))
    return (
        left.join(right, "competencia")
        .select(
            "competencia",
            "pd_rd",
            "pd_tabnet",
            percent("pd_rd - pd_tabnet", "pd_tabnet", 1).alias("dif_pct"),
        )
        .orderBy("competencia")
    )


def bronze_volume(raw: DataFrame, city: str = CITY) -> DataFrame:
    """State and city counts by month; the city count is NULL where no row matches."""
    return (
        raw.groupBy("ano_cmpt", "mes_cmpt")
        .agg(
            F.count("*").alias("aihs_estado"),
            F.sum(F.when(F.col("munic_mov") == city, 1)).alias("aihs_capital"),
        )
        .orderBy("ano_cmpt", "mes_cmpt")
    )


def dictionary_counts(codes: DataFrame, chapters: DataFrame) -> DataFrame:
    """Two table counts side by side, the first as a scalar subquery of the second."""
    return chapters.agg(F.count("*").alias("capitulos")).select(
        codes.agg(F.count("*")).scalar().alias("subcategorias"), "capitulos"
    )


def admissions_sample(internacao: DataFrame, n: int = 20) -> DataFrame:
    return first_rows(
        internacao, n, "competencia", "co_cnes", "n_aih", "procedimento", "val_total"
    )


def admissions_by_complexity(internacao: DataFrame) -> DataFrame:
    return (
        internacao.groupBy("competencia", "complexidade")
        .agg(
            F.count("*").alias("qtd_internacoes"),
            F.sum("dias_perm").alias("paciente_dia"),
            F.count("dias_perm").alias("n"),
            F.sum("fl_obito").alias("obitos"),
        )
        .select(
            "competencia",
            "complexidade",
            "qtd_internacoes",
            "paciente_dia",
            ratio("paciente_dia", "n", 1).alias("permanencia_media"),
            "obitos",
        )
        .orderBy("competencia", "complexidade")
    )


# --- beds -----------------------------------------------------------------------------


def beds_sample(leitos: DataFrame, n: int = 20) -> DataFrame:
    columns = [
        "competencia",
        "cnes",
        "nome_estabelecimento",
        "razao_social",
        "tp_gestao",
        "ds_tipo_unidade",
        "natureza_juridica",
        "desc_natureza_juridica",
        "leitos_existentes",
        "leitos_sus",
        "uti_total_exist",
        "uti_total_sus",
    ]
    return first_rows(leitos.select(columns), n, "competencia", "cnes", "nome_estabelecimento")


def beds_by_unit_type(leitos: DataFrame) -> DataFrame:
    return (
        leitos.groupBy("ds_tipo_unidade")
        .agg(
            F.count_distinct("cnes").alias("qtd_hospitais"),
            F.sum("leitos_sus").alias("total_leitos_sus"),
            F.sum("uti_total_sus").alias("total_uti_sus"),
        )
        .orderBy(highest_first("total_leitos_sus"), "ds_tipo_unidade")
    )


# --- patient days ---------------------------------------------------------------------


def patient_days_sample(diasperm: DataFrame, n: int = 20) -> DataFrame:
    columns = ["co_cnes", "no_estabelecimento", "competencia", "dias_perm"]
    return first_rows(
        diasperm.select(columns), n, "competencia", "co_cnes", "no_estabelecimento", "dias_perm"
    )


def patient_days_by_month(diasperm: DataFrame) -> DataFrame:
    return (
        diasperm.groupBy("competencia")
        .agg(
            F.count_distinct("co_cnes").alias("qtd_hospitais"),
            F.sum("dias_perm").alias("total_paciente_dia"),
            F.count("dias_perm").alias("n"),
        )
        .select(
            "competencia",
            "qtd_hospitais",
            "total_paciente_dia",
            ratio("total_paciente_dia", "n", 1).alias("media_por_hospital"),
        )
        .orderBy("competencia")
    )


# --- occupancy ------------------------------------------------------------------------


def occupancy_sample(ocupacao: DataFrame, n: int = 20) -> DataFrame:
    """Oldest month first, worst rate first within it."""
    return first_rows(
        ocupacao,
        n,
        "competencia",
        highest_first("taxa_ocupacao"),
        "co_cnes",
        "nome_estabelecimento",
    )


def occupancy_by_unit_type(ocupacao: DataFrame) -> DataFrame:
    return (
        ocupacao.withColumn("decimos", F.expr(tenths_sql("taxa_ocupacao")))
        .groupBy("ds_tipo_unidade")
        .agg(
            F.count("*").alias("qtd_registros"),
            F.sum("decimos").alias("soma"),
            F.count("decimos").alias("n"),
            F.min("taxa_ocupacao").alias("taxa_min"),
            F.max("taxa_ocupacao").alias("taxa_max"),
        )
        .select(
            "ds_tipo_unidade",
            "qtd_registros",
            ratio("soma", "10 * n", 1).alias("taxa_media"),
            "taxa_min",
            "taxa_max",
        )
        .orderBy(highest_first("taxa_media"), "ds_tipo_unidade")
    )


# --- gold -----------------------------------------------------------------------------


def lights_now(ocupacao: DataFrame) -> DataFrame:
    return (
        gold.latest_lights(ocupacao)
        .groupBy("semaforo")
        .agg(F.count("*").alias("hospitais"))
        .orderBy("semaforo")
    )


def light_bands(ocupacao: DataFrame) -> DataFrame:
    """Hospitals of the newest month in each band, empty bands too, and those above 100 %."""
    lights = gold.latest_lights(ocupacao)
    bands = lights.sparkSession.createDataFrame([(b,) for b in BANDS], "faixa string")
    counted = lights.groupBy(F.col("semaforo").alias("faixa")).agg(F.count("*").alias("n"))
    above = lights.agg(
        F.lit("ACIMA DE 100").alias("faixa"), F.count_if(F.col("taxa_ocupacao") > 100).alias("hospitais")
    )
    return (
        bands.join(counted, "faixa", "left")
        .select("faixa", F.coalesce("n", F.lit(0)).cast("bigint").alias("hospitais"))
        .unionByName(above)
        .orderBy("faixa")
    )


def top_critical(ocupacao: DataFrame, n: int = 10) -> DataFrame:
    return gold.top_of_latest(ocupacao, n).select(
        "ranking_no_mes",
        "nome_estabelecimento",
        "taxa_ocupacao",
        "var_vs_mes_anterior",
        "media_movel_3m",
    )


def features_sample(
    ocupacao: DataFrame, internacao: DataFrame, leitos: DataFrame, n: int = 5
) -> DataFrame:
    """Hospitals with the highest mean rate.

    The mean rate needs occupancy only, so the n hospitals are picked there and the clinical
    and capacity aggregates run over their rows alone.
    """
    means = (
        ocupacao.withColumn("decimos", F.expr(tenths_sql("taxa_ocupacao")))
        .groupBy("co_cnes")
        .agg(F.sum("decimos").alias("soma"), F.count("decimos").alias("n"))
        .select("co_cnes", ratio("soma", "10 * n", 1).alias("taxa_media"))
    )
    # At most n rows, so the broadcast has a fixed bound.
    picked = F.broadcast(
        first_rows(means, n, highest_first("taxa_media"), "co_cnes").select("co_cnes")
    )
    features = gold.hospital_features(
        ocupacao.join(picked, "co_cnes", "left_semi"),
        internacao.join(picked, "co_cnes", "left_semi"),
        leitos.join(picked, F.col("cnes") == F.col("co_cnes"), "left_semi"),
    )
    return first_rows(
        features.select(
            "co_cnes",
            "nome_estabelecimento",
            "leitos_sus",
            "taxa_media",
            "perm_media",
            "pct_urgencia",
            "pct_alta_complex",
        ),
        n,
        highest_first("taxa_media"),
        "co_cnes",
        "nome_estabelecimento",
    )


def highest_now(ocupacao: DataFrame, n: int = 5) -> DataFrame:
    """Names of the hospitals with the highest rate in the newest month."""
    order = [highest_first("taxa_ocupacao"), "co_cnes", "nome_estabelecimento"]
    return first_rows(at_latest(ocupacao), n, *order).select("nome_estabelecimento")


def ranking_board(ocupacao: DataFrame) -> DataFrame:
    """Dashboard ranking of the newest month, with the badge."""
    ranks = gold.run(gold.RATE_RANKS, ocupacao=at_latest(ocupacao))
    lights = gold.latest_lights(ocupacao)
    return lights.join(
        ranks,
        (F.col("mes") == F.col("competencia"))
        & F.col("decimos").eqNullSafe(F.expr(tenths_sql("taxa_ocupacao"))),
    ).select("ranking_no_mes", "co_cnes", "nome_estabelecimento", "taxa_ocupacao", "semaforo")


def trend_feed(ocupacao: DataFrame) -> DataFrame:
    """Dashboard trend line: three-row moving average by hospital and month."""
    return gold.trend(ocupacao).select(
        "co_cnes", "nome_estabelecimento", "competencia", "taxa_ocupacao", "media_movel_3m"
    )
