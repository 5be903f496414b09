"""Business questions: who is over the limit, idle capacity, seasonality, direction, gap."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlens.functions.decode import CRITICAL
from wardlens.functions.rounding import percent, ratio, tenths_sql
from wardlens.operators.selection import at_latest
from wardlens.plans import gold


def above_limit(ocupacao: DataFrame, limit: int = CRITICAL) -> DataFrame:
    """Hospitals above the critical rate in the newest month."""
    return at_latest(ocupacao).where(F.col("taxa_ocupacao") > limit)


def idle_capacity(ocupacao: DataFrame) -> DataFrame:
    """Bed days not used by hospital over all its months; negative means overbooked."""
    return (
        ocupacao.groupBy("co_cnes")
        .agg(
            F.sum("leito_dia").alias("leito_dia"),
            F.sum("paciente_dia").alias("paciente_dia"),
        )
        .withColumn("capacidade_ociosa", F.expr("leito_dia - paciente_dia"))
    )


def seasonality(ocupacao: DataFrame) -> DataFrame:
    """Mean rate by calendar month."""
    return (
        ocupacao.groupBy(F.substring("competencia", 5, 2).alias("mes"))
        .agg(
            F.count("*").alias("registros"),
            F.sum(F.expr(tenths_sql("taxa_ocupacao"))).alias("soma"),
            F.count("taxa_ocupacao").alias("n"),
        )
        .select("mes", "registros", ratio("soma", "10 * n", 1).alias("taxa_media"))
    )


def direction(ocupacao: DataFrame) -> DataFrame:
    """Whether each hospital of the newest month got better or worse against its previous row."""
    change = F.col("var_vs_mes_anterior")
    return at_latest(gold.trend(ocupacao), of=ocupacao).select(
        "co_cnes",
        "nome_estabelecimento",
        "taxa_ocupacao",
        "var_vs_mes_anterior",
        F.when(change > 0, "PIORANDO")
        .when(change < 0, "MELHORANDO")
        .when(change == 0, "ESTAVEL")
        .alias("direcao"),
    )


def registry_gap(leitos: DataFrame, diasperm: DataFrame) -> DataFrame:
    """Registered and operating hospitals, and the share that never reports a patient day."""
    registered = leitos.select(F.col("cnes").alias("co_cnes")).distinct()
    active = diasperm.select("co_cnes").distinct().withColumn("ativo", F.lit(1))
    return (
        registered.join(active, "co_cnes", "left")
        .agg(F.count("*").alias("cadastrados"), F.count("ativo").alias("ativos"))
        .withColumn("sem_movimento", F.expr("cadastrados - ativos"))
        .withColumn("gap_pct", percent("sem_movimento", "cadastrados", 1))
    )


def without_movement(leitos: DataFrame, diasperm: DataFrame) -> DataFrame:
    """Registered hospital-months with no patient days."""
    return leitos.select(F.col("cnes").alias("co_cnes"), "competencia").distinct().join(
        diasperm, ["co_cnes", "competencia"], "left_anti"
    )
