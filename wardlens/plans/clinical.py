"""Disease dictionary and clinical profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlens.functions.keys import category

# Upper bounds (exclusive, in years) and labels of the age bands; our choice.
AGE_BANDS = [
    (5, "00-04"),
    (15, "05-14"),
    (30, "15-29"),
    (45, "30-44"),
    (60, "45-59"),
    (75, "60-74"),
]
OLDEST = "75+"
UNKNOWN_AGE = "IGN"


def age_band(age: Column) -> Column:
    chain = F.when(age.isNull(), UNKNOWN_AGE)
    for limit, label in AGE_BANDS:
        chain = chain.when(age < limit, label)
    return chain.otherwise(OLDEST)


def disease_dimension(codes: DataFrame, chapters: DataFrame) -> DataFrame:
    """`dim_cid`: code, description and chapter, by category BETWEEN chapter bounds.

    The range condition alone would be a nested-loop join. A category inside a range has a
    first letter inside the letters the range spans, so chapters are listed once per letter
    and the join becomes a hash join on the letter with the range as a residual filter.
    """
    by_letter = chapters.select(
        F.explode(F.sequence(F.ascii("catinic"), F.ascii("catfim"))).alias("letra"),
        "numcap",
        "catinic",
        "catfim",
        F.col("descricao").alias("ds_capitulo"),
    )
    code = category(F.col("subcat"))
    return (
        codes.withColumn("letra", F.ascii("subcat"))
        .join(by_letter, "letra")
        .where(code.between(F.col("catinic"), F.col("catfim")))
        .select(
            F.col("subcat").alias("codigo"),
            "descricao",
            F.col("numcap").alias("capitulo"),
            "ds_capitulo",
        )
    )


def chapter_lookup(dimension: DataFrame) -> DataFrame:
    """Chapter by full code, and by category for diagnoses filed with three characters."""
    full = dimension.select("codigo", "capitulo")
    short = (
        dimension.where(F.length("codigo") > 3)
        .groupBy(category(F.col("codigo")).alias("codigo"))
        .agg(F.min("capitulo").alias("capitulo"))
    )
    return full.unionByName(short).groupBy("codigo").agg(F.min("capitulo").alias("capitulo"))


def clinical_profile(internacao: DataFrame, dimension: DataFrame) -> DataFrame:
    """`gld_perfil_clinico`: admissions, patient days and deaths by age band and chapter.

    Admissions are folded to one row per band and code before the lookup, so the join moves
    code counts instead of admissions. Codes without a chapter stay, under a NULL chapter.
    """
    folded = internacao.groupBy(
        age_band(F.col("idade_anos")).alias("faixa_etaria"), "cid_principal"
    ).agg(
        F.count("*").alias("internacoes"),
        F.sum("dias_perm").alias("paciente_dia"),
        F.sum("fl_obito").alias("obitos"),
    )
    lookup = chapter_lookup(dimension)
    return (
        folded.join(lookup, F.col("cid_principal") == F.col("codigo"), "left")
        .groupBy("faixa_etaria", "capitulo")
        .agg(
            F.sum("internacoes").alias("internacoes"),
            F.sum("paciente_dia").alias("paciente_dia"),
            F.sum("obitos").alias("obitos"),
        )
    )
