"""Silver: typed, cleaned tables of one city."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlens.functions import casts, decode, keys
from wardlens.functions.rounding import percent_sql
from wardlens.operators.reshape import month_columns, unpivot_months
from wardlens.sources.delimited import FILE

CITY = "355030"


# What the admissions' values are made of.
_FILED = """
dt_inter dt_saida dias_perm qt_diarias uti_mes_to val_tot val_uti sexo cod_idade idade morte diag_princ complex
car_int proc_rea
""".split()


def admissions(raw: DataFrame, city: str = CITY) -> DataFrame:
    """`slv_internacao`: one row per admission authorization of the city."""
    return typed_admissions(filed_admissions(raw, city))


def filed_admissions(raw: DataFrame, city: str = CITY) -> DataFrame:
    """The city's admissions under their keys, their values still text as filed."""
    c = F.col
    return raw.where(c("munic_mov") == city).select(
        keys.pad_key(c("cnes")).alias("co_cnes"),
        keys.period_key(c("ano_cmpt"), c("mes_cmpt")).alias("competencia"),
        "n_aih",
        *_FILED,
    )


def typed_admissions(filed: DataFrame) -> DataFrame:
    """`slv_internacao` from `filed_admissions`, row by row."""
    c = F.col
    return filed.select(
        "co_cnes",
        "competencia",
        "n_aih",
        casts.date_or_null(c("dt_inter")).alias("dt_internacao"),
        casts.date_or_null(c("dt_saida")).alias("dt_saida"),
        casts.number_or_null(c("dias_perm")).alias("dias_perm"),
        casts.number_or_null(c("qt_diarias")).alias("qt_diarias"),
        casts.number_or_null(c("uti_mes_to")).alias("diarias_uti"),
        casts.money_or_null(c("val_tot")).alias("val_total"),
        casts.money_or_null(c("val_uti")).alias("val_uti"),
        decode.sex(c("sexo")).alias("sexo"),
        decode.age_in_years(c("cod_idade"), c("idade")).alias("idade_anos"),
        decode.death_flag(c("morte")).alias("fl_obito"),
        c("diag_princ").alias("cid_principal"),
        decode.complexity(c("complex")).alias("complexidade"),
        decode.admission_kind(c("car_int")).alias("carater_internacao"),
        c("proc_rea").alias("procedimento"),
    )


def beds(raw: DataFrame, city: str = CITY) -> DataFrame:
    """`slv_cnes_leitos`: establishment by month, hospital key as filed."""
    return raw.where(F.col("co_ibge") == city).select(
        F.col("comp").alias("competencia"),
        "cnes",
        "nome_estabelecimento",
        "razao_social",
        "tp_gestao",
        "co_tipo_unidade",
        "ds_tipo_unidade",
        "natureza_juridica",
        "desc_natureza_juridica",
        "leitos_existentes",
        "leitos_sus",
        "uti_total_exist",
        "uti_total_sus",
        "uti_adulto_exist",
        "uti_adulto_sus",
        "uti_pediatrico_exist",
        "uti_pediatrico_sus",
        "uti_neonatal_exist",
        "uti_neonatal_sus",
    )


def patient_days(wide: DataFrame) -> DataFrame:
    """`slv_sih_diasperm`: the wide report as hospital by month.

    Label handling and the row filter run once per wide row, before the unpivot multiplies it.
    """
    label = F.col("estab_cidade")
    if "celulas" in wide.columns:
        return _patient_days_of_rows(wide)
    hospitals = wide.where(keys.starts_with_digit(label)).select(
        keys.pad_key(keys.leading_code(label)).alias("co_cnes"),
        keys.name_after_code(label).alias("no_estabelecimento"),
        *month_columns(wide),
    )
    long = unpivot_months(hospitals, ["co_cnes", "no_estabelecimento"], "competencia", "dias")
    return long.where(F.col("dias") != "-").select(
        "co_cnes",
        "no_estabelecimento",
        "competencia",
        casts.strict_number(F.col("dias")).alias("dias_perm"),
    )


def _patient_days_of_rows(report: DataFrame) -> DataFrame:
    """The same from lines that carry their months as an array.

    Where the windows of several files overlap, the report that ends last counts (of equal ends the last
    file name), whatever its cell says: reports are revised, not added up. A month of a label has as
    many rows as there are reports that show it, so the window over them stays small.
    """
    label = F.col("estab_cidade")
    cells = report.where(keys.starts_with_digit(label)).select(
        "estab_cidade",
        F.struct(F.array_max("competencias"), FILE).alias("relatorio"),
        F.explode(F.arrays_zip("competencias", "celulas")).alias("c"),
    )
    cells = cells.select("estab_cidade", "relatorio", "c.competencias", "c.celulas")
    newest = F.max("relatorio").over(Window.partitionBy("estab_cidade", "competencias"))
    valid = cells.withColumn("ultimo", newest).where((F.col("relatorio") == F.col("ultimo")) & (F.col("celulas") != "-"))
    return valid.select(
        keys.pad_key(keys.leading_code(label)).alias("co_cnes"),
        keys.name_after_code(label).alias("no_estabelecimento"),
        F.col("competencias").alias("competencia"),
        casts.strict_number(F.col("celulas")).alias("dias_perm"),
    )


def occupancy(stays: DataFrame, registry: DataFrame, padded_keys: bool = False) -> DataFrame:
    """`slv_ocupacao`: patient days over bed days by hospital and month.

    Both sides grow with the number of hospitals, and either may look small to the planner, which
    does not count the rows that adding or unpivoting months makes of one; broadcast, they would
    pass whole through the driver. So they are always hashed on the two keys and merged, which leaves
    the adaptive skew join free to split a hot hospital-month. Tables bucketed by hospital
    need no exchange here. `padded_keys` pads the registry key as well; off, keys are compared
    as filed. Bed days are whole numbers where the registry's counts are, else decimals.
    """
    fractional = isinstance(registry.schema["leitos_sus"].dataType, T.DecimalType)
    registry_key = keys.pad_key(F.col("cnes")) if padded_keys else F.col("cnes")
    capacity = registry.select(
        registry_key.alias("cnes"),
        F.col("competencia").alias("comp"),
        "nome_estabelecimento",
        "ds_tipo_unidade",
        "leitos_sus",
    )
    days = keys.days_in_period("competencia")
    joined = stays.join(
        capacity.hint("merge"),
        (F.col("co_cnes") == F.col("cnes")) & (F.col("competencia") == F.col("comp")),
    )
    bed_days = f"cast(leitos_sus * {days} as decimal(18,4))" if fractional else f"cast(leitos_sus as bigint) * {days}"
    joined = joined.withColumn("leito_dia", F.expr(bed_days))
    return joined.select(
        "co_cnes",
        "nome_estabelecimento",
        "ds_tipo_unidade",
        "competencia",
        F.col("dias_perm").alias("paciente_dia"),
        "leito_dia",
        F.expr(percent_sql("dias_perm", "leito_dia", 1)).alias("taxa_ocupacao"),
    )
