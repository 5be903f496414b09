"""Oracle SQL of the ingest, table and pipeline queries: the content, from the source tables."""

from __future__ import annotations

from oracle.analytics import VIEW_PROMPTS
from oracle.fragments import big, dbl, hu, query
from oracle.reports import ADM_COLUMNS, LATEST, RELATIONAL

_BEDS = RELATIONAL["d2_slv_cnes_leitos"]
# Loaded counts are numbers with a fraction.
_COUNTS = ["leitos_existentes", "leitos_sus"] + [
    f"uti_{unit}_{kind}" for unit in ("total", "adulto", "pediatrico", "neonatal") for kind in ("exist", "sus")
]
_LOADED_BEDS = f"SELECT * REPLACE ({', '.join(f'{dbl(c)} AS {c}' for c in _COUNTS)}) FROM ({_BEDS})"
_VOLUME = RELATIONAL["d12_bronze_volume"]
_REASON = """CASE WHEN leitos_sus = 6 THEN 'uf: mais de 2 caracteres'
                                WHEN leitos_sus = 5 AND substr(comp, 6, 1) IN ('2', '4') THEN 'leitos_sus: nao numerico' END"""
_BAD_COUNT = "leitos_sus = 5 AND substr(comp, 6, 1) IN ('2', '4')"

BRONZE = {
    "s1_read_delimited": _LOADED_BEDS,
    "s1_header_map": _LOADED_BEDS,
    "s2_read_report": RELATIONAL["d3_slv_sih_diasperm"],
    "s2_report_months": RELATIONAL["d3_slv_sih_diasperm"],
    "s3_load_once": _VOLUME,
    "s3_read_glob": _VOLUME,
    "s4_pad_short_rows": query(
        f"""SELECT comp, count(*) AS linhas, {dbl("sum(uti_adulto_sus)")} AS uti_adulto_sus,
                   {big("0")} AS com_neonatal
              FROM beds_raw GROUP BY comp""",
        "beds_raw",
    ),
    "s5_rejects": query(
        f"""SELECT motivo, count(*) AS linhas
              FROM (SELECT {_REASON} AS motivo FROM beds_raw)
             WHERE motivo IS NOT NULL GROUP BY motivo""",
        "beds_raw",
    ),
    "s6_load_report": query(
        f"""SELECT lidas, rejeitadas, {big("0")} AS com_excedente, lidas - rejeitadas AS na_tabela
              FROM (SELECT count(*) AS lidas,
                           count(*) FILTER (leitos_sus = 6 OR ({_BAD_COUNT})) AS rejeitadas
                      FROM beds_raw)""",
        "beds_raw",
    ),
    "s6_rejected_rows": query(
        f"""SELECT comp, cnes, CASE WHEN {_BAD_COUNT} THEN 'n/d' ELSE CAST(leitos_sus AS VARCHAR) END AS leitos_sus, motivo
              FROM (SELECT *, {_REASON} AS motivo FROM beds_raw) WHERE motivo IS NOT NULL""",
        "beds_raw",
    ),
    "s7_append_load": _LOADED_BEDS,
    "s7_replace_file": _LOADED_BEDS,
    "s7_reload": _LOADED_BEDS,
    "s7_reload_over_limit": _LOADED_BEDS,
    "s8_fractional_counts": query(
        f"""SELECT co_cnes, competencia, meias / 2 AS leito_dia, {hu("2 * dias_perm", "meias", 1, 100)} AS taxa_ocupacao
              FROM (SELECT s.co_cnes, s.competencia, s.dias_perm,
                           CASE leitos_sus WHEN 4 THEN 9 WHEN 3 THEN 6000000000 ELSE 2 * leitos_sus END
                             * day(last_day(strptime(s.competencia, '%Y%m'))) AS meias
                      FROM stays s JOIN beds b ON b.cnes = s.co_cnes AND b.comp = s.competencia)""",
        "stays",
        "beds",
    ),
    "s9_materialize": _BEDS,
    "s10_view_late_binding": RELATIONAL["d5_gld_ocupacao_mensal"],
    "s12_transcode_files": query(
        f"""SELECT comp, count(*) AS linhas, {dbl("sum(leitos_sus)")} AS leitos_sus,
                   {big("1")} AS arquivos_com_erro
              FROM beds_raw GROUP BY comp""",
        "beds_raw",
    ),
    "s13_month_layout": query(
        f"SELECT {ADM_COLUMNS} FROM adm WHERE {LATEST.format('adm')}", "adm"
    ),
    "s13_hospital_layout": RELATIONAL["d23_trend"],
    "s13_monthly_on_tables": RELATIONAL["d5_gld_ocupacao_mensal"],
    "g1_incremental_ingest": _VOLUME,
    "g1_quarantine": RELATIONAL["d6_gld_features_hospital"],
    "pipeline_clinical_profile": RELATIONAL["d25_clinical_profile"],
    "pipeline_features_view": RELATIONAL["d6_gld_features_hospital"],
    "pipeline_view_prompts": VIEW_PROMPTS,
}
