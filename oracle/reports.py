"""Oracle SQL by query key."""

from __future__ import annotations

from oracle.fragments import LIGHT, RATE, big, dbl, hu, query

ADM_COLUMNS = f"""co_cnes, competencia, n_aih, dt_internacao, dt_saida, {dbl("dias_perm")} AS dias_perm,
 {dbl("qt_diarias")} AS qt_diarias, {dbl("diarias_uti")} AS diarias_uti, {dbl("val_total")} AS val_total,
 {dbl("val_uti")} AS val_uti, sexo, {dbl("idade_c")} / 100 AS idade_anos, {big("fl_obito")} AS fl_obito,
 cid_principal, complexidade, carater_internacao, procedimento"""
BED_COLUMNS = """comp AS competencia, cnes, nome_estabelecimento, razao_social, tp_gestao, co_tipo_unidade,
 ds_tipo_unidade, natureza_juridica, desc_natureza_juridica, leitos_existentes, leitos_sus, uti_total_exist,
 uti_total_sus, uti_adulto_exist, uti_adulto_sus, uti_pediatrico_exist, uti_pediatrico_sus,
 uti_neonatal_exist, uti_neonatal_sus"""
OCC_COLUMNS = f"""co_cnes, nome_estabelecimento, ds_tipo_unidade, competencia,
 {dbl("dias_perm")} AS paciente_dia, {big("leito_dia")} AS leito_dia, {RATE} AS taxa_ocupacao"""
GOLD_COLUMNS = f"""{OCC_COLUMNS}, semaforo, {dbl("var_decimos")} / 10 AS var_vs_mes_anterior,
 media_movel_3m, {big("ranking_no_mes")} AS ranking_no_mes"""
FEATURE_COLUMNS = f"""co_cnes, nome_estabelecimento, tipo_unidade, leitos_sus, leitos_uti_sus, taxa_media,
 taxa_max, taxa_desvio, {big("meses_com_dado")} AS meses_com_dado, perm_media, pct_diarias_uti,
 pct_urgencia, pct_alta_complex, tx_mortalidade, idade_media, {big("total_aihs")} AS total_aihs"""
LATEST = "competencia = (SELECT max(competencia) FROM {})"
PERM = hu("sum(dias_perm)", "count(dias_perm)", 1)

RELATIONAL = {
    "d1_slv_internacao": query(f"SELECT {ADM_COLUMNS} FROM adm", "adm"),
    "d2_slv_cnes_leitos": query(f"SELECT {BED_COLUMNS} FROM beds", "beds"),
    "d3_slv_sih_diasperm": query(
        f"SELECT co_cnes, no_estabelecimento, competencia, {dbl('dias_perm')} AS dias_perm FROM stays",
        "stays",
    ),
    "d4_slv_ocupacao": query(f"SELECT {OCC_COLUMNS} FROM occ", "occ"),
    "d5_gld_ocupacao_mensal": query(f"SELECT {GOLD_COLUMNS} FROM gld", "gld"),
    "d6_gld_features_hospital": query(f"SELECT {FEATURE_COLUMNS} FROM feat", "feat"),
    "d6_features_single_name": query(
        f"""SELECT {FEATURE_COLUMNS} FROM feat f
             WHERE nome_estabelecimento = (SELECT arg_max(nome_estabelecimento, competencia)
                                             FROM occ WHERE occ.co_cnes = f.co_cnes)""",
        "feat",
    ),
    "d7_admissions_by_month": query(
        f"""SELECT competencia, count(*) AS aihs, {dbl("sum(dias_perm)")} AS paciente_dia,
                   {PERM} AS perm_media, {big("sum(fl_obito)")} AS obitos
              FROM adm GROUP BY competencia""",
        "adm",
    ),
    "d8_reconciliation": query(
        f"""SELECT r.competencia, {dbl("pd_rd")} AS pd_rd, {dbl("pd_tabnet")} AS pd_tabnet,
                   {hu("pd_rd - pd_tabnet", "pd_tabnet", 1, 100)} AS dif_pct
              FROM (SELECT competencia, sum(dias_perm) AS pd_rd FROM adm GROUP BY 1) r
              JOIN (SELECT competencia, sum(dias_perm) AS pd_tabnet FROM stays GROUP BY 1) t
                ON t.competencia = r.competencia""",
        "adm",
        "stays",
    ),
    "d9_lights_now": query(
        f"""SELECT semaforo, count(*) AS hospitais FROM gld
             WHERE {LATEST.format("gld")} GROUP BY semaforo""",
        "gld",
    ),
    "d10_top_critical": query(
        f"""SELECT {big("ranking_no_mes")} AS ranking_no_mes, nome_estabelecimento, {RATE} AS taxa_ocupacao,
                   {dbl("var_decimos")} / 10 AS var_vs_mes_anterior, media_movel_3m
              FROM gld WHERE {LATEST.format("gld")}
             ORDER BY ranking_no_mes, co_cnes, nome_estabelecimento LIMIT 10""",
        "gld",
    ),
    "d11_features_sample": query(
        """SELECT co_cnes, nome_estabelecimento, leitos_sus, taxa_media, perm_media, pct_urgencia,
                  pct_alta_complex
             FROM feat ORDER BY taxa_media DESC NULLS FIRST, co_cnes, nome_estabelecimento LIMIT 5""",
        "feat",
    ),
    "d12_bronze_volume": query(
        f"""SELECT ano_cmpt, mes_cmpt, count(*) AS aihs_estado,
                   {big("sum(CASE WHEN munic_mov = '355030' THEN 1 END)")} AS aihs_capital
              FROM adm_raw GROUP BY ano_cmpt, mes_cmpt""",
        "adm_raw",
    ),
    "d13_dictionary_counts": query(
        """SELECT (SELECT count(*) FROM cid_sub) AS subcategorias,
                  (SELECT count(*) FROM cid_cap) AS capitulos""",
        "dim_cid",
    ),
    "d14_admissions_sample": query(
        f"""SELECT {ADM_COLUMNS} FROM adm
             ORDER BY adm.competencia, adm.co_cnes, adm.n_aih, adm.procedimento, adm.val_total LIMIT 20""",
        "adm",
    ),
    "d15_admissions_by_complexity": query(
        f"""SELECT competencia, complexidade, count(*) AS qtd_internacoes,
                   {dbl("sum(dias_perm)")} AS paciente_dia, {PERM} AS permanencia_media,
                   {big("sum(fl_obito)")} AS obitos
              FROM adm GROUP BY competencia, complexidade""",
        "adm",
    ),
    "d16_beds_sample": query(
        """SELECT comp AS competencia, cnes, nome_estabelecimento, razao_social, tp_gestao, ds_tipo_unidade,
                  natureza_juridica, desc_natureza_juridica, leitos_existentes, leitos_sus,
                  uti_total_exist, uti_total_sus
             FROM beds ORDER BY comp, cnes, nome_estabelecimento LIMIT 20""",
        "beds",
    ),
    "d17_beds_by_unit_type": query(
        f"""SELECT ds_tipo_unidade, count(DISTINCT cnes) AS qtd_hospitais,
                   {big("sum(leitos_sus)")} AS total_leitos_sus, {big("sum(uti_total_sus)")} AS total_uti_sus
              FROM beds GROUP BY ds_tipo_unidade""",
        "beds",
    ),
    "d18_patient_days_sample": query(
        f"""SELECT co_cnes, no_estabelecimento, competencia, {dbl("dias_perm")} AS dias_perm
              FROM stays ORDER BY competencia, co_cnes, no_estabelecimento, stays.dias_perm LIMIT 20""",
        "stays",
    ),
    "d19_patient_days_by_month": query(
        f"""SELECT competencia, count(DISTINCT co_cnes) AS qtd_hospitais,
                   {dbl("sum(dias_perm)")} AS total_paciente_dia, {PERM} AS media_por_hospital
              FROM stays GROUP BY competencia""",
        "stays",
    ),
    "d20_occupancy_sample": query(
        f"""SELECT {OCC_COLUMNS} FROM occ
             ORDER BY competencia, decimos DESC NULLS FIRST, co_cnes, nome_estabelecimento LIMIT 20""",
        "occ",
    ),
    "d21_occupancy_by_unit_type": query(
        f"""SELECT ds_tipo_unidade, count(*) AS qtd_registros,
                   {hu("sum(decimos)", "10 * count(decimos)", 1)} AS taxa_media,
                   {dbl("min(decimos)")} / 10 AS taxa_min, {dbl("max(decimos)")} / 10 AS taxa_max
              FROM occ GROUP BY ds_tipo_unidade""",
        "occ",
    ),
    "d22_highest_now": query(
        f"""SELECT nome_estabelecimento FROM gld WHERE {LATEST.format("gld")}
             ORDER BY decimos DESC NULLS FIRST, co_cnes, nome_estabelecimento LIMIT 5""",
        "gld",
    ),
    "d23_dashboard_kpis": query(
        f"""SELECT semaforo, count(*) AS hospitais FROM gld
             WHERE {LATEST.format("gld")} GROUP BY semaforo""",
        "gld",
    ),
    "d23_light_bands": query(
        f"""SELECT faixa, count(semaforo) AS hospitais
              FROM (VALUES ('CRITICO'), ('ATENCAO'), ('OK')) b(faixa)
              LEFT JOIN (SELECT semaforo FROM gld WHERE {LATEST.format("gld")}) ON semaforo = faixa
             GROUP BY faixa
            UNION ALL
            SELECT 'ACIMA DE 100', count(*) FILTER (decimos > 1000) FROM gld WHERE {LATEST.format("gld")}""",
        "gld",
    ),
    "d23_ranking_board": query(
        f"""SELECT {big("ranking_no_mes")} AS ranking_no_mes, co_cnes, nome_estabelecimento,
                   {RATE} AS taxa_ocupacao, semaforo
              FROM gld WHERE {LATEST.format("gld")}""",
        "gld",
    ),
    "d23_trend": query(
        f"""SELECT co_cnes, nome_estabelecimento, competencia, {RATE} AS taxa_ocupacao, media_movel_3m
              FROM gld""",
        "gld",
    ),
    "d24_dim_cid": query("SELECT * FROM dim_cid", "dim_cid"),
    "d25_clinical_profile": query(
        f"""SELECT CASE WHEN idade_c IS NULL THEN 'IGN' WHEN idade_c < 500 THEN '00-04'
                        WHEN idade_c < 1500 THEN '05-14' WHEN idade_c < 3000 THEN '15-29'
                        WHEN idade_c < 4500 THEN '30-44' WHEN idade_c < 6000 THEN '45-59'
                        WHEN idade_c < 7500 THEN '60-74' ELSE '75+' END AS faixa_etaria,
                   capitulo, count(*) AS internacoes, {dbl("sum(dias_perm)")} AS paciente_dia,
                   {big("sum(fl_obito)")} AS obitos
              FROM adm LEFT JOIN dim_cid ON codigo = cid_principal GROUP BY 1, 2""",
        "adm",
        "dim_cid",
    ),
    "d27_gap": query(
        f"""SELECT cadastrados, ativos, cadastrados - ativos AS sem_movimento,
                   {hu("cadastrados - ativos", "cadastrados", 1, 100)} AS gap_pct
              FROM (SELECT count(DISTINCT b.cnes) AS cadastrados, count(DISTINCT s.co_cnes) AS ativos
                      FROM beds b LEFT JOIN stays s ON s.co_cnes = b.cnes)""",
        "beds",
        "stays",
    ),
    "d27_without_movement": query(
        """SELECT DISTINCT cnes AS co_cnes, comp AS competencia FROM beds b
            WHERE NOT EXISTS (SELECT 1 FROM stays s WHERE s.co_cnes = b.cnes AND s.competencia = b.comp)""",
        "beds",
        "stays",
    ),
    "d27_idle_capacity": query(
        f"""SELECT co_cnes, {big("sum(leito_dia)")} AS leito_dia, {dbl("sum(dias_perm)")} AS paciente_dia,
                   {dbl("sum(leito_dia - dias_perm)")} AS capacidade_ociosa FROM occ GROUP BY co_cnes""",
        "occ",
    ),
    "d27_seasonality": query(
        f"""SELECT substr(competencia, 5, 2) AS mes, count(*) AS registros,
                   {hu("sum(decimos)", "10 * count(decimos)", 1)} AS taxa_media
              FROM occ GROUP BY 1""",
        "occ",
    ),
    "d27_direction": query(
        f"""SELECT co_cnes, nome_estabelecimento, {RATE} AS taxa_ocupacao,
                   {dbl("var_decimos")} / 10 AS var_vs_mes_anterior,
                   CASE sign(var_decimos) WHEN 1 THEN 'PIORANDO' WHEN -1 THEN 'MELHORANDO'
                        WHEN 0 THEN 'ESTAVEL' END AS direcao
              FROM gld WHERE {LATEST.format("gld")}""",
        "gld",
    ),
    "d27_above_85": query(
        f"SELECT {OCC_COLUMNS} FROM occ WHERE {LATEST.format('occ')} AND decimos > 850", "occ"
    ),
    "j5_padded_registry_key": query(f"SELECT {OCC_COLUMNS} FROM occ", "occ"),
}
