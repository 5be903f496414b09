"""Oracle SQL of the peer and natural-language queries."""

from __future__ import annotations

import re

from oracle.fragments import LIGHT, query

# The bands the prompt tells of are those the rate in tenths is held against.
_RED, _YELLOW = (int(n) // 10 for n in re.findall(r"decimos >=? (\d+)", LIGHT))

SIZE = """CASE WHEN leitos_sus IS NULL THEN NULL WHEN leitos_sus <= 3 THEN 'PEQUENO'
 WHEN leitos_sus <= 6 THEN 'MEDIO' WHEN leitos_sus <= 9 THEN 'GRANDE' ELSE 'ESPECIAL' END"""
_HOSPITALS = f"(SELECT DISTINCT ON (co_cnes) *, {SIZE} AS porte FROM feat)"
_FACTORS = {
    "volume": "total_aihs",
    "permanencia": "perm_media",
    "gravidade": "tx_mortalidade",
    "complexidade": "pct_alta_complex",
}
_HUNDREDTHS = ", ".join(
    f"CAST(round({c} * 100) AS HUGEINT) AS x_{f}" for f, c in _FACTORS.items()
)


def _z(factor: str, group: str = "porte") -> str:
    x, w = f"x_{factor}", f"OVER (PARTITION BY {group})"
    n = f"count({x}) {w}"
    spread = f"CAST({n} * sum({x} * {x}) {w} - sum({x}) {w} * sum({x}) {w} AS DOUBLE)"
    width = f"sqrt(CAST({n} AS DOUBLE) * {spread} / nullif({n} - 1, 0))"
    return f"""floor(CAST({n} * {x} - sum({x}) {w} AS DOUBLE) / nullif({width}, 0) * 10000 + 0.5)
      / 10000 AS z_{factor}"""


_Z = [f"z_{f}" for f in _FACTORS]
_ENTRIES = ", ".join(
    f"CAST(floor(CAST(embedding[{k}] AS DOUBLE) * 1000) * 100 AS HUGEINT) AS x_{f}" for k, f in enumerate(_FACTORS, 1)
)
_LARGEST = f"greatest({', '.join(_Z)})"
_DOMINANT = "CASE " + " ".join(f"WHEN z_{f} = {_LARGEST} THEN '{f}'" for f in _FACTORS) + " END"


def _view(name: str, columns: list[tuple[str, str, str]]) -> str:
    told = "; ".join(f"{column} {kind} ({meaning})" for column, kind, meaning in columns)
    return f"View {name}: {told}. ".replace("'", "''")


_HOSPITAL = [
    ("co_cnes", "string", "hospital code, 7 digits with leading zeros"),
    ("nome_estabelecimento", "string", "hospital name"),
]
_MONTHLY_VIEW = _view(
    "gld_ocupacao_mensal",
    [
        *_HOSPITAL,
        ("ds_tipo_unidade", "string", "kind of unit"),
        ("competencia", "string", "month as text YYYYMM"),
        ("paciente_dia", "decimal(18,4)", "patient days of the month"),
        ("leito_dia", "bigint", "available bed days of the month"),
        ("taxa_ocupacao", "decimal(18,1)", "occupancy in percent, may exceed 100, NULL without beds"),
        ("semaforo", "string", f"light: CRITICO above {_RED} %, ATENCAO from {_YELLOW} %, else OK"),
        ("var_vs_mes_anterior", "decimal(18,1)", "percentage points against the hospital's previous month"),
        ("media_movel_3m", "decimal(18,1)", "mean occupancy of its last three months, in percent"),
        ("ranking_no_mes", "bigint", "place within the month, 1 is the fullest"),
    ],
)
_FEATURES_VIEW = _view(
    "gld_features_hospital",
    [
        *_HOSPITAL,
        ("tipo_unidade", "string", "kind of unit"),
        ("leitos_sus", "bigint", "public beds, mean of its months"),
        ("leitos_uti_sus", "bigint", "public intensive-care beds, mean of its months"),
        ("taxa_media", "decimal(18,1)", "mean monthly occupancy in percent"),
        ("taxa_max", "decimal(18,1)", "highest monthly occupancy in percent"),
        ("taxa_desvio", "decimal(18,1)", "standard deviation of monthly occupancy"),
        ("meses_com_dado", "bigint", "months known"),
        ("perm_media", "decimal(18,1)", "mean stay in days"),
        ("pct_diarias_uti", "decimal(18,1)", "percent of days in intensive care"),
        ("pct_urgencia", "decimal(18,1)", "percent of admissions that were urgent"),
        ("pct_alta_complex", "decimal(18,1)", "percent of admissions of high complexity"),
        ("tx_mortalidade", "decimal(18,2)", "percent of admissions that ended in death"),
        ("idade_media", "decimal(18,1)", "mean age of patients in years"),
        ("total_aihs", "bigint", "admissions"),
    ],
)


def _prompt(views: str) -> str:
    return (
        "SELECT conv_id, turn, 'You translate questions about hospital beds into one Spark SQL SELECT. "
        f"{views}Reply with that statement alone. Compare months as text; the newest is max(competencia). "
        "Question: ' || text AS prompt FROM conversations WHERE role = 'user'"
    )


_PROMPT = _prompt(_MONTHLY_VIEW)
VIEW_PROMPTS = _prompt(_MONTHLY_VIEW + _FEATURES_VIEW)
_MEASURES = (
    "leitos_sus leitos_uti_sus taxa_media taxa_max taxa_desvio perm_media pct_diarias_uti pct_urgencia "
    "pct_alta_complex tx_mortalidade idade_media total_aihs"
).split()
_FILLED = ", ".join(
    f"coalesce(CAST({c} AS DOUBLE), (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.5) FROM {_HOSPITALS}), 0) AS {c}"
    for c in _MEASURES
)
_SCALED = ", ".join(
    f"round(CASE WHEN stddev_samp({c}) OVER () > 0 THEN ({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER () "
    f"ELSE 0 END, 6) AS {c}"
    for c in _MEASURES
)

ANALYTICS = {
    "m2_scaled_features": query(
        f"SELECT co_cnes, {_SCALED} FROM (SELECT co_cnes, {_FILLED} FROM {_HOSPITALS})", "feat"
    ),
    "m4_assignment_check": query(
        f"""SELECT count(*) AS hospitais, CAST(0 AS BIGINT) AS longe_do_centro, CAST(0 AS BIGINT) AS primeiro
              FROM {_HOSPITALS}""",
        "feat",
    ),
    "m3_cost_check": query(
        f"""SELECT hospitais, least(10, hospitais) - 1 AS fits, CAST(0 AS BIGINT) AS custo_diferente, CAST(0 AS BIGINT) AS custo_sobe
              FROM (SELECT count(*) AS hospitais FROM {_HOSPITALS})""",
        "feat",
    ),
    "d26_factors_by_label": f"""SELECT co_cnes, label, {", ".join(_Z)}, {_DOMINANT} AS fator_dominante
              FROM (SELECT co_cnes, CAST(label AS BIGINT) AS label, {", ".join(_z(f, "label") for f in _FACTORS)}
                      FROM (SELECT CAST(vec_id AS VARCHAR) AS co_cnes, label, {_ENTRIES} FROM embeddings))""",
    "m5_zscores_by_size": query(
        f"""SELECT co_cnes, porte, {", ".join(_Z)}, {_DOMINANT} AS fator_dominante
              FROM (SELECT co_cnes, porte, {", ".join(_z(f) for f in _FACTORS)}
                      FROM (SELECT co_cnes, porte, {_HUNDREDTHS} FROM {_HOSPITALS}))""",
        "feat",
    ),
    "m6_size_groups": query(f"SELECT co_cnes, leitos_sus, porte FROM {_HOSPITALS}", "feat"),
    "x20_request_body": _PROMPT,
    "x21_answer_text": """SELECT conv_id, turn, CASE WHEN role = 'assistant' THEN text END AS texto
                            FROM conversations""",
    "x22_prompts": _PROMPT,
}
