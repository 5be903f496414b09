"""Declared bronze layouts.

Every layout is a `StructType`. Text fields carry their declared width as metadata; the
loaders turn that width into a reject rule. Nothing is ever inferred from a file.
"""

from __future__ import annotations

from pyspark.sql import types as T

WIDTH = "width"


def text(name: str, width: int) -> T.StructField:
    return T.StructField(name, T.StringType(), True, {WIDTH: width})


def count(name: str) -> T.StructField:
    """A declared number: fractions to four decimals and whatever is too large for an integer are kept."""
    return T.StructField(name, T.DecimalType(18, 4))


def periods(first: str, months: int) -> list[str]:
    """Consecutive YYYYMM labels."""
    start = int(first[:4]) * 12 + int(first[4:]) - 1
    return [f"{m // 12:04d}{m % 12 + 1:02d}" for m in range(start, start + months)]


def month_report(months: list[str], total: bool = True) -> T.StructType:
    """Wide tabulation: one row per hospital, one text column per month."""
    cells = [text(f"m_{p}", 20) for p in months]
    return T.StructType([text("estab_cidade", 300), *cells, *([text("total", 20)] if total else [])])


#: A tabulation line with the months of its own file's header.
MONTH_ROWS = T.StructType(
    [
        text("estab_cidade", 300),
        T.StructField("competencias", T.ArrayType(T.StringType())),
        T.StructField("celulas", T.ArrayType(T.StringType()), True, {WIDTH: 20}),
        text("total", 20),
    ]
)


def stay_report(first: str = "202410", months: int = 20) -> T.StructType:
    """A declared window of months, for reports whose header does not name them."""
    return month_report(periods(first, months))


# Column names and widths of the published bed registry.
BEDS = T.StructType(
    [
        text("comp", 6),
        text("regiao", 20),
        text("uf", 2),
        text("co_ibge", 7),
        text("municipio", 100),
        text("motivo_desabilitacao", 100),
        text("cnes", 7),
        text("nome_estabelecimento", 200),
        text("razao_social", 200),
        text("tp_gestao", 2),
        text("co_tipo_unidade", 5),
        text("ds_tipo_unidade", 100),
        text("natureza_juridica", 10),
        text("desc_natureza_juridica", 100),
        text("no_logradouro", 200),
        text("nu_endereco", 30),
        text("no_complemento", 100),
        text("no_bairro", 100),
        text("co_cep", 10),
        text("nu_telefone", 30),
        text("no_email", 100),
        count("leitos_existentes"),
        count("leitos_sus"),
        *(
            count(f"uti_{unit}_{kind}")
            for unit in ("total", "adulto", "pediatrico", "neonatal", "queimado", "coronariana")
            for kind in ("exist", "sus")
        ),
    ]
)

# The 114 columns of the published admissions layout, in file order.
ADMISSION_COLUMNS = """
uf_zi ano_cmpt mes_cmpt espec cgc_hosp n_aih ident cep munic_res nasc sexo
uti_mes_in uti_mes_an uti_mes_al uti_mes_to marca_uti uti_int_in uti_int_an uti_int_al uti_int_to
diar_acom qt_diarias proc_solic proc_rea
val_sh val_sp val_sadt val_rn val_acomp val_ortp val_sangue val_sadtsr val_transp val_obsang val_ped1ac
val_tot val_uti us_tot dt_inter dt_saida diag_princ diag_secun cobranca natureza nat_jur gestao rubrica
ind_vdrl munic_mov cod_idade idade dias_perm morte nacional num_proc car_int tot_pt_sp cpf_aut homonimo
num_filhos instru cid_notif contracep1 contracep2 gestrisco insc_pn seq_aih5 cbor cnaer vincprev
gestor_cod gestor_tp gestor_cpf gestor_dt cnes cnpj_mant infehosp cid_asso cid_morte complex financ
faec_tp regct raca_cor etnia sequencia remessa aud_just sis_just
val_sh_fed val_sp_fed val_sh_ges val_sp_ges val_uci marca_uci
diagsec1 diagsec2 diagsec3 diagsec4 diagsec5 diagsec6 diagsec7 diagsec8 diagsec9
tpdisec1 tpdisec2 tpdisec3 tpdisec4 tpdisec5 tpdisec6 tpdisec7 tpdisec8 tpdisec9 fonte_orc
""".split()
# Every admissions column is 15 wide but these.
ADMISSION_WIDTHS = {
    "cgc_hosp": 20,
    "n_aih": 20,
    "num_proc": 20,
    "cpf_aut": 20,
    "gestor_cpf": 20,
    "cnpj_mant": 20,
    "remessa": 30,
    "aud_just": 100,
    "sis_just": 100,
}
ADMISSIONS = T.StructType([text(c, ADMISSION_WIDTHS.get(c, 15)) for c in ADMISSION_COLUMNS])

# Disease dictionary layouts.
DISEASE_CODES = T.StructType(
    [
        text("subcat", 4),
        text("classif", 5),
        text("restrsexo", 5),
        text("causaobito", 5),
        text("descricao", 400),
        text("descrabrev", 120),
        text("refer", 60),
        text("excluidos", 400),
    ]
)
DISEASE_CHAPTERS = T.StructType(
    [
        text("numcap", 4),
        text("catinic", 3),
        text("catfim", 3),
        text("descricao", 400),
        text("descrabrev", 120),
    ]
)


def as_text(schema: T.StructType) -> T.StructType:
    """The same layout with every field read as text, before type checks."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
