"""Fixed schemas, accepted header names and default texts."""

from __future__ import annotations

from pyspark.sql import types as T


def all_text(*names: str) -> T.StructType:
    """Schema inference would drop leading zeros, so scans read text only."""
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Accepted headers per canonical column, in order of preference.
HEADER_SYNONYMS = {
    "REG_ANS": ("REG_ANS", "CD_OPERADORA"),
    "DATA": ("DT_REGISTRO", "DATA"),
    "VALOR": ("VL_SALDO_FINAL", "VALOR_SALDO_FINAL", "SALDO_FINAL", "VALOR", "VL_MOVIMENTO"),
    "DESC": ("DESC", "DESCRICAO", "NM_CONTA"),
    "CONTA": ("CD_CONTA_CONTABIL",),
}

# Fixed value: which descriptions count as claim expenses.
CLAIM_KEYWORDS = r"despesas? com eventos?|despesas? com sinistros?|eventos? / sinistros?"

# Texts that stand in for a missing register entry.
MISSING_NAME = "RAZAO SOCIAL NAO LOCALIZADA"
MISSING_UF = "INDETERMINADO"
MISSING_CNPJ = "NAO ENCONTRADO"

# Fixed value: columns of the operator register, in file order.
REGISTER_COLUMNS = (
    "registro_operadora",
    "cnpj",
    "razao_social",
    "nome_fantasia",
    "modalidade",
    "logradouro",
    "numero",
    "complemento",
    "bairro",
    "cidade",
    "uf",
    "cep",
    "ddd",
    "telefone",
    "fax",
    "endereco_eletronico",
    "representante",
    "cargo_representante",
    "regiao_comercializacao",
    "data_registro_ans",
)
STAGED_REGISTER = all_text(*REGISTER_COLUMNS)
STAGED_EXPENSES = all_text("reg_ans", "trimestre", "ano", "valor_despesas", "despesas_suspeitas")
STAGED_STATISTICS = all_text("razao_social", "uf", "valor_total", "media_trimestral", "desvio_padrao")

# Widest text each stored column may hold.
REGISTER_WIDTHS = {
    "registro_operadora": 6,
    "cnpj": 14,
    "bairro": 50,
    "cidade": 50,
    "uf": 2,
    "cep": 8,
    "telefone": 20,
    "fax": 20,
}
EXPENSE_WIDTHS = {"registro_operadora": 6, "trimestre": 2}
REGISTER_REQUIRED = ("registro_operadora", "cnpj", "razao_social")
EXPENSE_REQUIRED = ("registro_operadora", "trimestre", "ano", "valor_despesas")

# Fixed value: columns of the validated report, in file order.
REPORT_COLUMNS = (
    "REG_ANS",
    "CNPJ",
    "Razao_Social",
    "Modalidade",
    "UF",
    "Trimestre",
    "Ano",
    "ValorDespesas",
    "FLAG_CNPJ_INVALIDO",
    "FLAG_RAZAO_SOCIAL_INVALIDA",
    "FLAG_VALOR_INVALIDO",
)

MONEY = T.DecimalType(15, 2)
TOTAL = T.DecimalType(20, 2)

# The consolidated table; its folders name year and quarter.
EXPENSE_TABLE = (
    T.StructType()
    .add("REG_ANS", T.StringType())
    .add("ValorDespesas", MONEY)
    .add("DespesasSuspeitas", T.BooleanType())
    .add("Ano", T.IntegerType())
    .add("Trimestre", T.StringType())
)
FACT_TABLE = (
    T.StructType()
    .add("registro_operadora", T.StringType())
    .add("valor_despesas", MONEY)
    .add("ano", T.IntegerType())
    .add("trimestre", T.StringType())
)
