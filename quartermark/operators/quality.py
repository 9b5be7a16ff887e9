"""Row-level quality flags (true means failed) and the validated report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermark.functions import taxid
from quartermark.functions.numbers import zero_if_null
from quartermark.operators.enrich import fill_defaults
from quartermark.schemas import MONEY, REPORT_COLUMNS


def with_cnpj_check(df: DataFrame, column: str = "cnpj", out: str = "cnpj_valido") -> DataFrame:
    return (
        df.withColumn("_clean", taxid.clean_cnpj(F.col(column)))
        .withColumn(out, taxid.cnpj_is_valid("_clean"))
        .drop("_clean")
    )


def with_cnpj_flag(df: DataFrame) -> DataFrame:
    checked = with_cnpj_check(df, "cnpj", "_valid")
    default = F.coalesce(F.contains(F.col("cnpj"), F.lit("NAO")), F.lit(False))
    return checked.withColumn("FLAG_CNPJ_INVALIDO", default | ~F.col("_valid")).drop("_valid")


def with_name_flag(df: DataFrame) -> DataFrame:
    name = F.col("razao_social")
    bad = ~name.rlike(r"\S") | F.contains(name, F.lit("NAO LOCALIZADA"))
    return df.withColumn("FLAG_RAZAO_SOCIAL_INVALIDA", F.coalesce(bad, F.lit(False)))


def with_value_flag(df: DataFrame) -> DataFrame:
    """An existing flag is only cast; otherwise unreadable values count as zero."""
    if "FLAG_VALOR_INVALIDO" in df.columns:
        return df.withColumn("FLAG_VALOR_INVALIDO", F.col("FLAG_VALOR_INVALIDO").cast("boolean"))
    value = zero_if_null(F.col("ValorDespesas").try_cast(MONEY))
    return df.withColumn("ValorDespesas", value).withColumn("FLAG_VALOR_INVALIDO", F.col("ValorDespesas") <= 0)


def with_flags(df: DataFrame) -> DataFrame:
    return with_value_flag(with_name_flag(with_cnpj_flag(df)))


def flag_register(register: DataFrame) -> DataFrame:
    """Register with default texts and both flags that depend on nothing else.

    Flagging the register costs one check per operator instead of one per
    expense.
    """
    return with_name_flag(with_cnpj_flag(fill_defaults(register)))


def report(enriched: DataFrame) -> DataFrame:
    """The 11 report columns.

    Flags the input already has are kept; the default texts of an unmatched
    expense fail both checks. A column the input lacks becomes null.
    """
    named = fill_defaults(enriched)
    if "FLAG_CNPJ_INVALIDO" in named.columns:
        named = with_value_flag(named.fillna(True, ["FLAG_CNPJ_INVALIDO", "FLAG_RAZAO_SOCIAL_INVALIDA"]))
    else:
        named = with_flags(named)
    named = named.withColumn("REG_ANS", F.coalesce(F.col("reg_key"), F.lit(0).cast("bigint")))
    named = named.withColumnsRenamed(
        {"cnpj": "CNPJ", "razao_social": "Razao_Social", "modalidade": "Modalidade", "uf": "UF"}
    )
    return named.select(
        *[F.col(c) if c in named.columns else F.lit(None).cast("string").alias(c) for c in REPORT_COLUMNS]
    )
