"""Staged text tables to the typed star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermark.functions import text
from quartermark.operators.dedup import keep_largest_state
from quartermark.operators.enrich import known_only
from quartermark.schemas import MONEY, TOTAL


def typed_expenses(staged: DataFrame) -> DataFrame:
    return staged.select(
        text.zero_pad(F.col("reg_ans"), 6).alias("registro_operadora"),
        "trimestre",
        text.lenient_int(F.col("ano")).alias("ano"),
        text.comma_decimal(F.col("valor_despesas"), MONEY).alias("valor_despesas"),
        text.lenient_bool(F.col("despesas_suspeitas")).alias("suspeita"),
    )


def load_expenses(staged: DataFrame, register: DataFrame) -> DataFrame:
    """Facts: unsuspicious rows of registered operators."""
    trusted = typed_expenses(staged).filter(~F.col("suspeita")).drop("suspeita")
    return known_only(trusted, register)


def facts_of(expenses: DataFrame, register: DataFrame) -> DataFrame:
    """The same from consolidated expenses that are typed already."""
    trusted = expenses.filter(~F.col("DespesasSuspeitas")).select(
        text.zero_pad(F.col("REG_ANS"), 6).alias("registro_operadora"),
        F.col("Trimestre").alias("trimestre"),
        F.col("Ano").alias("ano"),
        F.col("ValorDespesas").alias("valor_despesas"),
    )
    return known_only(trusted, register)


def typed_statistics(staged: DataFrame) -> DataFrame:
    money = [text.comma_decimal(F.col(c), TOTAL).alias(c) for c in ("valor_total", "media_trimestral", "desvio_padrao")]
    return staged.select("razao_social", "uf", *money)


def load_statistics(staged: DataFrame) -> DataFrame:
    """Aggregate table, one row per name."""
    return keep_largest_state(typed_statistics(staged))
