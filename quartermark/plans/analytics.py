"""The three analytic questions.

All of them sum the facts per operator before any join, so an operator with a
large share of the facts is reduced to a few rows inside each scan task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermark.functions.numbers import growth_percent
from quartermark.operators.periods import end_period, in_period
from quartermark.schemas import TOTAL


def growth_leaders(facts: DataFrame, register: DataFrame, n: int = 5) -> DataFrame:
    """Operators with the largest growth from the first to the last period.

    Only rows of these two periods are read and grouped: the others cannot
    contribute, and operators without positive values in both are left out.
    """
    is_first = in_period(end_period(facts, F.min))
    is_last = in_period(end_period(facts, F.max))
    value = F.col("valor_despesas")
    sums = (
        facts.filter(is_first | is_last)
        .groupBy("registro_operadora")
        .agg(
            F.sum(F.when(is_first, value)).cast(TOTAL).alias("valor_inicial"),
            F.sum(F.when(is_last, value)).cast(TOTAL).alias("valor_final"),
        )
        .filter("valor_inicial > 0 AND valor_final > 0")
    )
    named = sums.join(register.select("registro_operadora", "razao_social"), "registro_operadora")
    return (
        named.withColumn(
            "crescimento_percentual", growth_percent(F.col("valor_inicial"), F.col("valor_final"))
        )
        .orderBy(F.desc("crescimento_percentual"), "razao_social", "registro_operadora")
        .limit(n)
        .select("razao_social", "valor_inicial", "valor_final", "crescimento_percentual")
    )


def state_leaders(facts: DataFrame, register: DataFrame, n: int = 5) -> DataFrame:
    """States by total, with the mean per operator.

    After the first sum there is one row per operator, so counting rows per
    state counts distinct operators.
    """
    sums = facts.groupBy("registro_operadora").agg(F.sum("valor_despesas").cast(TOTAL).alias("total"))
    total, operators = F.sum("total"), F.count("*")
    return (
        sums.join(register.select("registro_operadora", "uf"), "registro_operadora")
        .groupBy("uf")
        .agg(
            total.cast(TOTAL).alias("despesas_totais"),
            operators.alias("qtd_operadoras"),
            F.round(F.try_divide(total, operators), 2).cast(TOTAL).alias("media_por_operadora"),
        )
        .orderBy(F.desc("despesas_totais"), "uf")
        .limit(n)
    )


def above_market(facts: DataFrame, at_least: int = 2) -> DataFrame:
    """How many operators beat the market mean in at least two quarters.

    The means are one row per calendar quarter, which bounds the broadcast; a
    window per quarter would put all operators of a quarter into one task.
    """
    totals = facts.groupBy("ano", "trimestre", "registro_operadora").agg(
        F.sum("valor_despesas").cast(TOTAL).alias("total_operadora")
    )
    means = totals.groupBy("ano", "trimestre").agg(
        F.sum("total_operadora").alias("_sum"), F.count("total_operadora").alias("_n")
    )
    above = (
        totals.join(F.broadcast(means), ["ano", "trimestre"])
        # Compares without the division, so no rounding decides.
        .filter(F.col("total_operadora") * F.col("_n") > F.col("_sum"))
        .groupBy("registro_operadora")
        .agg(F.count("*").alias("trimestres"))
        .filter(F.col("trimestres") >= at_least)
    )
    return above.agg(F.count("*").alias("qtd_operadoras_acima"))
