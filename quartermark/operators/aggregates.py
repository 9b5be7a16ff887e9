"""Quarterly sums and per-operator statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermark.functions.numbers import zero_if_null
from quartermark.operators.enrich import fill_defaults, with_key
from quartermark.operators.quality import with_cnpj_flag, with_name_flag
from quartermark.schemas import MONEY, TOTAL

GROUP = ["razao_social", "uf"]
PERIOD = ["ano", "trimestre"]


def positive_only(df: DataFrame, value: str = "valor") -> DataFrame:
    return df.filter(F.col(value) > 0)


def quarterly_sum(df: DataFrame, keys: Sequence[str] = (*GROUP, *PERIOD), value: str = "valor") -> DataFrame:
    """Sum per group; rows with a null key belong to no group."""
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(F.sum(value).cast(TOTAL).alias("valor"))


def statistics(quarterly: DataFrame) -> DataFrame:
    """Total, mean per quarter and sample deviation; 0 for a single quarter."""
    return quarterly.groupBy(*GROUP).agg(
        F.sum("valor").cast(TOTAL).alias("valor_total"),
        F.round(F.sum("valor") / F.count("valor"), 2).cast(TOTAL).alias("media_trimestral"),
        F.coalesce(F.round(F.stddev_samp(F.col("valor").cast("double")), 2), F.lit(0.0))
        .cast(TOTAL)
        .alias("desvio_padrao"),
    )


def largest_first(stats: DataFrame) -> DataFrame:
    return stats.orderBy(F.desc("valor_total"), "razao_social", "uf")


def register_sums(expenses: DataFrame) -> DataFrame:
    """Positive expenses summed per register key and quarter.

    Sums of decimals are exact, so this first step changes no later total,
    and it leaves at most one row per operator and quarter to be joined:
    an operator with a third of all expenses is no heavier than any other.
    """
    value = zero_if_null(F.col("ValorDespesas").try_cast(MONEY))
    rows = with_key(expenses).select(
        "reg_key", F.col("Ano").alias("ano"), F.col("Trimestre").alias("trimestre"), value.alias("valor")
    )
    return positive_only(rows).groupBy("reg_key", *PERIOD).agg(F.sum("valor").cast(TOTAL).alias("valor"))


def named_sums(expenses: DataFrame, register: DataFrame) -> DataFrame:
    """Register sums with name and state.

    No hint: both sides are already one row per key (and quarter), so Spark
    may broadcast a small register or shuffle a large one without skew.
    """
    columns = register.select("reg_key", "cnpj", *GROUP)
    return fill_defaults(register_sums(expenses).join(columns, "reg_key", "left"))


def operator_statistics(
    expenses: DataFrame, register: DataFrame, exclude_flags: Sequence[str] = ()
) -> DataFrame:
    """Consolidated expenses and register to statistics per name and state.

    ``exclude_flags`` leaves out flagged rows. Rows at or below zero are never
    counted, so only the tax id and name flags can still remove anything.
    """
    named = named_sums(expenses, register)
    if exclude_flags:
        named = with_name_flag(with_cnpj_flag(named)).withColumn("FLAG_VALOR_INVALIDO", F.lit(False))
        for flag in exclude_flags:
            named = named.filter(~F.col(flag))
    return statistics(quarterly_sum(named))


def report_statistics(report: DataFrame) -> DataFrame:
    """The same statistics from an already written report."""
    rows = report.select(
        F.col("Razao_Social").alias("razao_social"),
        F.col("UF").alias("uf"),
        F.col("Ano").alias("ano"),
        F.col("Trimestre").alias("trimestre"),
        zero_if_null(F.col("ValorDespesas").try_cast(MONEY)).alias("valor"),
    )
    return statistics(quarterly_sum(positive_only(rows)))


def statistics_state(quarterly: DataFrame) -> DataFrame:
    """What the statistics of (name, state) need of some quarters: count, sum and squared deviations."""
    value = F.col("valor").cast("double")
    return quarterly.groupBy(*GROUP).agg(
        F.count("valor").alias("n"),
        F.sum("valor").cast(TOTAL).alias("soma"),
        (F.var_pop(value) * F.count("valor")).alias("desvios"),
    )


def merged_state(stored: DataFrame, new: DataFrame) -> DataFrame:
    """The state over the quarters of both; no quarter of a name and state may be in both."""
    a, b = stored.alias("a"), new.alias("b")
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in GROUP]
    joined = a.join(b, same[0] & same[1], "full_outer")
    zero = F.lit(0).cast(TOTAL)
    n1, n2 = (F.coalesce(F.col(f"{s}.n"), F.lit(0)) for s in "ab")
    s1, s2 = (F.coalesce(F.col(f"{s}.soma"), zero) for s in "ab")
    d1, d2 = (F.coalesce(F.col(f"{s}.desvios"), F.lit(0.0)) for s in "ab")
    # The distance of the two means adds to the deviations; a side without rows has none.
    apart = F.coalesce(F.try_divide(s1.cast("double"), n1) - F.try_divide(s2.cast("double"), n2), F.lit(0.0))
    return joined.select(
        *[F.coalesce(F.col(f"a.{c}"), F.col(f"b.{c}")).alias(c) for c in GROUP],
        (n1 + n2).alias("n"),
        (s1 + s2).cast(TOTAL).alias("soma"),
        (d1 + d2 + apart * apart * n1 * n2 / (n1 + n2)).alias("desvios"),
    )


def statistics_of_state(state: DataFrame) -> DataFrame:
    """The same figures as :func:`statistics`, from a stored state."""
    deviation = F.sqrt(F.try_divide(F.col("desvios"), F.col("n") - 1))
    return state.select(
        *GROUP,
        F.col("soma").alias("valor_total"),
        F.round(F.col("soma") / F.col("n"), 2).cast(TOTAL).alias("media_trimestral"),
        F.coalesce(F.round(deviation, 2), F.lit(0.0)).cast(TOTAL).alias("desvio_padrao"),
    )
