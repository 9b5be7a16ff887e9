"""Aligned text rows to typed expense rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermark.functions import numbers, periods, text
from quartermark.schemas import CLAIM_KEYWORDS, MONEY


def keep_keywords(df: DataFrame, column: str = "descricao", pattern: str = CLAIM_KEYWORDS) -> DataFrame:
    return df.filter(text.matches_any_keyword(F.col(column), pattern))


def with_period(df: DataFrame, date: str = "data", path: str = "source_file") -> DataFrame:
    """Period from the row's date; rows without a usable date take the folder's."""
    return (
        df.withColumn("_day", periods.parse_date(F.col(date)))
        .withColumn("Ano", F.coalesce(periods.date_year(F.col("_day")), periods.path_year(F.col(path))))
        .withColumn(
            "Trimestre",
            F.coalesce(periods.date_quarter(F.col("_day")), periods.path_quarter(F.col(path))),
        )
        .drop("_day")
    )


def comma_sources(df: DataFrame, source: str = "source_file", value: str = "valor") -> DataFrame:
    """Sources in which at least one value has a comma, one row each.

    Counted per source with map-side partial results: a window over the
    source would put a whole file into one task.
    """
    return (
        df.groupBy(source)
        .agg(F.bool_or(numbers.has_comma(F.col(value))).alias("_comma"))
        .filter("_comma")
    )


def with_locale_value(
    df: DataFrame, source: str = "source_file", value: str = "valor", out: str = "ValorDespesas"
) -> DataFrame:
    """Parses money text with the decimal style of the row's whole source."""
    marked = df.join(comma_sources(df, source, value), source, "left")
    style = F.coalesce(F.col("_comma"), F.lit(False))
    return marked.withColumn(out, numbers.locale_decimal(F.col(value), style, MONEY)).drop("_comma")


def with_suspicion(df: DataFrame, value: str = "ValorDespesas") -> DataFrame:
    return df.withColumn("DespesasSuspeitas", numbers.is_suspicious(F.col(value)))


def consolidated(bronze: DataFrame) -> DataFrame:
    """Keyword-filtered aligned rows to the consolidated expense table."""
    typed = with_suspicion(with_locale_value(with_period(bronze)))
    return typed.select(
        F.col("reg_ans").alias("REG_ANS"),
        "Trimestre",
        "Ano",
        "ValorDespesas",
        "DespesasSuspeitas",
        "source_file",
    )


def rows_per_source(df: DataFrame, source: str = "source_file") -> DataFrame:
    return df.groupBy(source).agg(F.count("*").alias("linhas"))
