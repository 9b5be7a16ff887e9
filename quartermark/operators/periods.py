"""Periods of a fact table: first, last and newest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quartermark.functions.periods import period_key


def periods(facts: DataFrame) -> DataFrame:
    """One row per period.

    The count keeps this a hash aggregate with a handful of rows per task; a
    plain ``distinct`` below ``min`` is optimised away, and then every fact
    row goes through the text comparison.
    """
    counted = facts.groupBy("ano", "trimestre").agg(F.count("*").alias("linhas"))
    return counted.filter("linhas > 0 AND ano IS NOT NULL AND trimestre IS NOT NULL")


def end_period(facts: DataFrame, pick) -> Column:
    """First (``F.min``) or last (``F.max``) period as a scalar with ``ano`` and ``trimestre``."""
    key = period_key(F.col("ano"), F.col("trimestre"))
    return periods(facts).agg(pick(F.struct(key.alias("periodo"), "ano", "trimestre")).alias("p")).scalar()


def in_period(period: Column) -> Column:
    """Compares the two stored columns, so that a table partitioned by them is pruned."""
    return (F.col("ano") == period["ano"]) & (F.col("trimestre") == period["trimestre"])


def newest_periods(facts: DataFrame, n: int = 3) -> DataFrame:
    newest_first = periods(facts).orderBy(F.desc("ano"), F.desc("trimestre"))
    return newest_first.limit(n).select("ano", "trimestre")


def latest_only(facts: DataFrame, n: int = 3) -> DataFrame:
    """Rows of the ``n`` newest periods: a filter, so no join and no shuffle of rows.

    Rows without a year or a quarter belong to no period.
    """
    oldest = newest_periods(facts, n).agg(F.min(F.struct("ano", "trimestre")).alias("p")).scalar()
    same_year = (F.col("ano") == oldest["ano"]) & (F.col("trimestre") >= oldest["trimestre"])
    known = F.col("ano").isNotNull() & F.col("trimestre").isNotNull()
    return facts.filter(known & ((F.col("ano") > oldest["ano"]) | same_year))
