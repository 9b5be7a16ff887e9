"""The validated report and the statistics that go with it."""

from __future__ import annotations

from pyspark.sql import DataFrame

from quartermark.operators.aggregates import largest_first, operator_statistics
from quartermark.operators.dedup import keep_largest_state
from quartermark.operators.enrich import with_key
from quartermark.operators.quality import flag_register, report


def validated_report(expenses: DataFrame, register: DataFrame) -> DataFrame:
    """Every expense with its operator and three quality flags."""
    flagged = flag_register(register)
    return report(with_key(expenses).join(flagged, "reg_key", "left"))


def ranked_statistics(expenses: DataFrame, register: DataFrame) -> DataFrame:
    return largest_first(operator_statistics(expenses, register))


def gold_statistics(expenses: DataFrame, register: DataFrame) -> DataFrame:
    """What the dashboard reads: one row per name."""
    return keep_largest_state(operator_statistics(expenses, register))
