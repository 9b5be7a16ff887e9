"""Expenses joined to the register.

Plain joins: adaptive execution broadcasts a register that turns out small and
splits an operator that holds a large share of the rows. Where an aggregate by
the same key follows, set ``spark.sql.adaptive.forceOptimizeSkewedJoin``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermark.functions import text
from quartermark.schemas import MISSING_CNPJ, MISSING_NAME, MISSING_UF


def with_key(expenses: DataFrame, source: str = "REG_ANS") -> DataFrame:
    """Adds ``reg_key``, null where the text holds no register number."""
    return expenses.withColumn("reg_key", text.matchable_key(text.digits_key(F.col(source))))


def fill_defaults(df: DataFrame) -> DataFrame:
    return df.fillna({"razao_social": MISSING_NAME, "uf": MISSING_UF, "cnpj": MISSING_CNPJ})


def enrich(expenses: DataFrame, register: DataFrame) -> DataFrame:
    """Keeps every expense; those without a register entry get the default texts.

    ``register`` has one row per ``reg_key``, so no expense is repeated.
    """
    return fill_defaults(with_key(expenses).join(register, "reg_key", "left"))


def unmatched(expenses: DataFrame, register: DataFrame) -> DataFrame:
    """Expenses without a register entry."""
    return with_key(expenses).join(register.select("reg_key"), "reg_key", "left_anti")


def known_only(expenses: DataFrame, register: DataFrame) -> DataFrame:
    """Expenses with a register entry, by padded register number."""
    return expenses.join(register.select("registro_operadora"), "registro_operadora", "left_semi")


def operator_history(register: DataFrame, expenses: DataFrame) -> DataFrame:
    """The one-to-many relation as flat rows: each expense next to its operator.

    Flat on purpose: a list per operator would have to fit into one task.
    """
    return expenses.join(register, "registro_operadora")
