"""Operator register: staged text to the typed dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quartermark.functions import text
from quartermark.operators.dedup import keep_first
from quartermark.schemas import REGISTER_COLUMNS


def typed_columns(wanted: Sequence[str]) -> list[Column]:
    """Typed projection of staged register columns."""
    rules = {
        "registro_operadora": lambda c: text.zero_pad(c, 6),
        "cnpj": lambda c: text.zero_pad(c, 14),
        "cep": lambda c: text.zero_pad(c, 8),
        "ddd": text.lenient_int,
        "regiao_comercializacao": text.lenient_int,
        "data_registro_ans": text.lenient_date,
    }
    return [rules.get(name, lambda c: c)(F.col(name)).alias(name) for name in wanted]


def typed_register(
    staged: DataFrame, order: Sequence[str], columns: Sequence[str] = REGISTER_COLUMNS
) -> DataFrame:
    """The dimension: typed, and per register number only the first row in ``order``.

    Name just the columns a query reads; the rest then never leaves the scan.
    """
    wanted = ["registro_operadora", *[c for c in columns if c != "registro_operadora"]]
    typed = staged.select(*typed_columns(wanted), F.struct(*order).alias("_order"))
    return keep_first(typed, ["registro_operadora"], [F.col("_order")], wanted).select(*columns)


def keyed_register(aligned: DataFrame, order: Sequence[str], key: str = "registro_operadora") -> DataFrame:
    """The register for the report: integer key ``reg_key``, first row per key.

    ``key`` chooses what counts as a duplicate before the join key is made
    unique: the register number itself (default), or for instance the tax id.
    """
    keyed = aligned.withColumn("reg_key", text.digits_key(F.col("registro_operadora")))
    if key != "registro_operadora":
        keyed = keep_first(keyed, [key], [F.col(c) for c in order])
    columns = ["reg_key", "cnpj", "razao_social", "modalidade", "uf"]
    return keep_first(keyed.filter("reg_key <> 0"), ["reg_key"], [F.col(c) for c in order], columns)
