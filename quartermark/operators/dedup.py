"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_first(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], columns: Sequence[str] | None = None
) -> DataFrame:
    """The first row per key in ``order``, with the named columns (default: all).

    An aggregate, not ``row_number``: each task reduces its rows to one per
    key before the shuffle, so copies of one key never meet in one task.
    ``dropDuplicates`` would keep an arbitrary row.
    """
    columns = df.columns if columns is None else columns
    others = [c for c in columns if c not in keys]
    if not others:
        return df.select(*columns).distinct()
    packed = F.struct(*[F.col(f"`{c}`") for c in others])
    return (
        df.groupBy(*keys)
        .agg(F.min_by(packed, F.struct(*order)).alias("_row"))
        .select(*keys, "_row.*")
        .select(*columns)
    )


def keep_largest_state(statistics: DataFrame) -> DataFrame:
    """One row per name: the state with the largest total, then the first in text order."""
    others = [c for c in statistics.columns if c != "razao_social"]
    largest_first = F.struct((-F.coalesce(F.col("valor_total"), F.lit(0))).alias("t"), F.col("uf"))
    return (
        statistics.groupBy("razao_social")
        .agg(F.min_by(F.struct(*others), largest_first).alias("_row"))
        .select("razao_social", "_row.*")
    )
