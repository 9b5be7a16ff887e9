"""Money text and value checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quartermark.schemas import MONEY


def has_comma(text: Column) -> Column:
    return F.coalesce(F.contains(text, F.lit(",")), F.lit(False))


def locale_decimal(text: Column, comma_style: Column, kind: T.DecimalType = MONEY) -> Column:
    """``comma_style`` says whether the whole source file writes ``1.234,56``.

    In such a file every dot is a thousands separator, also in values that
    happen to have no comma. Casting to decimal, not double, keeps texts such
    as ``1d`` invalid.
    """
    swapped = F.replace(F.replace(text, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return F.when(comma_style, swapped).otherwise(text).try_cast(kind)


def zero_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def is_suspicious(value: Column) -> Column:
    """Missing, zero or negative."""
    return zero_if_null(value) <= 0


def growth_percent(start: Column, end: Column) -> Column:
    """Null instead of an error where ``start`` is zero."""
    return F.round(F.try_divide(end - start, start) * 100, 2)
