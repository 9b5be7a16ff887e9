"""Check digits of the 14-digit tax id (CNPJ), as plain column arithmetic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from quartermark.functions.text import digits_only, zero_fill

LENGTH = 14
# Weights of the two modulo-11 check digits.
FIRST_WEIGHTS = (5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2)
SECOND_WEIGHTS = (6, 5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2)


def clean_cnpj(text: Column) -> Column:
    """Digits only, filled to 14 places; null becomes all zeros."""
    return zero_fill(digits_only(F.coalesce(text, F.lit(""))), LENGTH)


def digit_at(clean: str, position: int) -> str:
    return f"(ascii(substring(`{clean}`, {position + 1}, 1)) - 48)"


def check_digit(clean: str, weights: Sequence[int]) -> str:
    total = " + ".join(f"{digit_at(clean, i)} * {w}" for i, w in enumerate(weights))
    return f"if(({total}) % 11 < 2, 0, 11 - ({total}) % 11)"


def cnpj_is_valid(clean: str) -> Column:
    """Expects the name of a column with the output of :func:`clean_cnpj`.

    A column of its own, so that the cleaning runs once per row and not once
    per digit.
    """
    return F.expr(
        f"""length(`{clean}`) = {LENGTH}
        AND `{clean}` <> repeat(substring(`{clean}`, 1, 1), {LENGTH})
        AND {check_digit(clean, FIRST_WEIGHTS)} = {digit_at(clean, LENGTH - 2)}
        AND {check_digit(clean, SECOND_WEIGHTS)} = {digit_at(clean, LENGTH - 1)}"""
    )
