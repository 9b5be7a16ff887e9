"""Display texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the pt-BR currency format puts a no-break space after the symbol.
CURRENCY_SYMBOL = "R$\u00a0"


def truncate_label(text: Column, width: int = 20) -> Column:
    return F.when(F.length(text) > width, F.concat(F.substring(text, 1, width), F.lit("..."))).otherwise(text)


def currency_label(value: Column) -> Column:
    """``R$ 1.234,56``; the sign goes before the symbol.

    Rounds half away from zero first, because ``format_number`` rounds half
    to even.
    """
    amount = F.round(value, 2)
    text = F.translate(F.format_number(F.abs(amount), 2), ",.", ".,")
    return F.concat(F.when(amount < 0, F.lit("-")).otherwise(F.lit("")), F.lit(CURRENCY_SYMBOL), text)


def shown(value: Column) -> Column:
    """A page shows a missing value as nothing."""
    return F.coalesce(value.cast("string"), F.lit(""))


def phone_label(ddd: Column, number: Column) -> Column:
    return F.concat(F.lit("("), shown(ddd), F.lit(") "), shown(number))


def address_label(street: Column, number: Column, extra: Column, district: Column) -> Column:
    return F.concat(shown(street), F.lit(", "), shown(number), F.lit(" "), shown(extra), F.lit(" - "), shown(district))


def place_label(city: Column, state: Column) -> Column:
    return F.concat(shown(city), F.lit(" / "), shown(state))


def contact_label(name: Column, role: Column) -> Column:
    return F.concat(shown(name), F.lit(" ("), shown(role), F.lit(")"))


def quarter_title(quarter: Column) -> Column:
    return F.concat(shown(quarter), F.lit("º Trimestre"))
