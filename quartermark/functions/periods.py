"""Year and quarter from dates, folder names and period keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A four-digit folder followed by a quarter folder (1T, T1, 1, 1T2025); each
# may carry a ``name=`` prefix, as in a partitioned table.
PERIOD_FOLDERS = r"[/=](\d{4})/(?:[^/=]++=)?(?:\s|%20)*[tT]?([1-4])[tT]?(?:\d{4})?(?:/|$)"


# Year first with dashes or slashes, eight digits, or day first; each may carry a time, and that a zone.
DATE_FORMS = (
    r"^\s*(?:(\d{4})([-/])(\d{1,2})\2(\d{1,2})|(\d{4})(\d{2})(\d{2})"
    r"|(\d{1,2})(?:/(?=\d{1,2}/)|-(?=\d{1,2}-))(\d{1,2})[-/](\d{4}))"
    r"(?:[T ]\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?(?:Z|[+-]\d{2}:?\d{2})?)?\s*$"
)


def parse_date(text: Column) -> Column:
    """Dates with the year first (dashes, slashes or eight digits) or the day first (dashes, slashes); else null.

    A date with a time and a zone is the day as it is written.

    Guessing one format per column would read 01/04 as January. The text is
    brought into ISO order and cast, because a cast returns null for bad text,
    while a pattern parser raises and catches an exception for every such row.
    Of the three forms one takes part in a match; the groups of the others are empty.
    """
    ordered = F.regexp_replace(text, DATE_FORMS, "#$1$5$10-$3$6$9-$4$7$8")
    any_form = F.when(F.startswith(ordered, F.lit("#")), F.substr(ordered, F.lit(2)).try_cast("date"))
    # The usual form needs no pattern.
    usual = F.when((F.length(text) == 10) & (F.substring(text, 5, 1) == "-"), text.try_cast("date"))
    return F.coalesce(usual, any_form)


def quarter_label(quarter: Column) -> Column:
    return F.elt(quarter, *[F.lit(f"{q}T") for q in range(1, 5)])


def date_year(day: Column) -> Column:
    return F.year(day).cast("int")


def date_quarter(day: Column) -> Column:
    return quarter_label(F.quarter(day))


def path_year(path: Column) -> Column:
    return F.nullif(F.regexp_extract(path, PERIOD_FOLDERS, 1), F.lit("")).try_cast("int")


def path_quarter(path: Column) -> Column:
    digit = F.nullif(F.regexp_extract(path, PERIOD_FOLDERS, 2), F.lit(""))
    return F.concat(digit, F.lit("T"))


def period_key(year: Column, quarter: Column) -> Column:
    """``20251T``: text order equals time order for four-digit years."""
    return F.concat(year.cast("string"), quarter)
