"""Links of stored directory-listing pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermark.functions import links


def page_links(pages: DataFrame, html: str = "html") -> DataFrame:
    """One row per anchor, with its position in the page; no shuffle."""
    others = [c for c in pages.columns if c != html]
    return pages.select(*others, F.posexplode(links.hrefs(F.col(html))).alias("pos", "href"))


def matching_links(pages: DataFrame, pattern: str) -> DataFrame:
    """Links that match from their first character, newest (last in text order) first.

    Each page is a listing of its own, so the order is one within the row:
    no shuffle and no global sort, which would extract all links twice.
    """
    found = F.filter(links.hrefs(F.col("html")), lambda href: href.rlike(f"^(?:{pattern})"))
    return pages.select("page_id", F.posexplode(F.sort_array(found, False)).alias("ordem", "href"))


def classified(found: DataFrame) -> DataFrame:
    """Kind, absolute address and item name of each link."""
    href = F.col("href")
    return found.select(
        "page_id",
        "pos",
        "href",
        links.link_kind(href).alias("kind"),
        F.concat(F.col("url"), href).alias("address"),
        links.item_name(href).alias("item"),
    )


def first_match(pages: DataFrame, links_column: str, ending: str = ".csv") -> DataFrame:
    """First link with this ending per page; pages without one are left out."""
    first = links.first_with_ending(F.col(links_column), ending)
    found = pages.select("page_id", "url", first.alias("href")).filter("href IS NOT NULL")
    address = links.absolute_url(F.col("url"), F.col("href"))
    return found.select("page_id", address.alias("address"), links.file_name(address).alias("file_name"))
