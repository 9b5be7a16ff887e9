"""Anchors in directory-listing pages."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Parts of a page whose text is not markup.
INERT = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
# Group 1 is the target with its quotes; an unquoted one ends at a blank or the tag's end.
ANCHOR = r"""(?is)<a(?=\s)[^>]*?\shref\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)"""

# File endings that are downloaded, and entries that are skipped.
FILE_ENDINGS = ("zip", "csv", "pdf", "rar")
SKIPPED_ENTRIES = ("../", "./", "")

# A character reference, or text without one; a lone ampersand is text.
PIECE = r"(?s)&#[0-9]{1,9};|&#[xX][0-9a-fA-F]{1,7};|&[A-Za-z][A-Za-z0-9]*;|&|[^&]+"
# Code points 128 to 159 mean what Windows-1252 has there.
WINDOWS = {code: bytes([code]).decode("cp1252", "ignore") or chr(code) for code in range(128, 160)}


def named_references() -> Column:
    """Characters by reference, as ``&name;``, from the standard library's table of HTML 5."""
    names = [(f"&{name}", text) for name, text in html5.items() if name.endswith(";")]
    return F.from_json(F.lit(json.dumps(dict(names))), "map<string,string>")


def character(code: Column) -> Column:
    """The character of a code point; the replacement character if there is none."""
    windows = F.element_at(F.array(*(F.lit(WINDOWS[c]) for c in sorted(WINDOWS))), (code - 127).cast("int"))
    usable = (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    plain = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return F.when(code.between(128, 159), windows).when(usable, plain).otherwise(F.lit("\ufffd"))


def unescape(text: Column) -> Column:
    """Text with its character references decoded once; unknown names and unfinished ones stay as they are."""

    def decoded(piece: Column) -> Column:
        number = F.regexp_extract(piece, r"^&#([0-9]+);$", 1).cast("long")
        digits = F.conv(F.regexp_extract(piece, r"^&#[xX]([0-9a-fA-F]+);$", 1), 16, 10).cast("long")
        return (
            F.when(piece.rlike("^&#[0-9]"), character(number))
            .when(piece.rlike("^&#[xX]"), character(digits))
            .when(F.startswith(piece, F.lit("&")), F.coalesce(F.try_element_at(named_references(), piece), piece))
            .otherwise(piece)
        )

    pieces = F.transform(F.regexp_extract_all(text, F.lit(PIECE), F.lit(0)), decoded)
    return F.when(F.contains(text, F.lit("&")), F.array_join(pieces, "")).otherwise(text)


def unquoted(target: Column) -> Column:
    quoted = F.startswith(target, F.lit('"')) | F.startswith(target, F.lit("'"))
    return F.when(quoted, F.substr(target, F.lit(2), F.length(target) - 2)).otherwise(target)


def hrefs(html: Column) -> Column:
    """All anchor targets of a page, in page order."""
    markup = F.regexp_replace(html, INERT, " ")
    return F.transform(F.regexp_extract_all(markup, F.lit(ANCHOR), F.lit(1)), lambda t: unescape(unquoted(t)))


def link_kind(href: Column) -> Column:
    """``file``, ``folder`` or ``ignored``."""
    skipped = href.isNull() | href.isin(*SKIPPED_ENTRIES) | href.startswith("?")
    is_file = F.lower(href).rlike(r"\.(?:%s)$" % "|".join(FILE_ENDINGS))
    return (
        F.when(skipped, F.lit("ignored"))
        .when(is_file, F.lit("file"))
        .when(href.endswith("/"), F.lit("folder"))
        .otherwise(F.lit("ignored"))
    )


def absolute_url(base: Column, href: Column) -> Column:
    return F.when(F.startswith(href, F.lit("http")), href).otherwise(F.concat(base, href))


def item_name(href: Column) -> Column:
    """``1T.zip`` and ``1T/`` both name the period ``1T``."""
    return F.regexp_replace(F.btrim(href, F.lit("/")), r"(?i)\.zip$", "")


def file_name(url: Column) -> Column:
    return F.element_at(F.split(url, "/"), -1)


def first_with_ending(links: Column, ending: str) -> Column:
    """First entry with this ending, null if there is none; stays within the row."""
    return F.try_element_at(F.filter(links, lambda x: F.lower(x).endswith(ending)), F.lit(1))
