"""Raw files to the consolidated expense table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quartermark.operators.normalize import consolidated
from quartermark.schemas import CLAIM_KEYWORDS
from quartermark.sources.delimited import LATIN
from quartermark.sources.raw import RawScan, scan


def write_bronze(
    spark: SparkSession, root: str, encoding: str = LATIN, pattern: str = CLAIM_KEYWORDS
) -> tuple[DataFrame, RawScan]:
    """The aligned, keyword-filtered rows, which the scan has written: the raw text is parsed once."""
    files = scan(spark, root, encoding)
    return files.bronze(pattern), files


def consolidate(spark: SparkSession, root: str, encoding: str = LATIN, pattern: str = CLAIM_KEYWORDS) -> DataFrame:
    bronze, _ = write_bronze(spark, root, encoding, pattern)
    return consolidated(bronze)
