"""All raw files below a folder: delimited text, also inside archives; workbooks are named as skipped."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quartermark.operators.normalize import keep_keywords
from quartermark.schemas import CLAIM_KEYWORDS, all_text
from quartermark.session import shared_dir, written_once
from quartermark.sources.archives import ZIP_FILES, unpack
from quartermark.sources.delimited import LATIN, DelimitedScan, aligned_fields, list_files
from quartermark.sources.empty import empty_files

RAW_FILES = "*.{[cC][sS][vV],[tT][xX][tT],[xX][lL][sS][xX]}"
RAW_ENDINGS = (".csv", ".txt", ".xlsx")
LANDED_ENDINGS = (*RAW_ENDINGS, ".zip")


def listed_path(path: Column) -> Column:
    """The metadata column escapes what a file listing shows as it is."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def empty_rows(empty: DataFrame) -> DataFrame:
    return empty.select(F.col("path").alias("source_file"), F.lit("empty_file").alias("motivo"))


class RawScan:
    """Headers are resolved on creation; rows are read when the result is used."""

    def __init__(
        self,
        spark: SparkSession,
        files: DataFrame,
        encoding: str = LATIN,
        members: DataFrame | None = None,
        roots: Sequence[str] | None = None,
        empty: DataFrame | None = None,
    ) -> None:
        self.members, self.empty = members, empty
        is_workbook = F.lower("path").endswith(".xlsx")
        self.spark = spark
        self.text = DelimitedScan(spark, files.filter(~is_workbook), encoding, roots)
        self.workbooks = files.filter(is_workbook)

    def bronze(self, pattern: str = CLAIM_KEYWORDS) -> DataFrame:
        """Aligned text rows of all usable files that match the keywords."""
        if not self.text.layouts:
            return self.spark.createDataFrame([], all_text("reg_ans", "data", "descricao", "valor", "source_file"))
        rows = self.text.rows(aligned_fields, lambda df: keep_keywords(df, "descricao", pattern))
        return rows.select("reg_ans", "data", "descricao", "valor", F.col("file").alias("source_file"))

    def skipped(self, bronze: DataFrame) -> DataFrame:
        """Files that add nothing, and why."""
        # Workbooks have no splittable text form; they are named, so that someone exports them.
        named = self.text.files.filter("problem IS NOT NULL").select(F.col("path").alias("source_file"), F.col("problem").alias("motivo"))
        named = named.unionByName(self.workbooks.select(F.col("path").alias("source_file"), F.lit("workbook").alias("motivo")))
        if self.members is not None:
            damaged = self.members.filter("error IS NOT NULL").select(
                F.concat_ws("!", "archive", "member").alias("source_file"), F.lit("damaged_archive").alias("motivo")
            )
            named = named.unionByName(damaged)
        if self.empty is not None:
            # Folders are listed once, however often the result is read.
            named = named.unionByName(written_once(empty_rows(self.empty), "empty-files"))
        hits = bronze.select(F.col("source_file").alias("file")).distinct()
        silent = self.text.files.filter("problem IS NULL").join(hits, "file", "left_anti")
        return named.unionByName(silent.select(F.col("path").alias("source_file"), F.lit("no_keyword_match").alias("motivo")))

    def damaged_records(self) -> DataFrame:
        """(source_file, registro): records left out because a quote is not closed; known once the rows were read."""
        found = getattr(self.text, "damaged", None)
        if found is None:
            return self.spark.createDataFrame([], all_text("source_file", "registro"))
        return found.select(listed_path(F.col("file")).alias("source_file"), F.col("value").alias("registro"))


def scan(spark: SparkSession, root: str, encoding: str = LATIN) -> RawScan:
    """Files and members of zip archives below ``root``; members are read like plain files."""
    files, members, roots = list_files(spark, root, RAW_FILES), None, [root]
    empty = empty_files(spark, root, LANDED_ENDINGS)
    if not list_files(spark, root, ZIP_FILES).isEmpty():
        target = shared_dir(spark, "unpacked")
        members = unpack(spark, root, target)
        if not members.filter("error IS NULL").isEmpty():
            files = files.unionByName(list_files(spark, target, RAW_FILES))
            roots.append(target)
            empty = empty.unionByName(empty_files(spark, target, RAW_ENDINGS))
    return RawScan(spark, files, encoding, members, roots, empty)
