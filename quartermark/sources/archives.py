"""Zip archives: members unpacked to plain files, which are then read like others.

The archive list and the member list are metadata. Each member is then a unit
of work of its own and is decompressed as a stream, so memory use does not
depend on the size of an archive. Nothing passes through the driver.
"""

from __future__ import annotations

import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quartermark.session import written_once
from quartermark.sources.delimited import LATIN, DelimitedScan, list_files
from quartermark.sources.files import copy_stream, open_stream, resolve

ZIP_FILES = "*.[zZ][iI][pP]"
MEMBER_SCHEMA = "archive string, member string, size long, error string"
ALL_FILES = "*"
DAMAGE = (zipfile.BadZipFile, zlib.error, OSError, EOFError, ValueError, RuntimeError)
TASKS_PER_CORE = 4


def describe(problem: Exception) -> str:
    return f"{type(problem).__name__}: {problem}"


def _members(path: str) -> list[tuple]:
    try:
        with open_stream(path) as stream, zipfile.ZipFile(stream) as archive:
            return [(path, i.filename, i.file_size, None) for i in archive.infolist() if not i.is_dir()]
    except DAMAGE as problem:
        return [(path, None, None, describe(problem))]


def list_members(spark: SparkSession, root: str, pattern: str = ZIP_FILES) -> DataFrame:
    """One row per member; a damaged archive is one row with ``error`` set."""
    return members_of(list_files(spark, root, pattern))


def members_of(archives: DataFrame) -> DataFrame:
    """The same for listed archives (path)."""

    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["archive", "member", "size", "error"]
        for batch in batches:
            rows = [m for path in batch["path"] for m in _members(path)]
            frame = pd.DataFrame(rows, columns=columns, dtype="object")
            yield frame.assign(size=frame["size"].astype("Int64"))

    return archives.select("path").mapInPandas(members, MEMBER_SCHEMA)


def member_place(root: str, archive: str, member: str) -> str:
    """Where a member goes below the target: the archive's own folders, its name, the member's path.

    ``2025/1T.zip`` gives ``2025/1T/…``, so the folders still tell the period.
    """
    base, inner = resolve(root)[1].rstrip("/"), resolve(archive)[1]
    folders = inner.removeprefix(base).lstrip("/")
    parts = [p for p in member.replace("\\", "/").split("/") if p not in ("", ".", "..")]
    return "/".join([folders[: -len(".zip")], *parts])


def unpack(
    spark: SparkSession, root: str, target: str, pattern: str = ZIP_FILES, archives: DataFrame | None = None
) -> DataFrame:
    """Copies every member of all archives below ``root``, or of some listed ones, to a file below ``target``, once.

    One row per member, with the error of a damaged archive or member. Damaged
    ones leave no file. A member is a unit of work and is copied as a stream;
    the shuffle moves names only and spreads the members of one archive.
    """

    def copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        attempt = str(TaskContext.get().taskAttemptId())
        for batch in batches:
            errors = []
            for path, member in zip(batch["archive"], batch["member"]):
                try:
                    with open_stream(path) as stream, zipfile.ZipFile(stream) as archive, archive.open(member) as raw:
                        copy_stream(raw, f"{target}/{member_place(root, path, member)}", attempt)
                    errors.append(None)
                except DAMAGE as problem:
                    errors.append(describe(problem))
            yield batch.assign(error=pd.Series(errors, index=batch.index, dtype="object"))

    # Listed once; the names are read for the good and for the damaged archives.
    listed = written_once(list_members(spark, root, pattern) if archives is None else members_of(archives), "archive-members")
    names = listed.filter("error IS NULL").select("archive", "member")
    tasks = TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    copied = names.repartition(tasks, "archive", "member").mapInPandas(copy, "archive string, member string, error string")
    damaged = listed.filter("error IS NOT NULL").select("archive", "member", "error")
    return written_once(copied.unionByName(damaged), "archive-log")


def read_members(
    spark: SparkSession, root: str, target: str, columns: list[str], sep: str = ";", encoding: str = LATIN, pattern: str = ZIP_FILES
) -> tuple[DataFrame, DataFrame]:
    """Rows of all whole members, with their place below ``target``, and what was damaged (archive, member, error).

    A member that is damaged inside gives no rows at all.
    """
    log = unpack(spark, root, target, pattern)
    if log.filter("error IS NULL").isEmpty():
        schema = ", ".join(["file string", *(f"`{c}` string" for c in columns)])
        return spark.createDataFrame([], schema), log.filter("error IS NOT NULL")

    def by_position(names: list[str]) -> tuple[object, str | None]:
        return None, None if len(names) == len(columns) else "columns"

    def build(kind, fields, overlong):
        return F.struct(*[f.alias(c) for f, c in zip(fields, columns)], overlong.alias("overlong"))

    scan = DelimitedScan(spark, list_files(spark, target, ALL_FILES), encoding, [target], by_position, ALL_FILES)
    return scan.rows(build).drop("block", "arrival"), log.filter("error IS NOT NULL")
