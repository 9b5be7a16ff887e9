"""Files without a byte. Spark's readers leave them out of every listing, so tasks list the folders for them."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quartermark.sources.files import resolve

ENTRY = "path string, folder boolean, length long"


def shown(root: str) -> str:
    """A folder as Spark shows it in the paths of a listing."""
    if root.startswith("file:"):
        root = root.removeprefix("file:")
    elif "://" in root:
        return root.rstrip("/")
    return "file:/" + root.strip("/")


def entries(folder: str) -> Iterator[tuple[str, bool, int]]:
    """What one folder holds; names that Spark takes for hidden are left out."""
    system, inner = resolve(folder)
    for entry in system.get_file_info(fs.FileSelector(inner, allow_not_found=True)):
        name = entry.base_name
        hidden = name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")
        if not hidden:
            yield f"{folder}/{name}", entry.type == fs.FileType.Directory, entry.size or 0


def below(folder: str) -> Iterator[tuple[str, bool, int]]:
    """All files below a folder; one folder's listing is held at a time, and the names of those still to come."""
    left = [folder]
    while left:
        for path, is_folder, length in entries(left.pop()):
            if is_folder:
                left.append(path)
            else:
                yield path, False, length


def frames(found: Iterator[tuple[str, bool, int]], endings: tuple[str, ...]) -> Iterator[pd.DataFrame]:
    kept = []
    for entry in found:
        path, is_folder, length = entry
        if is_folder or (not length and path.lower().endswith(endings)):
            kept.append(entry)
        if len(kept) >= 10_000:
            yield pd.DataFrame(kept, columns=["path", "folder", "length"])
            kept = []
    if kept:
        yield pd.DataFrame(kept, columns=["path", "folder", "length"])


def empty_files(spark: SparkSession, root: str, endings: Sequence[str]) -> DataFrame:
    """(path): zero-byte files with these endings below a folder, at any depth.

    One task lists the folder itself, the folders in it are dealt to tasks. A root
    with a pattern names no one folder and gives no rows.
    """
    if re.search(r"(?<!\\)[*?\[{]", root):
        return spark.createDataFrame([], "path string")
    folder, wanted = shown(re.sub(r"\\(.)", r"\1", root)), tuple(endings)

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                yield from frames(entries(path), wanted)

    def rest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                yield from frames(below(path), wanted)

    top = spark.range(1).select(F.lit(folder).alias("path")).mapInPandas(first, ENTRY)
    tasks = 4 * spark.sparkContext.defaultParallelism
    inside = top.filter("folder").repartition(tasks, "path").mapInPandas(rest, ENTRY)
    return top.filter("NOT folder").unionByName(inside).select("path")
