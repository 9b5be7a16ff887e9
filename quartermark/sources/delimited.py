"""Scan of delimited files whose headers, separators and quality differ.

All files are one text read. A written table tells the separator and header of
each file; lines join it on the file and are parsed by the rule of their
layout, one expression for each distinct layout. Only layouts reach the driver,
so the number of jobs and the size of the plan depend on them and not on the
number of files. Files in which a line ends inside a quoted field are found by
the same read; their records then come from :mod:`quartermark.sources.records`.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quartermark.operators.align import Layout, picked, resolve_layout
from quartermark.session import written_once
from quartermark.sources.files import open_stream
from quartermark.sources.records import cut_in_field, whole_records

# How much of a file a semicolon is searched in, and the fallback choices.
SAMPLE_CHARACTERS = 2048
SEPARATORS = (";", ",", "\t", "|")

# A file whose first line is longer has no header.
HEADER_BYTES = 16 << 20

TEXT_FILES = "*.{[cC][sS][vV],[tT][xX][tT]}"
LATIN = "ISO-8859-1"
UTF8 = "UTF-8"
# Each file is read as UTF-8 if all of its bytes are valid, else as Latin-1.
BY_FILE = "by file"
HEAD_SCHEMA = "path string, file string, length long, sep string, header string, head binary"
FILE_COLUMNS = ("path", "file", "length")


def file_columns() -> list[Column]:
    """What a listing knows of a file: its path, that path as rows of the file carry it, and its length."""
    return [F.col("path"), F.col("_metadata.file_path").alias("file"), F.col("length")]


def list_files(spark: SparkSession, root: str, pattern: str = TEXT_FILES) -> DataFrame:
    """Files below ``root``, at any depth. Reads no file content."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(root)
        .select(*file_columns())
    )


def choose_separator(text: str) -> str:
    """A semicolon anywhere in the sample wins; else the most frequent one in the whole header."""
    if ";" in text[:SAMPLE_CHARACTERS]:
        return ";"
    header = text.split("\n", 1)[0]
    counts = {s: header.count(s) for s in SEPARATORS}
    best = max(SEPARATORS, key=lambda s: counts[s])
    return best if counts[best] else ";"


def _head(path: str, encoding: str) -> tuple[str | None, str | None, bytes | None]:
    try:
        with open_stream(path) as stream:
            data = stream.readline(HEADER_BYTES)
            if len(data) == HEADER_BYTES:
                return None, None, None
            data += stream.read(max(0, SAMPLE_CHARACTERS - len(data)))
    except OSError:
        return None, None, None
    head = re.split(b"\r\n|\n|\r", data, maxsplit=1)[0]
    if encoding == BY_FILE:
        try:
            head.decode(UTF8)
            encoding = UTF8
        except UnicodeDecodeError:
            encoding = LATIN
    text = data.decode(encoding, errors="ignore")
    header = head.decode(encoding, errors="ignore") if text.strip() else None
    return choose_separator(text), header, head


def read_heads(files: DataFrame, encoding: str = LATIN) -> DataFrame:
    """``files`` with separator and header line; no header for empty or unreadable ones."""

    def heads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [_head(p, encoding) for p in batch["path"]]
            columns = {c: pd.Series([f[i] for f in found], index=batch.index, dtype="object") for i, c in enumerate(("sep", "header", "head"))}
            yield batch.assign(**columns)

    few = files.select(*FILE_COLUMNS).coalesce(4 * files.sparkSession.sparkContext.defaultParallelism)
    return few.mapInPandas(heads, HEAD_SCHEMA)


def header_names(header: str, sep: str) -> list[str]:
    """Header fields, without a UTF-8 byte order mark in either decoding."""
    for mark in ("\ufeff", "\u00ef\u00bb\u00bf"):
        header = header.removeprefix(mark)
    return next(csv.reader([header], delimiter=sep))


def literal_path(path: str) -> str:
    """Keeps brackets and the like in a file name from acting as a pattern."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def read_lines(spark: SparkSession, roots: Sequence[str], pattern: str = TEXT_FILES) -> DataFrame:
    """(line, file, block, arrival): all lines below ``roots`` as bytes, in file order within a block."""
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    return reader.text(list(roots)).select(
        F.col("value").cast("binary").alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("arrival"),
    )


def file_encodings(lines: DataFrame) -> DataFrame:
    """(file, encoding): UTF-8 where every line is valid, else Latin-1. One partial result for each file and task."""
    valid = F.bool_and(F.is_valid_utf8(F.col("line").cast("string")))
    return lines.groupBy("file").agg(F.when(valid, F.lit(UTF8)).otherwise(F.lit(LATIN)).alias("encoding"))


def record_fields(record: Column, sep: str, width: int, build: Callable[[list[Column], Column], Column]) -> Column:
    """``build(fields, overlong)`` over the parsed fields of a record, which is parsed once.

    Short records are filled with nulls; overlong marks those with too many fields. The parser
    marks both as corrupt, so separators outside quotes are counted only then.
    """
    schema = ", ".join([*(f"c{i} string" for i in range(width)), "_corrupt string"])
    options = {"sep": sep, "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    mark = re.escape(sep)

    def built(r: Column) -> Column:
        # Only a quote at the start of a field opens one.
        unquoted = F.regexp_replace(r["_corrupt"], rf'(^|{mark})"[^"]*+(?:""[^"]*+)*+"(?={mark}|\s*$)', "$1")
        fields = F.length(unquoted) - F.length(F.replace(unquoted, F.lit(sep), F.lit(""))) + 1
        return build([r[f"c{i}"] for i in range(width)], F.coalesce(fields > width, F.lit(False)))

    return F.element_at(F.transform(F.array(F.from_csv(record, schema, options)), built), 1)


class DelimitedScan:
    """Files by layout: resolved once, read lazily.

    ``rule`` turns a header's names into what tells layouts apart, and gives the
    reason why files with such a header cannot be used. ``roots`` are the folders
    that hold the files; without them the files are named one by one, for a
    bounded number of files.
    """

    def __init__(
        self,
        spark: SparkSession,
        files: DataFrame,
        encoding: str = LATIN,
        roots: Sequence[str] | None = None,
        rule: Callable[[list[str]], tuple[object, str | None]] | None = None,
        pattern: str = TEXT_FILES,
    ) -> None:
        self.spark, self.encoding, self.pattern = spark, encoding, pattern
        heads = written_once(read_heads(files, encoding), "layouts")
        self.roots = list(roots) if roots is not None else [literal_path(r["path"]) for r in heads.select("path").collect()]
        # Columns are bound by position, so headers that differ only in wording share a layout.
        self.layouts: dict[tuple[str, int, object], int] = {}
        rows = []
        for r in heads.filter("header IS NOT NULL").select("sep", "header").distinct().collect():
            names = header_names(r["header"], r["sep"])
            kind, problem = (rule or layout_rule)(names)
            number = None if problem else self.layouts.setdefault((r["sep"], len(names), kind), len(self.layouts))
            rows.append((r["sep"], r["header"], number, problem))
        known = spark.createDataFrame(rows, "sep string, header string, layout int, problem string")
        unreadable = F.when(F.col("header").isNull(), F.lit("unreadable")).otherwise(F.col("problem"))
        self.files = heads.join(known, ["sep", "header"], "left").withColumn("problem", unreadable)
        if encoding == BY_FILE:
            found = file_encodings(read_lines(spark, self.roots, pattern))
            self.files = written_once(self.files.join(found, "file", "left"), "encodings")
        else:
            self.files = self.files.withColumn("encoding", F.lit(encoding))

    def parse(self, rows: DataFrame, build: Callable, *keep: str) -> DataFrame:
        """Columns that ``build(layout, fields, overlong)`` gives for each row (value, layout), by the row's layout."""
        parsed = None
        for (sep, width, kind), number in self.layouts.items():
            fields = record_fields(F.col("value"), sep, width, lambda f, o, kind=kind: build(kind, f, o))
            here = F.col("layout") == number
            parsed = F.when(here, fields) if parsed is None else parsed.when(here, fields)
        # A generator keeps filters on its columns above it, so that nothing is parsed twice.
        return rows.select(*keep, F.inline(F.array(parsed)))

    def rows(self, build: Callable, wanted: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
        """Built columns, with file, block and arrival, of all records that are neither overlong nor unwanted."""
        place = ("file", "block", "arrival")
        usable = self.files.filter("layout IS NOT NULL")
        lines = read_lines(self.spark, self.roots, self.pattern).join(usable.select("file", "layout", "head", "encoding"), "file")
        lines = lines.filter(F.col("line") != F.col("head"))
        if self.encoding == BY_FILE:
            value = F.when(F.col("encoding") == UTF8, F.decode("line", UTF8)).otherwise(F.decode("line", LATIN))
        else:
            value = F.decode("line", self.encoding)
        lines = lines.withColumn("value", value).filter(F.trim("value") != "")
        cut = F.lit(False)
        for sep in {s for s, _, _ in self.layouts}:
            numbers = [n for (s, _, _), n in self.layouts.items() if s == sep]
            cut = cut | (F.col("layout").isin(numbers) & F.contains("value", F.lit('"')) & F.col("value").rlike(cut_in_field(sep)))
        with_flag = self.parse(lines.withColumn("cut", cut), build, *place, "cut")
        kept = wanted(with_flag.filter("NOT cut AND NOT overlong")).unionByName(with_flag.filter("cut"))
        first = written_once(kept, "lines")
        broken = first.filter("cut").select("file").distinct()
        self.damaged = None
        if broken.isEmpty():
            return first.drop("cut", "overlong")
        again = written_once(
            whole_records(usable.join(broken, "file").select("path", "file", "length", "sep", "layout", "encoding")), "records"
        )
        self.damaged = again.filter("damaged").select("file", "value")
        second = self.parse(again.filter("NOT damaged").filter(F.trim("value") != ""), build, *place)
        second = wanted(second.filter("NOT overlong"))
        return first.join(broken, "file", "left_anti").drop("cut", "overlong").unionByName(second.drop("overlong"))


def layout_rule(names: list[str]) -> tuple[object, str | None]:
    layout = resolve_layout(names)
    return layout, layout.problem


def aligned_fields(layout: Layout, fields: list[Column], overlong: Column) -> Column:
    return F.struct(*picked(layout, fields), overlong.alias("overlong"))


def read_staged(spark: SparkSession, path: str, schema: T.StructType, sep: str = ";") -> DataFrame:
    """A well-formed file with a known header, every column as text.

    An empty field is null and a quoted empty field is blank text. Spark reads
    both as its null text, so that text is set to one no file contains.
    """
    reader = spark.read.schema(schema).option("sep", sep).option("header", True)
    return reader.option("escape", '"').option("nullValue", "\u0000").csv(path)


def read_register(spark: SparkSession, path: str, encoding: str = LATIN) -> DataFrame:
    """Register files with their own headers, which may differ in order, separator and columns.

    Columns are matched by name; those a file lacks are null. ``source_file``,
    ``block`` and ``arrival`` order duplicates as they stand in the files.
    """

    def by_name(names: list[str]) -> tuple[object, str | None]:
        return tuple(n.strip().upper() for n in names), None

    scan = DelimitedScan(spark, list_files(spark, path), encoding, [path], by_name)
    if not scan.layouts:
        raise FileNotFoundError(f"no register file below {path}")
    every = list(dict.fromkeys(n for _, _, names in scan.layouts for n in names))

    def build(names: tuple[str, ...], fields: list[Column], overlong: Column) -> Column:
        place = {n: i for i, n in reversed(list(enumerate(names)))}
        columns = [(fields[place[n]] if n in place else F.lit(None).cast("string")).alias(n) for n in every]
        return F.struct(*columns, overlong.alias("overlong"))

    return scan.rows(build).withColumnRenamed("file", "source_file")
