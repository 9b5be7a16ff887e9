"""Stored indexes of the register: pages that open one range, search that reads few rows."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quartermark.operators.serving import MAX_PAGE_SIZE, search
from quartermark.sources.tables import write_table

SEARCHED_COLUMNS = ("razao_social", "cnpj")
PIECE = 3
# Pieces of these characters have one lower-case form, in this language and in the engine's.
PLAIN_PIECE = re.compile(r"[\x20-\x7e\xa0-\xff]{3}")


def write_pages(register: DataFrame, path: str, ranges: int, key: str = "registro_operadora") -> None:
    """The register in ``ranges`` sorted ranges, one folder each, and how many rows each of them has."""
    placed = register.repartitionByRange(ranges, key).withColumn("faixa", F.spark_partition_id())
    placed.sortWithinPartitions("faixa", key).write.mode("overwrite").partitionBy("faixa").parquet(f"{path}/linhas")
    stored = register.sparkSession.read.schema(placed.schema).parquet(f"{path}/linhas")
    # The folder is the range, so this reads no column.
    write_table(stored.groupBy("faixa").agg(F.count("*").alias("n")), f"{path}/faixas")


def read_page(spark: SparkSession, path: str, number: int = 1, size: int = 10, key: str = "registro_operadora") -> DataFrame:
    """The page that paging over the whole sorted register gives, from the ranges that hold it.

    One short row for each range reaches the driver.
    """
    if number < 1 or not 1 <= size <= MAX_PAGE_SIZE:
        raise ValueError("page starts at 1, size is 1 to 100")
    first, before, skipped, chosen = (number - 1) * size, 0, 0, []
    for row in spark.read.parquet(f"{path}/faixas").orderBy("faixa").collect():
        if before < first + size and before + row["n"] > first:
            skipped = skipped if chosen else first - before
            chosen.append(row["faixa"])
        before += row["n"]
    rows = spark.read.parquet(f"{path}/linhas").filter(F.col("faixa").isin(chosen)).drop("faixa")
    return rows.orderBy(key).offset(skipped).limit(size)


def page_count(spark: SparkSession, path: str, size: int = 10) -> DataFrame:
    """Rows and pages, from the counts alone."""
    total = F.coalesce(F.sum("n"), F.lit(0))
    counts = spark.read.parquet(f"{path}/faixas")
    return counts.agg(total.alias("total"), F.ceil(total / F.lit(size)).cast("bigint").alias("paginas"))


def pieces_of(text: Column) -> Column:
    """Different pieces of a text; null if it has none."""
    places = F.when(F.length(text) >= PIECE, F.sequence(F.lit(1), F.length(text) - PIECE + 1))
    return F.array_distinct(F.transform(places, lambda p: F.substring(text, p, F.lit(PIECE))))


def write_search_index(register: DataFrame, path: str, ranges: int, key: str = "registro_operadora") -> None:
    """(campo, pedaco, key): every three-character piece of the searched columns, sorted by piece.

    As many rows as the columns have characters, at most; a filter on the
    piece opens the row groups that may hold it.
    """
    pieces = [register.select(F.lit(c).alias("campo"), F.explode(pieces_of(F.lower(c))).alias("pedaco"), key) for c in SEARCHED_COLUMNS]
    index = pieces[0].unionByName(pieces[1])
    # Neighbouring ranges share a frequent piece, since the key divides it further.
    index.repartitionByRange(ranges, "pedaco", key).sortWithinPartitions("pedaco", key).write.mode("overwrite").parquet(path)


def term_pieces(term: str) -> list[str]:
    """Pieces that every match of a search term holds; a wildcard or an escape ends a run of plain characters."""
    runs = [r.lower() for r in re.split(r"[%_\\]", term)]
    found = {r[i : i + PIECE] for r in runs for i in range(len(r) - PIECE + 1)}
    return sorted(p for p in found if PLAIN_PIECE.fullmatch(p))


def indexed_search(register: DataFrame, index: DataFrame, term: str | None, key: str = "registro_operadora") -> DataFrame:
    """What :func:`serving.search` finds, after the index has narrowed the rows.

    A term without a piece of its own (blank, short, only wildcards) is searched in all rows.
    """
    pieces = term_pieces(term or "")
    if not pieces:
        return search(register, term)
    hits = index.filter(F.col("pedaco").isin(pieces)).groupBy(key, "campo").agg(F.count_distinct("pedaco").alias("n"))
    return search(register.join(hits.filter(F.col("n") == len(pieces)).select(key).distinct(), key, "left_semi"), term)
