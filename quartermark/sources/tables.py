"""Stored tables and exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PERIOD = ("ano", "trimestre")


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A stored table; a partitioned one needs its schema, since folder names carry no types."""
    return (spark.read if schema is None else spark.read.schema(schema)).parquet(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partitions: Sequence[str] = ()) -> None:
    """Parquet. With partitions, rows are first rebalanced by them.

    Rebalancing gathers each partition's rows into few files, and adaptive
    execution splits a partition that is larger than a file should be.
    """
    if partitions:
        balanced = df.hint("rebalance", *[F.col(c) for c in partitions])
        balanced.write.mode(mode).partitionBy(*partitions).parquet(path)
    else:
        df.write.mode(mode).parquet(path)


def append_expenses(consolidated: DataFrame, path: str) -> None:
    """Appends consolidated rows, one folder per year and quarter."""
    write_table(consolidated, path, "append", ("Ano", "Trimestre"))


def export_csv(df: DataFrame, path: str, compressed: bool = False) -> None:
    """``;``-separated UTF-8 with a header and quoted fields, one file per task.

    A null is written as a quoted blank, so it reads back as blank text.
    """
    writer = df.write.mode("overwrite").option("sep", ";").option("header", True)
    writer = writer.option("quoteAll", True).option("escape", '"')
    if compressed:
        writer = writer.option("compression", "gzip")
    writer.csv(path)
