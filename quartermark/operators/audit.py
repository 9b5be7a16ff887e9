"""Integrity rules of the stored tables, as queries over violations."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their number of rows.

    Partial counts come before the shuffle, so a key with very many copies
    is no burden.
    """
    return (
        df.groupBy(F.col(key).cast("string").alias("chave"))
        .agg(F.count("*").alias("linhas"))
        .filter("linhas > 1")
        .select(F.lit(key).alias("coluna"), "chave", "linhas")
    )


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of nulls per column, all columns in one pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def too_wide_counts(df: DataFrame, widths: Mapping[str, int]) -> DataFrame:
    return df.agg(*[F.count_if(F.length(F.col(c)) > w).alias(c) for c, w in widths.items()])


def orphans(facts: DataFrame, register: DataFrame) -> DataFrame:
    """Facts whose register number is unknown, counted per number before the join."""
    counted = facts.groupBy("registro_operadora").agg(F.count("*").alias("linhas"))
    return counted.join(register.select("registro_operadora"), "registro_operadora", "left_anti")


def write_checked(df: DataFrame, path: str, required: Sequence[str], widths: Mapping[str, int]) -> DataFrame:
    """Writes a table and checks it in the same pass: (regra, coluna, linhas).

    Rows that break a rule go to a folder of their own beside the others (see
    :func:`read_checked`). The counts are observed while rows are written, so
    the table is not read again; they are as many as there are rules.
    """
    broken = {("obrigatoria", c): F.col(c).isNull() for c in required}
    broken |= {("largura", c): F.coalesce(F.length(c) > w, F.lit(False)) for c, w in widths.items()}
    seen = Observation(uuid.uuid4().hex)
    any_broken = F.lit(False)
    for rule in broken.values():
        any_broken = any_broken | rule
    metrics = [F.count_if(rule).alias(f"{kind}|{column}") for (kind, column), rule in broken.items()]
    metrics += [F.count_if(any_broken).alias("rejeitada|"), F.count(F.lit(1)).alias("lida|")]
    df.observe(seen, *metrics).withColumn("valida", ~any_broken).write.mode("overwrite").partitionBy("valida").parquet(path)
    counts = [(*name.split("|", 1), n) for name, n in seen.get.items()]
    return df.sparkSession.createDataFrame(counts, "regra string, coluna string, linhas long")


def read_checked(spark: SparkSession, path: str, schema: T.StructType, valid: bool = True) -> DataFrame:
    """The rows of a checked table that keep all rules, or those that break one; only their folder is opened."""
    stored = T.StructType([*schema.fields, T.StructField("valida", T.BooleanType())])
    return spark.read.schema(stored).parquet(path).filter(F.col("valida") == F.lit(valid)).drop("valida")
