"""Plain joins: rows without a key, a key with a third of the rows, and how adaptive execution splits it."""

import pytest
from pyspark.sql import functions as F

from quartermark.operators import enrich

TIGHT = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def tight(spark):
    before = {k: spark.conf.get(k, None) for k in TIGHT}
    for k, v in TIGHT.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def skewed(spark):
    """A third of the rows share one operator, a sixth have none, the rest are spread."""
    n = F.col("id")
    key = F.when(n % 3 == 0, F.lit("7")).when(n % 6 == 1, F.lit("S/N")).otherwise((n % 500).cast("string"))
    return spark.range(0, 60_000, 1, 8).select(key.alias("REG_ANS"), n.alias("v"))


def test_left_join_keeps_every_row(spark, skewed, rows):
    register = spark.range(0, 500, 2).selectExpr("id AS reg_key", "concat('n', id) AS razao_social", "'A' AS uf", "'1' AS cnpj")
    joined = enrich.enrich(skewed, register)
    names = {str(k): f"n{k}" for k in range(2, 500, 2)}
    got = rows(joined.select("REG_ANS", "v", "razao_social"))
    missing = "RAZAO SOCIAL NAO LOCALIZADA"
    assert got == sorted(((r["REG_ANS"], r["v"], names.get(r["REG_ANS"], missing)) for r in skewed.collect()), key=repr)
    assert enrich.unmatched(skewed, register).count() == sum(r[2] == missing for r in got)


def test_a_hot_operator_is_split(tight, skewed):
    register = tight.range(500).selectExpr("id AS reg_key", "concat('n', id) AS razao_social", "'A' AS uf", "'1' AS cnpj")
    joined = enrich.enrich(skewed, register)
    joined.write.format("noop").mode("overwrite").save()
    plan = joined._jdf.queryExecution()
    joined.collect()
    assert "SortMergeJoin(skew=true)" in plan.executedPlan().toString()
