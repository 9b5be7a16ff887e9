"""Physical plans: no Python in the hot path, no cross joins, small scans."""

import pytest

from quartermark import datasets as d
from quartermark.operators.periods import latest_only
from quartermark.plans import analytics
from quartermark.plans.registry import QUERIES
from quartermark.sources.tables import write_table

# These run a whole batch first; the tables they read are planned like those of other queries.
FILE_QUERIES = {"batch_facts", "batch_report", "batch_statistics", "batch_gold", "batch_register"}
TOP = {"growth_top5", "uf_total_avg", "dashboard_top5", "search_page", "lookup_identifier"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in FILE_QUERIES])
def test_plan(name, spark, sf_dir):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert node not in plan
    # A window here would hold all rows of one key in one task.
    assert "Window" not in plan
    if name in TOP:
        assert "TakeOrderedAndProject" in plan


def test_scans_read_only_the_columns_they_need(spark, sf_dir):
    plan = plan_of(QUERIES["dashboard_totals"](spark, sf_dir))
    assert "o_orderpriority" not in plan and "o_orderstatus" not in plan
    assert "c_acctbal" not in plan


def test_equality_filter_reaches_a_stored_table(spark, sf_dir, tmp_path):
    from quartermark.operators.serving import expense_history

    path = str(tmp_path / "facts")
    write_table(d.facts(spark, sf_dir), path)
    assert "EqualTo(registro_operadora,000074)" in plan_of(expense_history(spark.read.parquet(path), "74"))


def test_period_queries_prune_partitions(spark, sf_dir, tmp_path):
    path = str(tmp_path / "facts")
    write_table(d.facts(spark, sf_dir), path, partitions=("ano", "trimestre"))
    stored = spark.read.parquet(path)
    assert "PartitionFilters: [isnotnull(ano" in plan_of(latest_only(stored))
    register = d.register(spark, sf_dir, "registro_operadora", "razao_social")
    assert "PartitionFilters: [(((ano" in plan_of(analytics.growth_leaders(stored, register))


def test_market_totals_are_shuffled_once(spark, sf_dir):
    df = QUERIES["above_market_avg"](spark, sf_dir)
    df.collect()
    assert "ReusedExchange" in plan_of(df)
