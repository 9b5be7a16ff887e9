"""Appends that run again, later loads into a filled table, checked writes, merged statistics."""

from decimal import Decimal as D

from pyspark.sql import functions as F
from pyspark.sql import types as T

from quartermark.operators.aggregates import merged_state, statistics, statistics_of_state, statistics_state
from quartermark.sources.commits import CommittedTable

ROW = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.IntegerType()), T.StructField("ano", T.IntegerType())])


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, v int, ano int, source_file string")


def test_append_that_runs_again_adds_nothing(spark, tmp_path, rows):
    table = CommittedTable(spark, str(tmp_path / "t"), ROW, ("ano",))
    assert table.read().count() == 0
    first = frame(spark, [("a", 1, 2024, "x.csv"), ("a", 1, 2024, "x.csv"), ("b", 2, None, "y.csv")])
    for _ in range(2):
        table.append(first)
    assert rows(table.read()) == [("a", 1, 2024), ("a", 1, 2024), ("b", 2, None)]
    table.append(first.unionByName(frame(spark, [("c", None, 2025, "z.csv")])))
    assert rows(CommittedTable(spark, str(tmp_path / "t"), ROW, ("ano",)).read())[2:] == [("b", 2, None), ("c", None, 2025)]
    assert rows(table.commits().select("source")) == [("x.csv",), ("y.csv",), ("z.csv",)]


def test_a_batch_without_its_commit_is_not_seen(spark, tmp_path, rows):
    table = CommittedTable(spark, str(tmp_path / "t"), ROW)
    table.append(frame(spark, [("a", 1, 1, "x")]))
    lost = frame(spark, [("b", 2, 2, "y")]).withColumn("batch", F.lit("lost")).withColumnRenamed("source_file", "_source")
    lost.write.mode("append").partitionBy("batch").parquet(f"{tmp_path}/t/rows")
    assert rows(table.read()) == [("a", 1, 1)]
    table.append(frame(spark, [("b", 2, 2, "y")]))
    assert rows(table.read()) == [("a", 1, 1), ("b", 2, 2)]


def test_the_first_load_of_a_key_wins(spark, tmp_path, rows):
    table = CommittedTable(spark, str(tmp_path / "t"), ROW)
    table.insert_absent(frame(spark, [("a", 1, 1, ""), ("b", 1, 1, "")]), ["k"], "one")
    for _ in range(2):
        table.insert_absent(frame(spark, [("b", 2, 2, ""), ("c", 2, 2, ""), (None, 2, 2, "")]), ["k"], "two")
    table.insert_absent(frame(spark, [("a", 3, 3, "")]), ["k"], "three")
    assert rows(table.read()) == [("a", 1, 1), ("b", 1, 1), ("c", 2, 2), (None, 2, 2)]


def test_merged_statistics_equal_those_of_all_quarters(spark, rows):
    values = [("A", "SP", q, D(q * q + q % 3)) for q in range(9)] + [("B", None, 1, D("0.10")), ("C", "RJ", 8, D("7.77"))]
    quarters = spark.createDataFrame(values, "razao_social string, uf string, q int, valor decimal(20,2)")
    parts = [statistics_state(quarters.filter(c)) for c in ("q < 2", "q BETWEEN 2 AND 6", "q > 6")]
    merged = merged_state(merged_state(parts[0], parts[1]), parts[2])
    assert rows(statistics_of_state(merged)) == rows(statistics(quarters))
    nothing = statistics_state(quarters.filter("q > 100"))
    assert rows(statistics_of_state(merged_state(nothing, merged))) == rows(statistics(quarters))


def test_checks_are_counted_while_rows_are_written(spark, tmp_path, rows):
    from quartermark.operators.audit import read_checked, write_checked

    values = [("a", "xx"), (None, "x"), ("b", "xxxx"), (None, "xxxxx"), ("c", None)]
    table = spark.createDataFrame(values, "k string, t string")
    found = write_checked(table, str(tmp_path / "t"), ["k"], {"t": 3})
    assert rows(found) == [("largura", "t", 2), ("lida", "", 5), ("obrigatoria", "k", 2), ("rejeitada", "", 3)]
    assert rows(read_checked(spark, str(tmp_path / "t"), table.schema)) == [("a", "xx"), ("c", None)]
    assert rows(read_checked(spark, str(tmp_path / "t"), table.schema, False)) == [("b", "xxxx"), (None, "x"), (None, "xxxxx")]
    empty = write_checked(table.filter("false"), str(tmp_path / "e"), ["k"], {})
    assert rows(empty) == [("lida", "", 0), ("obrigatoria", "k", 0), ("rejeitada", "", 0)]


def test_more_date_forms(spark):
    from quartermark.functions.periods import parse_date

    forms = {
        "2024-03-05": "2024-03-05", "05-03-2024": "2024-03-05", "5/3/2024": "2024-03-05", "05-03/2024": None,
        "2024-03-05T10:11:12Z": "2024-03-05", "2024-03-05 10:11:12.5-03:00": "2024-03-05", "05/03/2024 10:11+0300": "2024-03-05",
        "2024-13-05": None, "31-02-2024": None, "2024": None, "2024-03": None, " 2024-3-5": "2024-03-05", "20240305": "2024-03-05", "": None,
    }
    df = spark.createDataFrame([(k,) for k in forms], "t string").select("t", parse_date(F.col("t")).cast("string").alias("d"))
    assert {r["t"]: r["d"] for r in df.collect()} == forms
