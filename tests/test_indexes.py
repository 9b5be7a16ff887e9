"""Paged and searched registers against plain paging and search."""

import pytest

from quartermark.operators import indexes, serving

TERMS = ["saude", "SAÚDE", "a%de", "a_d", "ab", "a", "", None, "%", "100%", "\\\\%", "zzz", "11222", "22.3", "ção pl", "%%é", "l\u0130f"]


@pytest.fixture(scope="module")
def register(spark):
    names = ["Saúde Alfa", "SAUDE beta", "Ação Plena", None, "", "ab", "100% vida", "back\\\\%x", "aXd aaad", "L\u0130FE", "é"]
    rows = [(f"{i:06d}", names[i % len(names)], None if i % 13 == 0 else f"{i * 11222333:014d}") for i in range(257)]
    return spark.createDataFrame(rows, "registro_operadora string, razao_social string, cnpj string")


def test_every_page_equals_offset_paging(spark, register, tmp_path, rows):
    path = str(tmp_path / "pages")
    indexes.write_pages(register, path, 6)
    for number, size in ((1, 10), (2, 100), (3, 100), (4, 100), (13, 20), (26, 10), (257, 1)):
        assert indexes.read_page(spark, path, number, size).collect() == serving.page(register, number, size).collect()
    assert tuple(indexes.page_count(spark, path).first()) == (257, 26)
    with pytest.raises(ValueError):
        indexes.read_page(spark, path, 0)


def test_a_deep_page_opens_one_range(spark, register, tmp_path):
    path = str(tmp_path / "pages")
    indexes.write_pages(register, path, 8)
    page = indexes.read_page(spark, path, 20, 10)
    scanned = page._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [faixa" in scanned and scanned.count("faixa IN") == 0


def test_pages_of_an_empty_register(spark, register, tmp_path):
    path = str(tmp_path / "pages")
    indexes.write_pages(register.filter("false"), path, 4)
    assert tuple(indexes.page_count(spark, path).first()) == (0, 0)


@pytest.mark.parametrize("term", TERMS)
def test_index_finds_what_the_search_finds(spark, register, tmp_path, rows, term):
    path = str(tmp_path / "pieces")
    indexes.write_search_index(register, path, 3)
    index = spark.read.parquet(path)
    assert rows(indexes.indexed_search(register, index, term)) == rows(serving.search(register, term))


def test_index_rows_are_in_proportion_to_the_text(spark, register, tmp_path):
    path = str(tmp_path / "pieces")
    indexes.write_search_index(register, path, 3)
    characters = register.selectExpr("sum(length(razao_social)) + sum(length(cnpj)) AS n").first()["n"]
    assert spark.read.parquet(path).count() <= characters
