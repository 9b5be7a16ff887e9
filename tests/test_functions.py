import html
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quartermark.functions import labels, links, numbers, periods, text
from quartermark.operators.quality import with_cnpj_check


def values(spark, cells, expression, kind="string"):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], f"i int, c {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("c"))).collect()]


def test_zero_pad_cuts_and_zero_fill_does_not(spark):
    cells = ["7", "1234567", None]
    assert values(spark, cells, lambda c: text.zero_pad(c, 6)) == ["000007", "123456", None]
    assert values(spark, cells, lambda c: text.zero_fill(c, 6)) == ["000007", "1234567", None]


def test_digits_key(spark):
    cells = ["ANS-00041", "", None, "x", "12/3", "99999999999999999999", "-5", "4197.0", " 07 ", "1e5", "+3"]
    assert values(spark, cells, text.digits_key) == [41, 0, 0, 0, 123, 0, 5, 41970, 7, 15, 3]


def test_key_zero_matches_nothing(spark):
    assert values(spark, [0, 5], text.matchable_key, "long") == [None, 5]


def test_lenient_casts(spark):
    assert values(spark, ["", "11", "1x", None], text.lenient_int) == [None, 11, None, None]
    assert [str(v) for v in values(spark, ["2020-02-30", "2020-02-29", ""], text.lenient_date)] == [
        "None", "2020-02-29", "None",
    ]
    assert values(spark, ["True", "false", "maybe", None], text.lenient_bool) == [True, False, None, None]


def test_stored_decimals_round_half_away_from_zero(spark):
    cells = ["1,005", "-1.005", "", "abc", None, "12"]
    assert values(spark, cells, lambda c: text.comma_decimal(c, numbers.MONEY)) == [
        Decimal("1.01"), Decimal("-1.01"), None, None, None, Decimal("12.00"),
    ]


def test_locale_decimal_follows_the_style_of_the_file(spark):
    cells = ["1.234,56", "1234.56", "1d", "nan", " 12 "]
    comma = values(spark, cells, lambda c: numbers.locale_decimal(c, F.lit(True)))
    plain = values(spark, cells, lambda c: numbers.locale_decimal(c, F.lit(False)))
    assert comma == [Decimal("1234.56"), Decimal("123456.00"), None, None, Decimal("12.00")]
    assert plain == [None, Decimal("1234.56"), None, None, Decimal("12.00")]


def test_suspicious(spark):
    assert values(spark, [None, -1, 0, 1], numbers.is_suspicious, "int") == [True, True, True, False]


def test_growth_without_start_is_null(spark):
    df = spark.createDataFrame([(Decimal(0), Decimal(5)), (Decimal(4), Decimal(5))], "a decimal(20,2), b decimal(20,2)")
    got = [r[0] for r in df.select(numbers.growth_percent(F.col("a"), F.col("b"))).collect()]
    assert got == [None, Decimal("25.00")]


def test_dates_are_day_first_and_strict(spark):
    cells = ["01/04/2025", "13/04/2025", "2025-07-01", "31/31/2025", "", None]
    quarters = values(spark, cells, lambda c: periods.date_quarter(periods.parse_date(c)))
    assert quarters == ["2T", "2T", "3T", None, None, None]


@pytest.mark.parametrize(
    ("path", "period"),
    [
        ("file:/d/csv/2025/1T/a.csv", (2025, "1T")),
        ("file:/d/csv/2025/T2/a.csv", (2025, "2T")),
        ("file:/d/csv/2025/3/a.csv", (2025, "3T")),
        ("file:/d/csv/2025/4T2025/a.csv", (2025, "4T")),
        ("file:/d/csv/2025/1t/sub/a.csv", (2025, "1T")),
        ("file:/d/csv/ano=2025/trimestre=2T/a.csv", (2025, "2T")),
        ("file:/d/csv/2025/12T/a.csv", (None, None)),
        ("file:/d/csv/2025/a.csv", (None, None)),
        ("file:/d/12025/1T/a.csv", (None, None)),
    ],
)
def test_period_from_folders(spark, path, period):
    year = values(spark, [path], periods.path_year)[0]
    quarter = values(spark, [path], periods.path_quarter)[0]
    assert (year, quarter) == period


def test_keywords_ignore_case_and_null(spark):
    from quartermark.schemas import CLAIM_KEYWORDS

    cells = ["DESPESAS COM EVENTOS X", "despesa com sinistro", "Evento / Sinistro", "Receita", None]
    got = values(spark, cells, lambda c: text.matches_any_keyword(c, CLAIM_KEYWORDS))
    assert got == [True, True, True, False, False]


def test_cnpj(spark):
    cells = ["11.222.333/0001-81", "11222333000182", "11222333000191", "00000000000000", "1" * 14, "112223330001811", "191", None]
    df = spark.createDataFrame(list(enumerate(cells)), "i int, cnpj string").orderBy("i")
    got = [r["cnpj_valido"] for r in with_cnpj_check(df).collect()]
    assert got == [True, False, False, False, False, False, True, False]


def test_links_skip_comments_scripts_and_other_attributes(spark):
    html = """<!-- <a href="no1"> --><script>"<a href='no2'>"</script><a data-href="no3" href="1T.zip">x</a>
    <A class=q HREF = '2025/'>y</A><a href=plain.csv>z</a><a href="a&amp;b.pdf"/><abbr href="no4">"""
    assert values(spark, [html], links.hrefs) == [["1T.zip", "2025/", "plain.csv", "a&b.pdf"]]


def test_link_kind_and_name(spark):
    cells = ["../", "./", "?C=N", "", None, "1T.ZIP", "x.rar", "1T/", "readme"]
    assert values(spark, cells, links.link_kind) == [
        "ignored", "ignored", "ignored", "ignored", "ignored", "file", "file", "folder", "ignored",
    ]
    assert values(spark, ["1T.zip", "/1T.ZIP", "1T/", "2025"], links.item_name) == ["1T", "1T", "1T", "2025"]
    got = values(spark, ["http://h/a.csv", "a.csv"], lambda c: links.absolute_url(F.lit("http://b/"), c))
    assert got == ["http://h/a.csv", "http://b/a.csv"]


def test_labels(spark):
    assert values(spark, ["x" * 20, "y" * 21], labels.truncate_label) == ["x" * 20, "y" * 20 + "..."]
    money = values(spark, [Decimal("1234567.89"), Decimal("-0.50"), None], labels.currency_label, "decimal(15,2)")
    assert money == ["R$\u00a01.234.567,89", "-R$\u00a00,50", None]
    assert values(spark, [Decimal("0.125")], labels.currency_label, "decimal(15,3)") == ["R$\u00a00,13"]
    assert values(spark, [None, 11], lambda c: labels.phone_label(c, F.lit("33")), "int") == ["() 33", "(11) 33"]
    assert values(spark, ["1T"], labels.quarter_title) == ["1Tº Trimestre"]


def test_dates_in_every_form(spark):
    from pyspark.sql import functions as F

    from quartermark.functions import periods, text

    forms = [" 2025-04-01", "20250401", "2025/04/01", "2025-04-01T10:00:00.000", "01/04/2025 00:00:00", "1/4/2025", "2025-4-1"]
    bad = ["2025", "2025-04", "2025-13-01", "31/02/2025", "x", "", None, "202504011", "2025-04/01"]
    df = spark.createDataFrame([(f,) for f in forms + bad], "t string")
    got = [r[0] for r in df.select(periods.parse_date(F.col("t")).cast("string")).collect()]
    assert got == ["2025-04-01"] * len(forms) + [None] * len(bad)
    plain = spark.createDataFrame([("2020-1-5",), ("2020-01-05",), ("2020",), ("05/01/2020",), (None,)], "t string")
    assert [r[0] for r in plain.select(text.lenient_date(F.col("t")).cast("string")).collect()] == ["2020-01-05"] * 2 + [None] * 3


def test_targets_end_with_their_quotes(spark):
    from pyspark.sql import functions as F

    from quartermark.functions import links

    html = """<a href="x"class="y"> <a class=z href='b c'> <a href=d/e> <a title="t" href="&#x2F;q?a=1&amp;b"> <a href="">"""
    got = spark.createDataFrame([(html,)], "h string").select(links.hrefs(F.col("h"))).first()[0]
    assert got == ["x", "b c", "d/e", "/q?a=1&b", ""]


def test_rows_without_a_quarter_belong_to_no_period(spark):
    from quartermark.operators.periods import latest_only

    rows = [(2024, "1T"), (2024, "2T"), (2025, None), (None, "3T"), (2025, "1T")]
    df = spark.createDataFrame(rows, "ano int, trimestre string")
    assert sorted(tuple(r) for r in latest_only(df, 2).collect()) == [(2024, "2T"), (2025, "1T")]


def test_character_references(spark):
    cells = [
        "a&amp;b", "&amp;lt;", "&eacute;&ccedil;&atilde;o.csv", "&#231;&#xE7;&#XE7;", "&#128;&#x80;&#129;", "&#0;&#xD800;&#x110000;",
        "&nada;&", "&amp", "&fjlig;", "&#x1F600;", "", None, "sem", "&#999999999;", "a\n&lt;b", "&;&#;&#x;",
    ]
    got = values(spark, cells, links.unescape)
    named = {"&nada;&", "&amp"}  # a reference needs its semicolon
    assert got == [c if c in named or c is None else html.unescape(c) for c in cells]
