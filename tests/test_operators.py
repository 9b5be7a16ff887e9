from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from quartermark.operators import aggregates, align, audit, dedup, enrich, normalize, periods, quality, serving
from quartermark.operators.register import keyed_register, typed_register
from quartermark.plans import analytics, load, report
from quartermark.schemas import MISSING_NAME, REGISTER_COLUMNS, REPORT_COLUMNS

EXPENSES = "REG_ANS string, Trimestre string, Ano int, ValorDespesas decimal(15,2), DespesasSuspeitas boolean"
FACTS = "registro_operadora string, trimestre string, ano int, valor_despesas decimal(15,2)"
REGISTER = "registro_operadora string, cnpj string, razao_social string, modalidade string, uf string, arrival int"


def test_layout_prefers_synonyms_in_order():
    found = align.resolve_layout([" vl_movimento ", "VALOR", "cd_conta_contabil", "Cod_ANS", "NM_CONTA", "data"])
    assert found.value == (1, 0) and found.key == (3,) and found.description == (4,) and found.date == (5,)
    assert found.problem is None


@pytest.mark.parametrize(
    ("headers", "problem"),
    [
        (["REG_ANS", "DESC"], "no_value_column"),
        (["REG_ANS", "VALOR"], "no_description_column"),
        (["DESC", "VALOR", "CD_CONTA_CONTABIL"], "no_key_column"),
        (["DESC", "VALOR", "CD_X"], None),
    ],
)
def test_unusable_layouts(headers, problem):
    assert align.resolve_layout(headers).problem == problem


def test_register_columns_by_substring(spark):
    found = align.resolve_register(["DATA_REGISTRO_OPERADORA", "Registro_da_Operadora", "CNPJ", "Nome", "Sigla_UF"])
    assert found == {
        "registro_operadora": "Registro_da_Operadora", "cnpj": "CNPJ", "razao_social": "Nome", "uf": "Sigla_UF",
    }
    with pytest.raises(ValueError):
        align.resolve_register(["CNPJ"])


def test_mixed_dates_take_the_folder_per_row(spark, rows):
    df = spark.createDataFrame(
        [("2024-05-01", "f:/2025/1T/a"), ("bad", "f:/2025/1T/a"), (None, "f:/x/a")], "data string, source_file string"
    )
    assert rows(normalize.with_period(df).select("Ano", "Trimestre")) == sorted(
        [(2024, "2T"), (2025, "1T"), (None, None)], key=repr
    )


def test_one_comma_decides_for_its_file_only(spark, rows):
    df = spark.createDataFrame([("a", "1.500"), ("a", "2,5"), ("b", "1.500"), ("b", None)], "source_file string, valor string")
    got = rows(normalize.with_locale_value(df).select("source_file", "ValorDespesas"))
    assert got == sorted([("a", D("1500.00")), ("a", D("2.50")), ("b", D("1.50")), ("b", None)], key=repr)


@pytest.fixture
def register(spark):
    return spark.createDataFrame(
        [
            ("000001", "11222333000181", "ALFA", "M", "SP", 2),
            ("1", "11222333000182", "ALFA ANTIGA", "M", "RJ", 1),
            ("2", None, "BETA", None, None, 3),
            ("S/N", "9", "SEM NUMERO", "M", "SP", 4),
            (None, "8", "NULO", "M", "SP", 5),
        ],
        REGISTER,
    )


def test_register_keeps_the_first_row_and_drops_key_zero(register, rows):
    got = rows(keyed_register(register, ["arrival"]).select("reg_key", "razao_social"))
    assert got == [(1, "ALFA ANTIGA"), (2, "BETA")]


def test_register_may_be_deduplicated_by_another_column(spark, rows):
    df = spark.createDataFrame(
        [("1", "7", "A", "M", "SP", 1), ("2", "7", "B", "M", "SP", 2), ("3", "8", "C", "M", "SP", 3)], REGISTER
    )
    got = rows(keyed_register(df, ["arrival"], key="cnpj").select("reg_key"))
    assert got == [(1,), (3,)]


def test_typed_register_first_wins_after_padding(spark, rows):
    staged = spark.createDataFrame(
        [("7", "1", "x", "", "2020-01-31", 2), ("000007", "2", "y", "11", "bad", 1), ("1234567", "3", "z", "a", None, 3)],
        "registro_operadora string, cnpj string, razao_social string, ddd string, data_registro_ans string, arrival int",
    )
    got = rows(typed_register(staged, ["arrival"], ["registro_operadora", "cnpj", "ddd", "data_registro_ans"]))
    assert got == [("000007", "00000000000002", 11, None), ("123456", "00000000000003", None, None)]


@pytest.fixture
def expenses(spark):
    return spark.createDataFrame(
        [
            ("1", "1T", 2025, D("10.00"), False),
            ("ANS 000001", "1T", 2025, D("5.00"), False),
            ("1", "2T", 2025, D("25.00"), False),
            ("2", "1T", 2025, D("8.00"), False),
            ("2", "1T", 2025, D("-3.00"), True),
            ("S/N", "1T", 2025, D("2.00"), False),
            (None, "2T", 2025, D("4.00"), False),
            ("99", "2T", 2025, None, True),
        ],
        EXPENSES,
    )


def test_enrich_keeps_every_row_and_fills_defaults(expenses, register, rows):
    reg = keyed_register(register, ["arrival"])
    full = enrich.enrich(expenses, reg)
    assert full.count() == expenses.count()
    unmatched = full.filter(F.col("razao_social") == MISSING_NAME)
    assert {r["uf"] for r in unmatched.collect()} == {"INDETERMINADO"} and unmatched.count() == 3
    assert full.filter("reg_key = 2").first()["cnpj"] == "NAO ENCONTRADO"
    assert enrich.unmatched(expenses, reg).count() == 3


def test_report_columns_and_flags(expenses, register):
    out = report.validated_report(expenses, keyed_register(register, ["arrival"]))
    assert out.columns == list(REPORT_COLUMNS)
    got = {(r["REG_ANS"], r["ValorDespesas"]): tuple(r)[-3:] for r in out.collect()}
    assert got[(1, D("10.00"))] == (True, False, False)
    assert got[(2, D("-3.00"))] == (True, False, True)
    assert got[(0, D("2.00"))] == (True, True, False)
    assert got[(99, D("0.00"))] == (True, True, True)


def test_existing_value_flag_is_kept(spark):
    df = spark.createDataFrame([("1", "x", D(5), "true")], "cnpj string, razao_social string, ValorDespesas decimal(15,2), FLAG_VALOR_INVALIDO string")
    assert quality.with_flags(df).first()["FLAG_VALOR_INVALIDO"] is True


def test_absent_report_column_is_null(spark):
    df = spark.createDataFrame([(1, "1", "x", "SP", D(5))], "reg_key long, cnpj string, razao_social string, uf string, ValorDespesas decimal(15,2)")
    row = quality.report(df).first()
    assert row["Modalidade"] is None and row["Trimestre"] is None


def test_statistics(expenses, register, rows):
    got = rows(aggregates.operator_statistics(expenses, keyed_register(register, ["arrival"])))
    assert got == sorted(
        [
            ("ALFA ANTIGA", "RJ", D("40.00"), D("20.00"), D("7.07")),
            ("BETA", "INDETERMINADO", D("8.00"), D("8.00"), D("0.00")),
            (MISSING_NAME, "INDETERMINADO", D("6.00"), D("3.00"), D("1.41")),
        ],
        key=repr,
    )


def test_statistics_from_the_report_agree(expenses, register, rows):
    reg = keyed_register(register, ["arrival"])
    direct = aggregates.operator_statistics(expenses, reg)
    assert rows(aggregates.report_statistics(report.validated_report(expenses, reg))) == rows(direct)


def test_statistics_may_leave_out_flagged_rows(expenses, register, rows):
    reg = keyed_register(register, ["arrival"])
    names = lambda *flags: {r[0] for r in rows(aggregates.operator_statistics(expenses, reg, flags))}
    assert names("FLAG_RAZAO_SOCIAL_INVALIDA") == {"ALFA ANTIGA", "BETA"}
    assert names("FLAG_CNPJ_INVALIDO") == set()


def test_statistics_of_nothing_keep_their_columns(expenses, register):
    out = aggregates.operator_statistics(expenses.filter("ValorDespesas < 0"), keyed_register(register, ["arrival"]))
    assert out.count() == 0
    assert out.columns == ["razao_social", "uf", "valor_total", "media_trimestral", "desvio_padrao"]


def test_null_group_keys_are_no_group(spark):
    df = spark.createDataFrame([(None, "SP", 1, "1T", 5)], "razao_social string, uf string, ano int, trimestre string, valor int")
    assert aggregates.quarterly_sum(df).count() == 0


def test_first_row_and_largest_state(spark, rows):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, None), ("b", 1, "z")], "k string, o int, v string")
    assert rows(dedup.keep_first(df, ["k"], [F.col("o")])) == [("a", 1, None), ("b", 1, "z")]
    stats = spark.createDataFrame(
        [("A", "SP", D(5)), ("A", "RJ", D(5)), ("A", "AC", D(1)), ("B", None, None)], "razao_social string, uf string, valor_total decimal(20,2)"
    )
    assert rows(dedup.keep_largest_state(stats)) == [("A", "RJ", D("5.00")), ("B", None, None)]


def test_fact_load_drops_suspicious_and_unknown(spark, rows):
    staged = spark.createDataFrame(
        [("7", "1T", "2025", "1,50", "False"), ("7", "1T", "2025", "-1", "True"), ("8", "1T", "2025", "1", "False"), ("7", "2T", "", "x", "false")],
        "reg_ans string, trimestre string, ano string, valor_despesas string, despesas_suspeitas string",
    )
    op = spark.createDataFrame([("000007",)], "registro_operadora string")
    got = rows(load.load_expenses(staged, op))
    assert got == sorted([("000007", "1T", 2025, D("1.50")), ("000007", "2T", None, None)], key=repr)


def test_load_statistics_keeps_one_row_per_name(spark, rows):
    staged = spark.createDataFrame(
        [("A", "SP", "1,50", "1", ""), ("A", "RJ", "2.50", "1", "0")],
        "razao_social string, uf string, valor_total string, media_trimestral string, desvio_padrao string",
    )
    assert rows(load.load_statistics(staged)) == [("A", "RJ", D("2.50"), D("1.00"), D("0.00"))]


@pytest.fixture
def facts(spark):
    return spark.createDataFrame(
        [
            ("000001", "4T", 2024, D(10)), ("000001", "2T", 2025, D(30)),
            ("000002", "4T", 2024, D(0)), ("000002", "2T", 2025, D(9)),
            ("000003", "1T", 2025, D(50)), ("000003", "2T", 2025, D(20)), ("000003", "4T", 2024, D(40)),
            ("000009", "4T", 2024, D(1)), ("000009", "2T", 2025, D(100)),
        ],
        FACTS,
    )


@pytest.fixture
def dimension(spark):
    return spark.createDataFrame(
        [("000001", "1", "A", "SP"), ("000002", "2", "B", "SP"), ("000003", "3", "C", "RJ")],
        "registro_operadora string, cnpj string, razao_social string, uf string",
    )


def test_growth(facts, dimension):
    got = [tuple(r) for r in analytics.growth_leaders(facts, dimension).collect()]
    assert got == [("A", D("10.00"), D("30.00"), D("200.00")), ("C", D("40.00"), D("20.00"), D("-50.00"))]


def test_growth_with_a_single_period(facts, dimension):
    got = analytics.growth_leaders(facts.filter("ano = 2024"), dimension).collect()
    assert {r["crescimento_percentual"] for r in got} == {D("0.00")}


def test_states(facts, dimension):
    got = [tuple(r) for r in analytics.state_leaders(facts, dimension).collect()]
    assert got == [("RJ", D("110.00"), 1, D("110.00")), ("SP", D("49.00"), 2, D("24.50"))]


def test_above_market(facts):
    # 2024 4T mean 12.75: operator 3; 2025 1T: none; 2025 2T mean 39.75: operator 9.
    assert analytics.above_market(facts, 1).first()[0] == 2
    assert analytics.above_market(facts).first()[0] == 0


def test_newest_periods(facts, rows):
    assert rows(periods.newest_periods(facts, 2)) == [(2025, "1T"), (2025, "2T")]
    assert periods.latest_only(facts, 2).count() == 5
    assert periods.latest_only(facts.filter("false"), 2).count() == 0


def test_search_paging_lookup(dimension, rows):
    assert serving.search(dimension, "").count() == 3
    assert rows(serving.search(dimension, "b").select("razao_social")) == [("B",)]
    assert serving.search(dimension, "_").count() == 3
    assert rows(serving.page(dimension, 2, 2).select("registro_operadora")) == [("000003",)]
    with pytest.raises(ValueError):
        serving.page(dimension, 0, 10)
    with pytest.raises(ValueError):
        serving.page(dimension, 1, 101)
    assert tuple(serving.search_count(dimension, None, 2).first()) == (3, 2)
    assert serving.find_operator(dimension, "00.00-0/2").first()["razao_social"] == "B"
    assert serving.find_operator(dimension, "nope").count() == 0


def test_history_pads_and_sorts(facts):
    got = [tuple(r) for r in serving.expense_history(facts, " 3 ").collect()]
    assert got == [("2T", 2025, D("20.00")), ("1T", 2025, D("50.00")), ("4T", 2024, D("40.00"))]


@pytest.fixture
def gold(spark):
    data = [("a", "SP", D(9)), ("b", None, D(5)), ("c", "", D(4)), ("d", "RJ", D(3)), ("e", "MG", D(2)), ("f", "BA", D(1)), ("g", "AC", D(1)), ("h", "AM", None)]
    return spark.createDataFrame(data, "razao_social string, uf string, valor_total decimal(20,2)")


def test_dashboard(spark, gold):
    assert tuple(serving.dashboard_totals(gold).first()) == (D("25.00"), D("3.57"))
    assert tuple(serving.dashboard_totals(gold.filter("false")).first()) == (D("0.00"), D("0.00"))
    assert [r["razao_social"] for r in serving.top_operators(gold).collect()] == ["a", "b", "c", "d", "e"]
    by_state = [tuple(r) for r in serving.state_totals(gold).collect()]
    assert by_state[:3] == [("SP", D("9.00")), ("N/A", D("5.00")), ("N/A", D("4.00"))] and by_state[-1] == ("AM", None)
    slices = [tuple(r) for r in serving.top_states_and_rest(gold).collect()]
    assert slices[:3] == by_state[:3] and slices[-1] == ("Outros", D("2.00")) and len(slices) == 6


def test_no_remainder_without_other_states(gold):
    assert serving.top_states_and_rest(gold.limit(3)).count() == 3
    assert serving.top_states_and_rest(gold.filter("uf = 'AM'")).collect()[0]["uf"] == "AM"


def test_audits(spark, facts, dimension, rows):
    doubled = dimension.unionByName(dimension.limit(1))
    assert audit.duplicate_keys(doubled, "cnpj").count() == 1
    assert audit.duplicate_keys(dimension, "cnpj").count() == 0
    assert tuple(audit.null_counts(dimension.withColumn("uf", F.lit(None)), ["uf", "cnpj"]).first()) == (3, 0)
    assert tuple(audit.too_wide_counts(dimension, {"registro_operadora": 5, "uf": 2}).first()) == (3, 0)
    assert rows(audit.orphans(facts, dimension)) == [("000009", 2)]
    matched = enrich.known_only(facts, dimension).count()
    assert matched + sum(r["linhas"] for r in audit.orphans(facts, dimension).collect()) == facts.count()


def test_register_schema_has_twenty_columns():
    assert len(REGISTER_COLUMNS) == 20
