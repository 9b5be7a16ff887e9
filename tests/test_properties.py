"""Generated inputs; each example batch is one Spark job."""

from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quartermark.functions import labels, numbers
from quartermark.operators.enrich import known_only
from quartermark.operators.quality import with_cnpj_check
from quartermark.operators.serving import state_totals, top_states_and_rest

FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def complete(base: str) -> str:
    """Appends both check digits, by the definition in words."""
    digits = [int(c) for c in base]
    for _ in range(2):
        total = sum(n * (2 + i % 8) for i, n in enumerate(reversed(digits)))
        rest = total % 11
        digits.append(0 if rest < 2 else 11 - rest)
    return "".join(map(str, digits))


bases = st.text("0123456789", min_size=12, max_size=12).filter(lambda b: len(set(complete(b))) > 1)


@FEW
@given(st.lists(bases, min_size=20, max_size=20), st.integers(12, 13), st.integers(1, 9))
def test_check_digits(spark, codes, position, shift):
    good = [complete(b) for b in codes]
    bad = [c[:position] + str((int(c[position]) + shift) % 10) + c[position + 1 :] for c in good]
    df = spark.createDataFrame([(c, True) for c in good] + [(c, False) for c in bad], "c string, ok boolean")
    checked = with_cnpj_check(df, "c", "valid")
    assert checked.filter("ok <> valid").count() == 0


cents = st.integers(-(10**14), 10**14)


@FEW
@given(st.lists(cents, min_size=20, max_size=20))
def test_money_text_reads_back(spark, amounts):
    df = spark.createDataFrame([(Decimal(c).scaleb(-2),) for c in amounts], "v decimal(15,2)".replace("15", "17"))
    df = df.filter(F.abs("v") < Decimal(10**13)).select(F.col("v").cast("decimal(15,2)").alias("v"))
    written = F.replace(labels.currency_label(F.col("v")), F.lit(labels.CURRENCY_SYMBOL), F.lit(""))
    back = df.select("v", numbers.locale_decimal(written, F.lit(True)).alias("w"))
    assert back.filter("v <> w OR w IS NULL").count() == 0


totals = st.lists(st.tuples(st.sampled_from(["", "AC", "BA", "CE", "DF", "ES", "GO", None]), st.integers(1, 10**6)), min_size=1)


@FEW
@given(totals)
def test_remainder_loses_nothing(spark, data):
    gold = spark.createDataFrame([(u, Decimal(v)) for u, v in data], "uf string, valor_total decimal(20,2)")
    total = lambda df: df.agg(F.sum("total")).first()[0]
    assert total(top_states_and_rest(gold)) == total(state_totals(gold)) == sum(Decimal(v) for _, v in data)
    assert top_states_and_rest(gold).count() <= 6


keys = st.one_of(st.none(), st.sampled_from([1, 1, 1, 2, 3]), st.integers(0, 50))


@FEW
@given(st.lists(keys, min_size=1, max_size=60), st.sets(st.integers(0, 50)))
def test_semi_and_anti_split_all_rows(spark, left, right):
    rows = spark.createDataFrame([(k, i) for i, k in enumerate(left)], "registro_operadora long, v long")
    register = spark.createDataFrame([(k,) for k in right], "registro_operadora long")
    semi = {r["v"] for r in known_only(rows, register).collect()}
    anti = {r["v"] for r in rows.join(register, "registro_operadora", "left_anti").collect()}
    assert semi == {i for i, k in enumerate(left) if k in right}
    assert semi | anti == set(range(len(left))) and not semi & anti
