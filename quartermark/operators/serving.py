"""Search, paging, lookup, history and dashboard views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermark.functions import labels, text
from quartermark.schemas import TOTAL

MAX_PAGE_SIZE = 100


def search(register: DataFrame, term: str | None) -> DataFrame:
    """Case-insensitive substring search in name and tax id.

    ``%`` and ``_`` in the term act as wildcards; no term means no filter.
    """
    if not term:
        return register
    pattern = f"%{term}%"
    return register.filter(F.col("razao_social").ilike(pattern) | F.col("cnpj").ilike(pattern))


def page(register: DataFrame, number: int = 1, size: int = 10) -> DataFrame:
    """One page in register order, so that pages neither overlap nor miss rows."""
    if number < 1 or not 1 <= size <= MAX_PAGE_SIZE:
        raise ValueError("page starts at 1, size is 1 to 100")
    return register.orderBy("registro_operadora").offset((number - 1) * size).limit(size)


def search_count(register: DataFrame, term: str | None, size: int = 10) -> DataFrame:
    total = search(register, term).agg(F.count("*").alias("total"))
    return total.withColumn("paginas", F.ceil(F.col("total") / F.lit(size)).cast("bigint"))


def find_operator(register: DataFrame, identifier: str) -> DataFrame:
    """By register number or tax id, with or without punctuation."""
    wanted = text.strip_punctuation(F.lit(identifier))
    return (
        register.filter((F.col("registro_operadora") == wanted) | (F.col("cnpj") == wanted))
        .orderBy("registro_operadora")
        .limit(1)
    )


def expense_history(facts: DataFrame, registro: str) -> DataFrame:
    """Expenses of one operator, newest first; a short number is padded."""
    wanted = registro.strip().zfill(6)
    return (
        facts.filter(F.col("registro_operadora") == wanted)
        .select("trimestre", "ano", "valor_despesas")
        .orderBy(F.desc("ano"), F.desc("trimestre"), F.desc("valor_despesas"))
    )


def dashboard_totals(gold: DataFrame) -> DataFrame:
    zero = F.lit(0).cast(TOTAL)
    total = F.sum("valor_total")
    mean = F.round(F.try_divide(total, F.count("valor_total")), 2)
    return gold.agg(
        F.coalesce(total, zero).alias("total_despesas"),
        F.coalesce(mean, zero).alias("media_despesas"),
    )


def top_operators(gold: DataFrame, n: int = 5) -> DataFrame:
    """Largest totals; an operator without a total cannot be among them."""
    return (
        gold.select("razao_social", "uf", "valor_total")
        .orderBy(F.desc_nulls_last("valor_total"), "razao_social")
        .limit(n)
    )


def state_totals(gold: DataFrame) -> DataFrame:
    """Total per state. Null and blank stay two groups that share a label."""
    blank = F.col("uf").isNull() | (F.col("uf") == "")
    return (
        gold.groupBy("uf")
        .agg(F.sum("valor_total").alias("total"))
        .orderBy(F.desc_nulls_last("total"), "uf")
        .select(F.when(blank, F.lit("N/A")).otherwise(F.col("uf")).alias("uf"), "total")
    )


def top_states_and_rest(gold: DataFrame, n: int = 5, rest: str = "Outros") -> DataFrame:
    """The ``n`` largest states and one row for all others, if that is positive."""
    totals = gold.groupBy("uf").agg(F.sum("valor_total").alias("total"))
    top = totals.orderBy(F.desc_nulls_last("total"), "uf").limit(n)
    marked = top.select(F.col("uf").alias("_uf"), F.lit(True).alias("_top"))
    ranked = totals.join(F.broadcast(marked), F.col("uf").eqNullSafe(F.col("_uf")), "left")
    blank = F.col("uf").isNull() | (F.col("uf") == "")
    label = F.when(blank, F.lit("N/A")).otherwise(F.col("uf"))
    is_top = F.coalesce(F.col("_top"), F.lit(False))
    slices = ranked.select(
        is_top.alias("_top"),
        F.when(is_top, F.col("uf")).alias("_group"),
        F.when(is_top, label).otherwise(F.lit(rest)).alias("uf"),
        "total",
    )
    summed = slices.groupBy("_top", "_group", "uf").agg(F.coalesce(F.sum("total"), F.lit(0)).alias("total"))
    return summed.filter("_top OR total > 0").orderBy(F.desc("_top"), F.desc("total"), "uf").select("uf", "total")


def operator_card(register: DataFrame) -> DataFrame:
    """Display texts of the operator page."""
    return register.select(
        "registro_operadora",
        "cnpj",
        "razao_social",
        "modalidade",
        labels.phone_label(F.col("ddd"), F.col("telefone")).alias("telefone"),
        labels.address_label(
            F.col("logradouro"), F.col("numero"), F.col("complemento"), F.col("bairro")
        ).alias("endereco"),
        labels.place_label(F.col("cidade"), F.col("uf")).alias("cidade_uf"),
        "cep",
        labels.contact_label(F.col("representante"), F.col("cargo_representante")).alias("contato"),
    )


def history_rows(history: DataFrame) -> DataFrame:
    """Display texts of the expense table."""
    return history.select(
        F.col("ano"),
        labels.quarter_title(F.col("trimestre")).alias("trimestre"),
        labels.currency_label(F.col("valor_despesas")).alias("valor"),
    )
