"""Registered queries: name to a function of (session, data folder)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quartermark import datasets as d
from quartermark.functions import labels, links, periods, text
from quartermark.operators import aggregates, align, audit, dedup, enrich, indexes, normalize, quality, serving
from quartermark.operators import periods as newest
from quartermark.operators.register import keyed_register, typed_register
from quartermark.plans import analytics, batch, load, report
from quartermark.plans.consolidate import consolidate, write_bronze
from quartermark.schemas import (
    EXPENSE_REQUIRED,
    EXPENSE_TABLE,
    EXPENSE_WIDTHS,
    FACT_TABLE,
    MONEY,
    REGISTER_COLUMNS,
    REGISTER_REQUIRED,
    REGISTER_WIDTHS,
    STAGED_REGISTER,
    STAGED_STATISTICS,
)
from quartermark.session import shared_dir
from quartermark.sources import archives, pages, tables
from quartermark.sources.commits import CommittedTable
from quartermark.sources.delimited import BY_FILE, read_register, read_staged
from quartermark.streaming.ingest import ingest, ingested

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles and dates as text: types every engine hashes alike."""
    def plain(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            return column.cast("double").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return column.cast("string").alias(field.name)
        return column

    return df.select(*[plain(f) for f in df.schema.fields])


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(function(spark, sf_dir))

    QUERIES[function.__name__] = run
    return function


# --- scans -------------------------------------------------------------------


def expense_rows(rows: DataFrame) -> DataFrame:
    """Consolidated rows with the cleaned key, without the generated file name."""
    return rows.select(
        text.digits_key(F.col("REG_ANS")).alias("reg_key"),
        "Trimestre",
        "Ano",
        "ValorDespesas",
        "DespesasSuspeitas",
    )


@query
def scan_delimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(spark, "raw")
    d.write_raw_files(d.table(spark, sf_dir, "orders"), root)
    return expense_rows(consolidate(spark, root))


@query
def skipped_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(spark, "raw")
    d.write_unusable_files(d.table(spark, sf_dir, "orders"), root)
    bronze, files = write_bronze(spark, root)
    path = F.col("source_file")
    return (
        files.skipped(bronze)
        .select(periods.path_year(path).alias("ano"), periods.path_quarter(path).alias("trimestre"), "motivo")
        .distinct()
    )


@query
def scan_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(spark, "zip")
    d.write_archives(d.table(spark, sf_dir, "orders"), root)
    rows, _ = archives.read_members(spark, root, shared_dir(spark, "unpacked"), ["reg", "data", "valor", "descricao"])
    return rows.select(
        text.digits_key(F.col("reg")).alias("reg_key"),
        F.regexp_replace(F.regexp_extract("file", "([^/]+/[^/]+)$", 1), r"-\d+\.csv$", ".csv").alias("membro"),
        F.col("data"),
        F.col("valor").try_cast(MONEY).alias("valor"),
        "descricao",
    )


@query
def scan_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(spark, "raw")
    d.write_multiline_files(d.table(spark, sf_dir, "orders"), root)
    return expense_rows(consolidate(spark, root))


@query
def scan_encodings(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(spark, "raw")
    d.write_mixed_files(d.table(spark, sf_dir, "orders"), root)
    bronze, _ = write_bronze(spark, root, BY_FILE)
    return bronze.groupBy("descricao").agg(F.count("*").alias("linhas"))


@query
def archive_consolidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(spark, "zip")
    d.write_raw_archives(d.table(spark, sf_dir, "orders"), root)
    return expense_rows(consolidate(spark, root))


@query
def archive_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, target = shared_dir(spark, "zip"), shared_dir(spark, "unpacked")
    d.write_damaged_archives(d.table(spark, sf_dir, "orders"), root)
    log = archives.unpack(spark, root, target)
    place = F.regexp_extract("archive", r"([^/]+/[^/]+)\.zip$", 1)
    found = spark.read.text(target, recursiveFileLookup=True).select(
        F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+/[^/]+)/([^/]+)$", 1).alias("arquivo"),
        F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+/[^/]+)/([^/]+)$", 2).alias("membro"),
    )
    lines = found.groupBy("arquivo", "membro").agg((F.count("*") - 1).alias("linhas"))
    log = log.select(place.alias("arquivo"), F.col("member").alias("membro"), F.col("error").isNotNull().alias("danificado"))
    return log.join(lines, ["arquivo", "membro"], "left")


@query
def scan_workbooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(spark, "books")
    d.write_workbooks(d.table(spark, sf_dir, "orders"), root)
    bronze, files = write_bronze(spark, root)
    path = F.col("source_file")
    return files.skipped(bronze).select(
        periods.path_year(path).alias("ano"), periods.path_quarter(path).alias("trimestre"), "motivo"
    )


@query
def scan_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(spark, "register")
    d.write_register_file(spark, sf_dir, root)
    return keyed_register(align.align_register(read_register(spark, root), batch.ARRIVAL), batch.ARRIVAL)


def batch_target(spark: SparkSession, sf_dir: str) -> batch.Target:
    raw, registered, target = (shared_dir(spark, n) for n in ("raw", "register", "batch"))
    d.write_raw_files(d.table(spark, sf_dir, "orders"), raw)
    d.write_register_file(spark, sf_dir, registered)
    return batch.run_batch(spark, raw, registered, target)


@query
def batch_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read_table(spark, batch_target(spark, sf_dir).facts, FACT_TABLE)


@query
def batch_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    exported = spark.read.option("sep", ";").option("header", True).csv(batch_target(spark, sf_dir).report)
    flags = [F.col(c).cast("boolean").alias(c) for c in exported.columns if c.startswith("FLAG_")]
    return exported.select(
        F.col("REG_ANS").cast("bigint").alias("REG_ANS"),
        "CNPJ",
        "Razao_Social",
        F.nullif(F.col("Modalidade"), F.lit("")).alias("Modalidade"),
        "UF",
        "Trimestre",
        F.col("Ano").cast("int").alias("Ano"),
        F.col("ValorDespesas").cast("double").alias("ValorDespesas"),
        *flags,
    )


@query
def batch_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load.typed_statistics(read_staged(spark, batch_target(spark, sf_dir).statistics, STAGED_STATISTICS))


@query
def batch_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read_table(spark, f"{batch_target(spark, sf_dir).gold}/por_operadora")


@query
def batch_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("registro_operadora", "cnpj", "razao_social", "modalidade", "cidade", "uf", "cep", "representante")
    return tables.read_table(spark, batch_target(spark, sf_dir).register).select(*columns)


@query
def incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing, target, checkpoint = (shared_dir(spark, n) for n in ("landing", "target", "offsets"))
    orders = d.table(spark, sf_dir, "orders")
    for parity in (0, 1):
        arrived = orders.filter(F.year("o_orderdate") % 2 == parity)
        d.write_raw_files(arrived, f"{landing}/{parity}")
        ingest(spark, landing, target, checkpoint).awaitTermination()
    return expense_rows(ingested(spark, target))


@query
def html_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.matching_links(d.table(spark, sf_dir, "pages"), "/[A-Z]")


@query
def html_link_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = d.table(spark, sf_dir, "pages").select("page_id", "url", links.hrefs(F.col("html")).alias("l"))
    entries = d.listing_links(F.col("l"), F.col("page_id"))
    return pages.classified(found.select("page_id", "url", F.posexplode(entries).alias("pos", "href")))


@query
def html_first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = d.table(spark, sf_dir, "pages").select(
        "page_id", "url", d.listing_links(links.hrefs(F.col("html")), F.col("page_id")).alias("l")
    )
    return pages.first_match(found, "l")


@query
def latest_n_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Some rows have no quarter.
    lost = F.col("registro_operadora").cast("int") % 11 == 0
    rows = d.facts(spark, sf_dir)
    return newest.latest_only(rows.withColumn("trimestre", F.when(~lost, F.col("trimestre"))))


# --- sinks -------------------------------------------------------------------


@query
def sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = report.ranked_statistics(d.expenses(spark, sf_dir), d.report_register(spark, sf_dir))
    stored, exported = shared_dir(spark, "gold"), shared_dir(spark, "export")
    tables.write_table(stats, stored)
    tables.export_csv(tables.read_table(spark, stored), exported, compressed=True)
    return load.typed_statistics(read_staged(spark, exported, STAGED_STATISTICS))


@query
def load_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = aggregates.operator_statistics(d.expenses(spark, sf_dir), d.report_register(spark, sf_dir))
    path = shared_dir(spark, "export")
    tables.export_csv(stats, path)
    return load.load_statistics(read_staged(spark, path, STAGED_STATISTICS))


@query
def partitioned_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "silver")
    rows = d.expenses(spark, sf_dir)
    for suspicious in (False, True):
        tables.append_expenses(rows.filter(F.col("DespesasSuspeitas") == suspicious), path)
    stored = tables.read_table(spark, path, EXPENSE_TABLE)
    return stored.groupBy("Ano", "Trimestre", "DespesasSuspeitas").agg(
        F.count("*").alias("linhas"), F.sum("ValorDespesas").alias("valor")
    )


@query
def append_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = d.expenses(spark, sf_dir).withColumn("source_file", F.concat_ws("/", "Ano", "Trimestre"))
    table = CommittedTable(spark, shared_dir(spark, "committed"), EXPENSE_TABLE, ("Ano", "Trimestre"))
    # The second run meets some sources again, the third one all of them.
    for part in (rows.filter("Ano % 2 = 0"), rows, rows):
        table.append(part)
    return table.read().groupBy("Ano", "Trimestre", "DespesasSuspeitas").agg(
        F.count("*").alias("linhas"), F.sum("ValorDespesas").alias("valor")
    )


@query
def register_two_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    loads = [
        part.withColumn("registro_operadora", text.zero_pad(F.col("registro_operadora"), 6))
        for part in d.register_loads(spark, sf_dir)
    ]
    table = CommittedTable(spark, shared_dir(spark, "dimension"), loads[0].schema)
    for name, part in (("primeira", loads[0]), ("segunda", loads[1]), ("segunda", loads[1])):
        table.insert_absent(dedup.keep_first(part, ["registro_operadora"], [F.col("cnpj")]), ["registro_operadora"], name)
    return table.read()


# --- normalisation -----------------------------------------------------------


@query
def schema_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = d.table(spark, sf_dir, "orders")
    key, price = d.as_text(F.col("o_custkey")), d.as_text(F.col("o_totalprice").cast(MONEY))
    day, source = F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderpriority").alias("source_file")
    of = lambda s: orders.filter(F.col("o_orderstatus") == s)
    first = of("O").select(
        key.alias("cd_operadora"), day.alias(" Dt_Registro"), source.alias("DESCRICAO"),
        price.alias("VL_SALDO_FINAL "), d.as_text(F.col("o_orderkey")).alias("CD_CONTA_CONTABIL"), source,
    )
    second = of("F").select(
        day.alias("DATA"), source.alias("Nm_Conta"), key.alias("REG_ANS"), price.alias("valor"), source
    )
    third = of("P").select(
        source.alias("DESC"),
        F.when(F.col("o_orderkey") % 2 == 0, price).alias("VL_MOVIMENTO"),
        F.when(F.col("o_orderkey") % 3 == 0, F.lit("1.00")).alias("SALDO_FINAL"),
        key.alias("Cod_Ans"), source,
    )
    return align.append_all([align.align_frame(f, ["source_file"]) for f in (first, second, third)])


@query
def keyword_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = d.table(spark, sf_dir, "part").select("p_partkey", F.upper("p_name").alias("descricao"))
    return normalize.keep_keywords(parts, "descricao", "red widgets?|small bolts?")


@query
def date_to_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    forms = (
        "dd/MM/yyyy",
        "yyyy-MM-dd",
        " yyyy-MM-dd",
        "yyyyMMdd",
        "yyyy/MM/dd",
        "yyyy-MM-dd'T'HH:mm:ss.SSS",
        "d/M/yyyy HH:mm:ss",
        "yyyy-M-d",
        "yyyy-MM'-xx'",
        "yyyy",
    )
    written = F.elt(key % 10 + 1, *[F.date_format(day, f) for f in forms])
    parsed = periods.parse_date(written)
    return d.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        d.as_text(periods.date_year(parsed)).alias("ano"),
        periods.date_quarter(parsed).alias("trimestre"),
    )


@query
def path_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    year, quarter = d.as_text(F.year(day)), d.as_text(F.quarter(day))
    folder = (
        F.when(key % 6 == 0, F.concat(quarter, F.lit("T")))
        .when(key % 6 == 1, F.concat(F.lit("T"), quarter))
        .when(key % 6 == 2, quarter)
        .when(key % 6 == 3, F.concat(quarter, F.lit("t"), year))
        .when(key % 6 == 4, F.concat(F.lit("trimestre="), quarter, F.lit("T")))
        .otherwise(F.concat(F.lit("1"), quarter, F.lit("T")))
    )
    rows = d.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.concat(F.lit("file:/dados/csv/"), year, F.lit("/"), folder, F.lit("/a.csv")).alias("source_file"),
        F.when(key % 4 == 0, F.lit("1999-12-31")).otherwise(F.lit("31/31/1999")).alias("data"),
    )
    return normalize.with_period(rows).select(
        "o_orderkey", d.as_text(F.col("Ano")).alias("ano"), F.col("Trimestre").alias("trimestre")
    )


@query
def locale_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    price = d.as_text(F.col("o_totalprice").cast(MONEY))
    comma = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & (key % 3 == 0)
    rows = d.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_orderpriority").alias("source_file"),
        F.when(comma, F.replace(price, F.lit("."), F.lit(","))).otherwise(price).alias("valor"),
    )
    return normalize.with_locale_value(rows).select("o_orderkey", "ValorDespesas")


@query
def suspicious_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    balance = F.when(F.col("c_custkey") % 50 != 0, F.col("c_acctbal").cast(MONEY))
    rows = d.table(spark, sf_dir, "customer").select("c_custkey", balance.alias("ValorDespesas"))
    return normalize.with_suspicion(rows).select("c_custkey", "DespesasSuspeitas")


@query
def rows_per_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = d.table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("source_file"), d.descriptions().alias("descricao")
    )
    return normalize.rows_per_source(normalize.keep_keywords(rows))


# --- register ----------------------------------------------------------------


@query
def key_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    written = (
        F.when(key % 5 == 0, F.concat(F.lit("ANS-"), d.as_text(key)))
        .when(key % 5 == 1, F.concat(d.as_text(key), F.lit("/0")))
        .when(key % 5 == 2, F.lpad(d.as_text(key), 6, "0"))
        .when(key % 5 == 3, F.lit("S/N"))
    )
    return d.table(spark, sf_dir, "customer").select("c_custkey", text.digits_key(written).alias("reg_key"))


@query
def zero_pad_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return d.table(spark, sf_dir, "customer").select(
        "c_custkey",
        text.zero_pad(d.as_text(key), 6).alias("registro"),
        text.zero_pad(d.as_text(key * 7919), 14).alias("cnpj"),
        text.zero_pad(d.as_text(key * 1000003), 8).alias("cep"),
        text.zero_fill(d.as_text(key * 1000003), 8).alias("sem_corte"),
    )


@query
def staging_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "staged")
    tables.export_csv(d.staged_register(spark, sf_dir).select(*REGISTER_COLUMNS), path)
    staged = read_staged(spark, path, STAGED_REGISTER)
    typed = typed_register(staged.withColumn("numero_lido", F.col("registro_operadora")), ["numero_lido"])
    return typed.withColumns({c: d.as_text(F.col(c)) for c in ("ddd", "regiao_comercializacao")})


@query
def dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = d.table(spark, sf_dir, "part").select("p_name", "p_partkey", "p_brand", "p_retailprice")
    return dedup.keep_first(parts, ["p_name"], [F.col("p_partkey")])


@query
def dedup_top_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.keep_largest_state(d.name_totals(spark, sf_dir))


# --- enrichment and quality --------------------------------------------------


@query
def enrich_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = enrich.enrich(d.expenses(spark, sf_dir), d.report_register(spark, sf_dir))
    return rows.select(
        "REG_ANS", "cnpj", "razao_social", "modalidade", "uf", "Trimestre", "Ano", "ValorDespesas"
    )


@query
def unmatched_expenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = enrich.unmatched(d.expenses(spark, sf_dir), d.report_register(spark, sf_dir))
    return rows.select("REG_ANS", "Trimestre", "Ano", "ValorDespesas")


@query
def fact_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load.load_expenses(
        d.staged_expenses(spark, sf_dir), d.register(spark, sf_dir, "registro_operadora")
    )


@query
def cnpj_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    base = F.lpad(d.as_text(key * 7919), 14, "0")
    dotted = F.concat(F.substring(base, 1, 8), F.lit("/"), F.substring(base, 9, 4), F.lit("-"), F.substring(base, 13, 2))
    written = (
        F.when(key % 5 == 0, dotted)
        .when(key % 5 == 1, F.repeat(d.as_text(key % 10), 14))
        .when(key % 5 == 2, F.concat(base, F.lit("0")))
        .otherwise(d.as_text(key * 7919))
    )
    rows = d.table(spark, sf_dir, "customer").select("c_custkey", written.alias("cnpj"))
    return quality.with_cnpj_check(rows)


@query
def quality_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    rows = d.table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(key % 10 == 0, F.lit("NAO ENCONTRADO")).otherwise(d.as_text(key * 7919)).alias("cnpj"),
        F.when(key % 10 == 1, F.lit("  "))
        .when(key % 10 == 2, F.lit("RAZAO SOCIAL NAO LOCALIZADA"))
        .otherwise(F.col("c_name"))
        .alias("razao_social"),
        F.when(key % 10 == 3, F.lit("x")).otherwise(d.as_text(F.col("c_acctbal").cast(MONEY))).alias("ValorDespesas"),
    )
    return quality.with_flags(rows).drop("cnpj", "razao_social")


@query
def kept_value_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A flag that the input has is read as it is, whatever the value says.
    rows = d.table(spark, sf_dir, "customer").select(
        "c_custkey",
        d.as_text(F.col("c_acctbal").cast(MONEY)).alias("ValorDespesas"),
        F.when(F.col("c_custkey") % 3 == 0, F.lit("true")).otherwise(F.lit("false")).alias("FLAG_VALOR_INVALIDO"),
    )
    return quality.with_value_flag(rows)


@query
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.validated_report(d.expenses(spark, sf_dir), d.report_register(spark, sf_dir))


# --- statistics and analytics ------------------------------------------------


@query
def quarterly_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.quarterly_sum(
        aggregates.named_sums(d.expenses(spark, sf_dir), d.report_register(spark, sf_dir))
    )


@query
def operator_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.ranked_statistics(d.expenses(spark, sf_dir), d.report_register(spark, sf_dir))


@query
def merged_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of all quarters from the stored state of the older ones and the newer ones alone."""
    expenses, register = d.expenses(spark, sf_dir), d.report_register(spark, sf_dir)

    def state(part: DataFrame) -> DataFrame:
        return aggregates.statistics_state(aggregates.quarterly_sum(aggregates.named_sums(part, register)))

    path = shared_dir(spark, "state")
    tables.write_table(state(expenses.filter("Ano < 1996")), path)
    merged = aggregates.merged_state(tables.read_table(spark, path), state(expenses.filter("Ano >= 1996")))
    return aggregates.statistics_of_state(merged)


@query
def operator_stats_unflagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.operator_statistics(
        d.expenses(spark, sf_dir), d.report_register(spark, sf_dir), ["FLAG_RAZAO_SOCIAL_INVALIDA"]
    )


@query
def growth_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.growth_leaders(
        d.facts(spark, sf_dir), d.register(spark, sf_dir, "registro_operadora", "razao_social")
    )


@query
def uf_total_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.state_leaders(d.facts(spark, sf_dir), d.register(spark, sf_dir, "registro_operadora", "uf"))


@query
def above_market_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.above_market(d.facts(spark, sf_dir))


# --- serving -----------------------------------------------------------------

SEARCHED = ("registro_operadora", "cnpj", "razao_social", "modalidade", "uf")


@query
def search_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = serving.search(d.register(spark, sf_dir, *SEARCHED), "R#0000001")
    return serving.page(found, 2, 10)


@query
def paged_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "pages")
    indexes.write_pages(d.register(spark, sf_dir, *SEARCHED), path, 16)
    middle = indexes.page_count(spark, path).first()["paginas"] // 2
    return indexes.read_page(spark, path, max(1, middle))


@query
def search_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    register, path = d.register(spark, sf_dir, *SEARCHED), shared_dir(spark, "pieces")
    indexes.write_search_index(register, path, 16)
    return indexes.indexed_search(register, spark.read.parquet(path), "er#%1_2")


@query
def search_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.search_count(d.register(spark, sf_dir, "registro_operadora", "cnpj", "razao_social"), "19")


@query
def lookup_identifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.find_operator(d.register(spark, sf_dir, *SEARCHED), "00.000.000/6414-39")


@query
def expense_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.expense_history(d.facts(spark, sf_dir), "74")


@query
def history_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.history_rows(d.facts(spark, sf_dir))


@query
def operator_with_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.operator_history(
        d.register(spark, sf_dir, "registro_operadora", "razao_social", "uf"), d.facts(spark, sf_dir)
    )


@query
def operator_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [c for c in REGISTER_COLUMNS if c not in ("nome_fantasia", "fax", "data_registro_ans")]
    return serving.operator_card(d.register(spark, sf_dir, *columns))


def dashboard_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold statistics in which one state is null and one is blank."""
    gold = report.gold_statistics(d.expenses(spark, sf_dir), d.report_register(spark, sf_dir))
    state = F.when(F.col("uf") == "NATION_1", F.lit("")).otherwise(F.nullif(F.col("uf"), F.lit("NATION_0")))
    return gold.withColumn("uf", state)


@query
def dashboard_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.dashboard_totals(dashboard_table(spark, sf_dir))


@query
def dashboard_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.top_operators(dashboard_table(spark, sf_dir))


@query
def dashboard_uf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.state_totals(dashboard_table(spark, sf_dir))


@query
def uf_top5_others(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.top_states_and_rest(dashboard_table(spark, sf_dir))


@query
def label_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.col("c_name"), F.lit(" "), F.col("c_mktsegment"))
    shown = F.when(F.col("c_custkey") % 2 == 0, name).otherwise(F.col("c_name"))
    return d.table(spark, sf_dir, "customer").select("c_custkey", labels.truncate_label(shown).alias("rotulo"))


@query
def currency_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.col("c_acctbal").cast(MONEY)
    return d.table(spark, sf_dir, "customer").select("c_custkey", labels.currency_label(value).alias("rotulo"))


# --- integrity ---------------------------------------------------------------


@query
def audit_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = d.double_register(spark, sf_dir)
    return align.append_all(
        [
            audit.duplicate_keys(staged, "registro_operadora"),
            audit.duplicate_keys(staged, "cnpj"),
            audit.duplicate_keys(d.name_totals(spark, sf_dir), "razao_social"),
        ]
    )


@query
def audit_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = load.typed_expenses(d.staged_expenses(spark, sf_dir))
    staged = d.staged_register(spark, sf_dir)
    found = [
        audit.null_counts(facts, EXPENSE_REQUIRED),
        audit.null_counts(staged, [*REGISTER_REQUIRED, "complemento"]),
    ]
    return align.append_all([counts_by_column(f) for f in found])


@query
def audit_width(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = [
        audit.too_wide_counts(d.staged_register(spark, sf_dir), REGISTER_WIDTHS),
        audit.too_wide_counts(d.facts(spark, sf_dir), EXPENSE_WIDTHS),
    ]
    return align.append_all([counts_by_column(f) for f in found])


@query
def audit_on_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged, path = d.staged_register(spark, sf_dir), shared_dir(spark, "checked")
    found = audit.write_checked(staged, path, [*REGISTER_REQUIRED, "complemento"], REGISTER_WIDTHS)
    kept, left_out = (audit.read_checked(spark, path, staged.schema, v).agg(F.count("*").alias("linhas")) for v in (True, False))
    name = lambda df, n: df.select(F.lit("gravada").alias("regra"), F.lit(n).alias("coluna"), "linhas")
    return align.append_all([found, name(kept, "validas"), name(left_out, "invalidas")])


def counts_by_column(counts: DataFrame) -> DataFrame:
    return counts.unpivot([], counts.columns, "coluna", "linhas")


@query
def audit_fk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.orphans(d.facts(spark, sf_dir), d.register(spark, sf_dir, "registro_operadora"))

