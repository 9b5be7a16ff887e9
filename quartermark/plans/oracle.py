"""The registered queries as SQL over the same tables, for a second engine.

Written independently of the DataFrame code: windows, correlated forms and
integer arithmetic where the library uses aggregates and decimals.
"""

from __future__ import annotations

PRICE = "(CAST(o_totalprice AS DECIMAL(15,2)) - 50000)"
QUARTER = "CONCAT(CAST(QUARTER(o_orderdate) AS VARCHAR), 'T')"
YEAR = "CAST(YEAR(o_orderdate) AS INT)"
# Every ninth order names an operator that the register does not have.
KEY = "(o_custkey + CASE WHEN o_orderkey % 9 = 0 THEN 500000 ELSE 0 END)"

STAGED = """staged AS (
  SELECT CAST(c_custkey AS VARCHAR) AS registro_operadora, CAST(c_custkey * 7919 AS VARCHAR) AS cnpj,
    c_name AS razao_social, CONCAT('Fantasia ', c_custkey % 97) AS nome_fantasia, c_mktsegment AS modalidade,
    CONCAT('Rua ', n_name) AS logradouro, CAST(c_custkey % 1000 AS VARCHAR) AS numero,
    CASE WHEN c_custkey % 3 = 0 THEN CONCAT('Sala ', c_custkey % 40) END AS complemento,
    CONCAT('Bairro ', c_custkey % 12) AS bairro, CONCAT('Cidade ', c_nationkey) AS cidade, n_name AS uf,
    CAST(c_custkey * 37 AS VARCHAR) AS cep,
    CASE WHEN c_custkey % 4 <> 0 THEN CAST(11 + c_custkey % 80 AS VARCHAR) END AS ddd,
    CONCAT('3', LPAD(CAST(c_custkey AS VARCHAR), 7, '0')) AS telefone,
    CAST(NULL AS VARCHAR) AS fax, CONCAT('contato', c_custkey, '@example.com') AS endereco_eletronico,
    CONCAT('Representante ', c_custkey % 50) AS representante, 'DIRETOR' AS cargo_representante,
    CASE WHEN c_custkey % 5 <> 0 THEN CAST(1 + c_custkey % 6 AS VARCHAR) END AS regiao_comercializacao,
    CASE WHEN c_custkey % 7 <> 0 THEN CONCAT(1998 + c_custkey % 20, '-',
      LPAD(CAST(1 + c_custkey % 12 AS VARCHAR), 2, '0'), '-',
      LPAD(CAST(1 + c_custkey % 28 AS VARCHAR), 2, '0')) END AS data_registro_ans,
    c_custkey AS arrival
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

OP = (
    STAGED
    + """, op AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT * REPLACE (LPAD(registro_operadora, 6, '0') AS registro_operadora, LPAD(cnpj, 14, '0') AS cnpj,
        LPAD(cep, 8, '0') AS cep),
      ROW_NUMBER() OVER (PARTITION BY LPAD(registro_operadora, 6, '0') ORDER BY arrival) AS rn
    FROM staged) WHERE rn = 1)"""
)

REG = (
    STAGED
    + """, reg AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT CAST(registro_operadora AS BIGINT) AS reg_key, cnpj, razao_social, modalidade, uf,
      ROW_NUMBER() OVER (PARTITION BY CAST(registro_operadora AS BIGINT) ORDER BY arrival) AS rn
    FROM staged WHERE CAST(registro_operadora AS BIGINT) <> 0) WHERE rn = 1)"""
)

FACTS = f"""dp AS (
  SELECT LPAD(CAST({KEY} AS VARCHAR), 6, '0') AS registro_operadora, {QUARTER} AS trimestre, {YEAR} AS ano,
    CAST(o_totalprice AS DECIMAL(15,2)) AS valor_despesas FROM orders)"""

EXPENSES = f"""expenses AS (
  SELECT CASE WHEN o_orderkey % 50 = 0 THEN 'S/N' ELSE CAST({KEY} AS VARCHAR) END AS "REG_ANS",
    CASE WHEN o_orderkey % 50 = 0 THEN 0 ELSE {KEY} END AS clean_key,
    {QUARTER} AS "Trimestre", {YEAR} AS "Ano",
    CASE WHEN o_orderkey % 40 <> 0 THEN {PRICE} END AS "ValorDespesas" FROM orders)"""

ENRICHED = (
    f"{REG}, {EXPENSES}"
    + """, enriched AS (
  SELECT e.*, COALESCE(r.cnpj, 'NAO ENCONTRADO') AS cnpj,
    COALESCE(r.razao_social, 'RAZAO SOCIAL NAO LOCALIZADA') AS razao_social, r.modalidade,
    COALESCE(r.uf, 'INDETERMINADO') AS uf, r.reg_key
  FROM expenses e LEFT JOIN reg r ON e.clean_key = r.reg_key)"""
)

QUARTERS = (
    ENRICHED
    + """, quarters AS (
  SELECT razao_social, uf, "Ano" AS ano, "Trimestre" AS trimestre, SUM("ValorDespesas") AS valor
  FROM enriched WHERE "ValorDespesas" > 0 GROUP BY ALL)"""
)


def mean(total: str, count: str) -> str:
    """Half-up mean to two decimals in whole cents."""
    cents = f"CAST({total} * 100 AS HUGEINT)"
    return f"CAST((2 * {cents} + {count}) // (2 * {count}) AS DOUBLE) / 100"


STATS = (
    QUARTERS
    + f""", stats AS (
  SELECT razao_social, uf, SUM(valor) AS valor_total, {mean("SUM(valor)", "COUNT(valor)")} AS media_trimestral,
    ROUND(COALESCE(STDDEV_SAMP(CAST(valor AS DOUBLE)), 0), 2) AS desvio_padrao
  FROM quarters GROUP BY razao_social, uf)"""
)
STATS_COLUMNS = "razao_social, uf, CAST(valor_total AS DOUBLE) AS valor_total, media_trimestral, desvio_padrao"

GOLD = (
    STATS
    + """, gold AS (
  SELECT razao_social, CASE uf WHEN 'NATION_1' THEN '' WHEN 'NATION_0' THEN NULL ELSE uf END AS uf, valor_total
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY razao_social ORDER BY valor_total DESC, uf) AS rn FROM stats)
  WHERE rn = 1)"""
)
BY_STATE = GOLD + ", by_state AS (SELECT uf, SUM(valor_total) AS total FROM gold GROUP BY uf)"
STATE_LABEL = "CASE WHEN uf IS NULL OR uf = '' THEN 'N/A' ELSE uf END"


def cnpj_valid(text: str) -> str:
    """Check-digit test over a subquery column ``c`` that holds the clean digits."""
    # The weights of the two check digits.
    digit = "CAST(SUBSTR(c, CAST(i AS INT), 1) AS INT)"
    first = f"LIST_SUM(LIST_TRANSFORM(RANGE(1, 13), lambda i: {digit} * [5,4,3,2,9,8,7,6,5,4,3,2][i])) % 11"
    second = f"LIST_SUM(LIST_TRANSFORM(RANGE(1, 14), lambda i: {digit} * [6,5,4,3,2,9,8,7,6,5,4,3,2][i])) % 11"
    digits = f"REGEXP_REPLACE(COALESCE({text}, ''), '\\D', '', 'g')"
    clean = f"CASE WHEN LENGTH({digits}) < 14 THEN LPAD({digits}, 14, '0') ELSE {digits} END"
    return f"""(SELECT LENGTH(c) = 14 AND c <> REPEAT(SUBSTR(c, 1, 1), 14)
      AND CAST(SUBSTR(c, 13, 1) AS INT) = CASE WHEN {first} < 2 THEN 0 ELSE 11 - {first} END
      AND CAST(SUBSTR(c, 14, 1) AS INT) = CASE WHEN {second} < 2 THEN 0 ELSE 11 - {second} END
      FROM (SELECT {clean} AS c))"""


FLAGS = f"""(CONTAINS(cnpj, 'NAO') OR NOT {cnpj_valid("cnpj")}) AS "FLAG_CNPJ_INVALIDO",
  (TRIM(razao_social) = '' OR CONTAINS(razao_social, 'NAO LOCALIZADA')) AS "FLAG_RAZAO_SOCIAL_INVALIDA" """

LINKS = """page_links AS (
  SELECT page_id, url, LIST_TRANSFORM(REGEXP_EXTRACT_ALL(REGEXP_REPLACE(html,
    '(?is)<!--.*?-->|<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>', ' ', 'g'),
    '(?is)<a\\s[^>]*?href="([^"]*)"', 1), lambda h: REPLACE(h, '&amp;', '&')) AS links FROM pages)"""
ENTRIES = (
    LINKS
    + """, raw_entries AS (
  SELECT page_id, url, UNNEST(links) AS h, UNNEST(RANGE(LEN(links))) AS pos FROM page_links),
entries AS (
  SELECT page_id, url, pos, CASE (page_id + pos) % 5 WHEN 0 THEN h || '.zip' WHEN 1 THEN h || '.CSV'
    WHEN 2 THEN h || '/' WHEN 3 THEN '?C=' || h ELSE h END AS href FROM raw_entries)"""
)

RAW_ROWS = f"""SELECT {KEY} AS reg_key, {QUARTER} AS "Trimestre", {YEAR} AS "Ano",
  CAST({PRICE} AS DOUBLE) AS "ValorDespesas", {PRICE} <= 0 AS "DespesasSuspeitas"
FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')"""

# The same plans over the expenses of raw files instead of the prepared table.
RAW_EXPENSES = f"""expenses AS (
  SELECT CAST({KEY} AS VARCHAR) AS "REG_ANS", {KEY} AS clean_key, {QUARTER} AS "Trimestre", {YEAR} AS "Ano",
    {PRICE} AS "ValorDespesas" FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM'))"""
ONE_STATE = """SELECT razao_social, uf, CAST(valor_total AS DOUBLE) AS valor_total, media_trimestral, desvio_padrao
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY razao_social ORDER BY valor_total DESC, uf) AS rn FROM stats)
WHERE rn = 1"""
REPORT = f"""SELECT CAST(clean_key AS BIGINT) AS "REG_ANS", cnpj AS "CNPJ", razao_social AS "Razao_Social",
  modalidade AS "Modalidade", uf AS "UF", "Trimestre", "Ano",
  CAST(COALESCE("ValorDespesas", 0) AS DOUBLE) AS "ValorDespesas", {FLAGS},
  COALESCE("ValorDespesas", 0) <= 0 AS "FLAG_VALOR_INVALIDO" FROM enriched"""

NAME_TOTALS = """totals AS (SELECT p_name AS razao_social, p_brand AS uf,
  SUM(CAST(p_retailprice AS DECIMAL(15,2))) AS valor_total FROM part GROUP BY p_name, p_brand)"""

ORACLE = {
    "scan_delimited": RAW_ROWS,
    "incremental_ingest": RAW_ROWS,
    "scan_workbooks": f"""SELECT DISTINCT {YEAR} AS ano, {QUARTER} AS trimestre, 'workbook' AS motivo FROM orders""",
    "archive_consolidate": RAW_ROWS,
    "scan_encodings": """SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'Despesas com Eventos Conhecidos'
  WHEN '2-HIGH' THEN 'DESPESA COM SINISTRO' ELSE 'Provisão de Eventos / Sinistros' END AS descricao, COUNT(*) AS linhas
FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') GROUP BY 1""",
    "scan_multiline": f"""SELECT {KEY} AS reg_key, {QUARTER} AS "Trimestre", {YEAR} AS "Ano",
  CAST({PRICE} AS DOUBLE) AS "ValorDespesas", {PRICE} <= 0 AS "DespesasSuspeitas"
FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')""",
    "archive_errors": """WITH months AS (
  SELECT o_orderstatus || '/' || STRFTIME(o_orderdate, '%Y%m') AS arquivo, COUNT(*) AS n FROM orders GROUP BY 1)
SELECT arquivo, 'bom.csv' AS membro, false AS danificado, n AS linhas FROM months
UNION ALL SELECT arquivo, 'ruim.csv', true, NULL FROM months""",
    "scan_register": f"WITH {REG} SELECT reg_key, cnpj, razao_social, modalidade, uf FROM reg",
    "batch_facts": f"""WITH {OP}
SELECT LPAD(CAST({KEY} AS VARCHAR), 6, '0') AS registro_operadora, {QUARTER} AS trimestre, {YEAR} AS ano,
  CAST({PRICE} AS DOUBLE) AS valor_despesas FROM orders
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') AND o_orderstatus <> 'P' AND {PRICE} > 0
  AND EXISTS (SELECT 1 FROM op WHERE op.registro_operadora = LPAD(CAST({KEY} AS VARCHAR), 6, '0'))""",
    "skipped_files": f"""SELECT DISTINCT ano, trimestre, motivo FROM (
  SELECT {YEAR} AS ano, {QUARTER} AS trimestre, CASE o_orderstatus WHEN 'O' THEN 'no_value_column'
    WHEN 'F' THEN 'no_key_column' ELSE 'no_description_column' END AS motivo FROM orders
  UNION ALL SELECT {YEAR}, {QUARTER}, 'no_keyword_match' FROM orders)""",
    "scan_archives": f"""SELECT o_custkey AS reg_key, '2025/' || o_orderstatus || '.csv' AS membro,
  STRFTIME(o_orderdate, '%Y-%m-%d') AS data, CAST({PRICE} AS DOUBLE) AS valor, 'Provisão' AS descricao FROM orders""",
    "html_links": f"""WITH {LINKS}, found AS (SELECT page_id, UNNEST(links) AS href FROM page_links)
SELECT page_id, CAST(ROW_NUMBER() OVER (PARTITION BY page_id ORDER BY href DESC) - 1 AS INT) AS ordem, href
FROM found WHERE REGEXP_MATCHES(href, '^/[A-Z]')""",
    "html_link_class": f"""WITH {ENTRIES}
SELECT page_id, CAST(pos AS INT) AS pos, href,
  CASE WHEN href IN ('', './', '../') OR href LIKE '?%' THEN 'ignored'
    WHEN REGEXP_MATCHES(LOWER(href), '\\.(zip|csv|pdf|rar)$') THEN 'file'
    WHEN href LIKE '%/' THEN 'folder' ELSE 'ignored' END AS kind,
  url || href AS address, REGEXP_REPLACE(TRIM(href, '/'), '\\.[zZ][iI][pP]$', '') AS item FROM entries""",
    "html_first_match": f"""WITH {ENTRIES}, ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY page_id ORDER BY pos) AS rn FROM entries WHERE LOWER(href) LIKE '%.csv')
SELECT page_id, CASE WHEN href LIKE 'http%' THEN href ELSE url || href END AS address,
  STRING_SPLIT(url || href, '/')[-1] AS file_name FROM ranked WHERE rn = 1""",
    "latest_n_periods": f"""WITH {FACTS}, known AS (
  SELECT * FROM dp WHERE NOT (CAST(registro_operadora AS INT) % 11 = 0 AND RIGHT(trimestre, 1) = 'T'))
SELECT registro_operadora, trimestre, ano, CAST(valor_despesas AS DOUBLE) AS valor_despesas FROM known
WHERE (ano, trimestre) IN (SELECT (ano, trimestre) FROM (
  SELECT DISTINCT ano, trimestre FROM known ORDER BY ano DESC, trimestre DESC LIMIT 3))""",
    "sink_roundtrip": f"WITH {STATS} SELECT {STATS_COLUMNS} FROM stats",
    "partitioned_append": f"""WITH {EXPENSES}
SELECT "Ano", "Trimestre", COALESCE("ValorDespesas", 0) <= 0 AS "DespesasSuspeitas", COUNT(*) AS linhas,
  CAST(SUM("ValorDespesas") AS DOUBLE) AS valor FROM expenses GROUP BY 1, 2, 3""",
    "append_rerun": f"""WITH {EXPENSES}
SELECT "Ano", "Trimestre", COALESCE("ValorDespesas", 0) <= 0 AS "DespesasSuspeitas", COUNT(*) AS linhas,
  CAST(SUM("ValorDespesas") AS DOUBLE) AS valor FROM expenses GROUP BY 1, 2, 3""",
    "register_two_loads": """SELECT LPAD(CAST(c_custkey AS VARCHAR), 6, '0') AS registro_operadora,
  CAST(c_custkey * 7919 AS VARCHAR) AS cnpj, c_name AS razao_social FROM customer
UNION ALL SELECT LPAD(CAST(s_suppkey * 3 AS VARCHAR), 6, '0'), CAST(s_suppkey * 7919 * 2 AS VARCHAR), s_name
FROM supplier WHERE s_suppkey * 3 NOT IN (SELECT c_custkey FROM customer)""",
    "merged_statistics": f"WITH {STATS} SELECT {STATS_COLUMNS} FROM stats",
    "schema_align": """SELECT CAST(o_custkey AS VARCHAR) AS reg_ans,
  CASE WHEN o_orderstatus <> 'P' THEN STRFTIME(o_orderdate, '%Y-%m-%d') END AS data, o_orderpriority AS descricao,
  CASE WHEN o_orderstatus <> 'P' THEN CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR)
    WHEN o_orderkey % 3 = 0 THEN '1.00'
    WHEN o_orderkey % 2 = 0 THEN CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) END AS valor,
  o_orderpriority AS source_file FROM orders""",
    "keyword_filter": """SELECT p_partkey, UPPER(p_name) AS descricao FROM part
WHERE REGEXP_MATCHES(p_name, '(?i)red widgets?|small bolts?')""",
    "date_to_period": """SELECT o_orderkey,
  CASE WHEN o_orderkey % 10 < 8 THEN CAST(YEAR(o_orderdate) AS VARCHAR) END AS ano,
  CASE WHEN o_orderkey % 10 < 8 THEN CONCAT(QUARTER(o_orderdate), 'T') END AS trimestre FROM orders""",
    "path_period": """SELECT o_orderkey,
  CASE WHEN o_orderkey % 4 = 0 THEN '1999' WHEN o_orderkey % 6 <> 5 THEN CAST(YEAR(o_orderdate) AS VARCHAR) END AS ano,
  CASE WHEN o_orderkey % 4 = 0 THEN '4T' WHEN o_orderkey % 6 <> 5 THEN CONCAT(QUARTER(o_orderdate), 'T') END
    AS trimestre FROM orders""",
    "locale_decimal": """WITH t AS (SELECT o_orderkey, o_orderpriority AS f, CAST(o_totalprice AS DECIMAL(15,2)) AS v,
  o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderkey % 3 = 0 AS comma FROM orders)
SELECT o_orderkey, CAST(CASE WHEN NOT comma AND MAX(comma) OVER (PARTITION BY f) THEN v * 100 ELSE v END AS DOUBLE)
  AS "ValorDespesas" FROM t""",
    "suspicious_flag": """SELECT c_custkey, c_custkey % 50 = 0 OR CAST(c_acctbal AS DECIMAL(15,2)) <= 0
  AS "DespesasSuspeitas" FROM customer""",
    "rows_per_source": """SELECT o_orderpriority AS source_file, COUNT(*) AS linhas FROM orders
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') GROUP BY 1""",
    "key_normalize": """SELECT c_custkey, CASE c_custkey % 5 WHEN 1 THEN c_custkey * 10 WHEN 3 THEN 0 WHEN 4 THEN 0
  ELSE c_custkey END AS reg_key FROM customer""",
    "zero_pad_codes": """SELECT c_custkey, LPAD(CAST(c_custkey AS VARCHAR), 6, '0') AS registro,
  LPAD(CAST(c_custkey * 7919 AS VARCHAR), 14, '0') AS cnpj, LPAD(CAST(c_custkey * 1000003 AS VARCHAR), 8, '0') AS cep,
  CASE WHEN LENGTH(CAST(c_custkey * 1000003 AS VARCHAR)) >= 8 THEN CAST(c_custkey * 1000003 AS VARCHAR)
    ELSE LPAD(CAST(c_custkey * 1000003 AS VARCHAR), 8, '0') END AS sem_corte FROM customer""",
    "staging_cast": f"""WITH {STAGED}, typed AS (
  SELECT * REPLACE (LPAD(registro_operadora, 6, '0') AS registro_operadora, LPAD(cnpj, 14, '0') AS cnpj,
      LPAD(cep, 8, '0') AS cep, COALESCE(complemento, '') AS complemento, COALESCE(fax, '') AS fax),
    ROW_NUMBER() OVER (PARTITION BY LPAD(registro_operadora, 6, '0') ORDER BY registro_operadora) AS rn FROM staged)
SELECT * EXCLUDE (arrival, rn) FROM typed WHERE rn = 1""",
    "dedup_first": """SELECT p_name, p_partkey, p_brand, p_retailprice FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY p_name ORDER BY p_partkey) AS rn FROM part) WHERE rn = 1""",
    "dedup_top_total": f"""WITH {NAME_TOTALS}
SELECT razao_social, uf, CAST(valor_total AS DOUBLE) AS valor_total FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY razao_social ORDER BY valor_total DESC, uf) AS rn FROM totals)
WHERE rn = 1""",
    "enrich_left_join": f"""WITH {ENRICHED}
SELECT "REG_ANS", cnpj, razao_social, modalidade, uf, "Trimestre", "Ano",
  CAST("ValorDespesas" AS DOUBLE) AS "ValorDespesas" FROM enriched""",
    "unmatched_expenses": f"""WITH {REG}, {EXPENSES}
SELECT "REG_ANS", "Trimestre", "Ano", CAST("ValorDespesas" AS DOUBLE) AS "ValorDespesas" FROM expenses e
WHERE NOT EXISTS (SELECT 1 FROM reg r WHERE r.reg_key = e.clean_key)""",
    "fact_load": f"""WITH {OP}
SELECT LPAD(CAST({KEY} AS VARCHAR), 6, '0') AS registro_operadora, {QUARTER} AS trimestre, {YEAR} AS ano,
  CAST({PRICE} AS DOUBLE) AS valor_despesas FROM orders
WHERE o_orderkey % 40 <> 0 AND {PRICE} > 0
  AND EXISTS (SELECT 1 FROM op WHERE op.registro_operadora = LPAD(CAST({KEY} AS VARCHAR), 6, '0'))""",
    "cnpj_check": f"""WITH t AS (SELECT c_custkey, LPAD(CAST(c_custkey * 7919 AS VARCHAR), 14, '0') AS base FROM customer),
u AS (SELECT c_custkey, CASE c_custkey % 5
    WHEN 0 THEN SUBSTR(base, 1, 8) || '/' || SUBSTR(base, 9, 4) || '-' || SUBSTR(base, 13, 2)
    WHEN 1 THEN REPEAT(CAST(c_custkey % 10 AS VARCHAR), 14) WHEN 2 THEN base || '0'
    ELSE CAST(c_custkey * 7919 AS VARCHAR) END AS cnpj FROM t)
SELECT c_custkey, cnpj, {cnpj_valid("cnpj")} AS cnpj_valido FROM u""",
    "quality_flags": f"""WITH t AS (SELECT c_custkey,
    CASE WHEN c_custkey % 10 = 0 THEN 'NAO ENCONTRADO' ELSE CAST(c_custkey * 7919 AS VARCHAR) END AS cnpj,
    CASE c_custkey % 10 WHEN 1 THEN '  ' WHEN 2 THEN 'RAZAO SOCIAL NAO LOCALIZADA' ELSE c_name END AS razao_social,
    CASE WHEN c_custkey % 10 = 3 THEN 0 ELSE CAST(c_acctbal AS DECIMAL(15,2)) END AS valor FROM customer)
SELECT c_custkey, CAST(valor AS DOUBLE) AS "ValorDespesas", {FLAGS}, valor <= 0 AS "FLAG_VALOR_INVALIDO" FROM t""",
    "quality_report": f"WITH {ENRICHED} {REPORT}",
    "batch_report": f"WITH {ENRICHED.replace(EXPENSES, RAW_EXPENSES)} {REPORT}",
    "batch_statistics": f"WITH {STATS.replace(EXPENSES, RAW_EXPENSES)} SELECT {STATS_COLUMNS} FROM stats",
    "batch_gold": f"WITH {STATS.replace(EXPENSES, RAW_EXPENSES)} {ONE_STATE}",
    "load_statistics": f"WITH {STATS} {ONE_STATE}",
    "batch_register": f"""WITH {OP}
SELECT registro_operadora, cnpj, razao_social, modalidade, cidade, uf, cep, representante FROM op""",
    "kept_value_flag": """SELECT c_custkey, CAST(CAST(c_acctbal AS DECIMAL(15,2)) AS VARCHAR) AS "ValorDespesas",
  c_custkey % 3 = 0 AS "FLAG_VALOR_INVALIDO" FROM customer""",
    "quarterly_sum": f"""WITH {QUARTERS}
SELECT razao_social, uf, ano, trimestre, CAST(valor AS DOUBLE) AS valor FROM quarters""",
    "operator_stats": f"WITH {STATS} SELECT {STATS_COLUMNS} FROM stats ORDER BY valor_total DESC, razao_social, uf",
    "operator_stats_unflagged": f"""WITH {STATS}
SELECT {STATS_COLUMNS} FROM stats WHERE NOT CONTAINS(razao_social, 'NAO LOCALIZADA')""",
    "growth_top5": f"""WITH {OP}, {FACTS}, sums AS (
  SELECT registro_operadora, ano * 10 + CAST(LEFT(trimestre, 1) AS INT) AS p, SUM(valor_despesas) AS v,
    DENSE_RANK() OVER (ORDER BY ano, trimestre) AS up, DENSE_RANK() OVER (ORDER BY ano DESC, trimestre DESC) AS down
  FROM dp GROUP BY registro_operadora, ano, trimestre),
pairs AS (SELECT registro_operadora, o.v AS v0, n.v AS v1 FROM sums o JOIN sums n USING (registro_operadora)
  WHERE o.up = 1 AND n.down = 1 AND LEAST(o.v, n.v) > 0)
SELECT razao_social, CAST(v0 AS DOUBLE) AS valor_inicial, CAST(v1 AS DOUBLE) AS valor_final,
  ROUND((CAST(v1 AS DOUBLE) - v0) / v0 * 100, 2) AS crescimento_percentual
FROM pairs JOIN op USING (registro_operadora) ORDER BY 4 DESC, 1 LIMIT 5""",
    "uf_total_avg": f"""WITH {OP}, {FACTS}
SELECT uf, CAST(SUM(valor_despesas) AS DOUBLE) AS despesas_totais,
  COUNT(DISTINCT op.registro_operadora) AS qtd_operadoras,
  {mean("SUM(valor_despesas)", "COUNT(DISTINCT op.registro_operadora)")} AS media_por_operadora
FROM dp JOIN op ON dp.registro_operadora = op.registro_operadora GROUP BY uf
ORDER BY SUM(valor_despesas) DESC, uf LIMIT 5""",
    "above_market_avg": f"""WITH {FACTS}, totals AS (
  SELECT ano, trimestre, registro_operadora, SUM(valor_despesas) AS total FROM dp GROUP BY ALL),
above AS (SELECT registro_operadora FROM (
    SELECT *, AVG(total) OVER (PARTITION BY ano, trimestre) AS media FROM totals)
  WHERE total > media GROUP BY registro_operadora HAVING COUNT(*) >= 2)
SELECT COUNT(*) AS qtd_operadoras_acima FROM above""",
    "search_page": f"""WITH {OP} SELECT registro_operadora, cnpj, razao_social, modalidade, uf FROM op
WHERE razao_social ILIKE '%R#0000001%' OR cnpj ILIKE '%R#0000001%'
ORDER BY registro_operadora LIMIT 10 OFFSET 10""",
    "paged_register": f"""WITH {OP} SELECT registro_operadora, cnpj, razao_social, modalidade, uf FROM op
ORDER BY registro_operadora LIMIT 10
OFFSET (SELECT GREATEST(0, (CAST(CEIL(COUNT(*) / 10.0) AS BIGINT) // 2 - 1) * 10) FROM customer)""",
    "search_index": f"""WITH {OP} SELECT registro_operadora, cnpj, razao_social, modalidade, uf FROM op
WHERE razao_social ILIKE '%er#%1_2%' OR cnpj ILIKE '%er#%1_2%'""",
    "search_count": f"""WITH {OP} SELECT COUNT(*) AS total, CAST(CEIL(COUNT(*) / 10.0) AS BIGINT) AS paginas FROM op
WHERE razao_social ILIKE '%19%' OR cnpj ILIKE '%19%'""",
    "lookup_identifier": f"""WITH {OP} SELECT registro_operadora, cnpj, razao_social, modalidade, uf FROM op
WHERE registro_operadora = '00000000641439' OR cnpj = '00000000641439' ORDER BY registro_operadora LIMIT 1""",
    "expense_history": f"""WITH {FACTS} SELECT trimestre, ano, CAST(valor_despesas AS DOUBLE) AS valor_despesas FROM dp
WHERE registro_operadora = '000074' ORDER BY ano DESC, trimestre DESC""",
    "history_labels": f"""WITH {FACTS} SELECT ano, trimestre || 'º Trimestre' AS trimestre,
  'R$' || CHR(160) || TRANSLATE(FORMAT('{{:,.2f}}', valor_despesas), ',.', '.,') AS valor FROM dp""",
    "operator_with_history": f"""WITH {OP}, {FACTS}
SELECT registro_operadora, trimestre, ano, CAST(valor_despesas AS DOUBLE) AS valor_despesas, razao_social, uf
FROM op JOIN dp USING (registro_operadora)""",
    "operator_card": f"""WITH {OP} SELECT registro_operadora, cnpj, razao_social, modalidade,
  '(' || COALESCE(ddd, '') || ') ' || telefone AS telefone,
  logradouro || ', ' || numero || ' ' || COALESCE(complemento, '') || ' - ' || bairro AS endereco,
  cidade || ' / ' || uf AS cidade_uf, cep, representante || ' (' || cargo_representante || ')' AS contato FROM op""",
    "dashboard_totals": f"""WITH {GOLD} SELECT CAST(COALESCE(SUM(valor_total), 0) AS DOUBLE) AS total_despesas,
  COALESCE({mean("SUM(valor_total)", "COUNT(*)")}, 0) AS media_despesas FROM gold""",
    "dashboard_top5": f"""WITH {GOLD} SELECT razao_social, uf, CAST(valor_total AS DOUBLE) AS valor_total FROM gold
ORDER BY gold.valor_total DESC NULLS LAST, razao_social LIMIT 5""",
    "dashboard_uf": f"""WITH {BY_STATE} SELECT {STATE_LABEL} AS uf, CAST(total AS DOUBLE) AS total FROM by_state
ORDER BY by_state.total DESC""",
    "uf_top5_others": f"""WITH {BY_STATE}, ranked AS (
  SELECT *, ROW_NUMBER() OVER (ORDER BY total DESC NULLS LAST, uf NULLS FIRST) AS rn FROM by_state)
SELECT {STATE_LABEL} AS uf, CAST(total AS DOUBLE) AS total FROM ranked WHERE rn <= 5
UNION ALL SELECT 'Outros', CAST(SUM(total) AS DOUBLE) FROM ranked WHERE rn > 5 HAVING SUM(total) > 0""",
    "label_truncate": """WITH t AS (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_name || ' ' || c_mktsegment
  ELSE c_name END AS s FROM customer)
SELECT c_custkey, CASE WHEN LENGTH(s) > 20 THEN LEFT(s, 20) || '...' ELSE s END AS rotulo FROM t""",
    "currency_label": """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN '-' ELSE '' END || 'R$' || CHR(160)
  || TRANSLATE(FORMAT('{:,.2f}', ABS(CAST(c_acctbal AS DECIMAL(15,2)))), ',.', '.,') AS rotulo FROM customer""",
    "audit_unique": f"""WITH {NAME_TOTALS}, staged AS (
  SELECT CAST(c_custkey AS VARCHAR) AS r, CAST(c_custkey * 7919 AS VARCHAR) AS c FROM customer
  UNION ALL SELECT CAST(s_suppkey * 3 AS VARCHAR), CAST(s_suppkey * 7919 * 2 AS VARCHAR) FROM supplier)
SELECT 'registro_operadora' AS coluna, r AS chave, COUNT(*) AS linhas FROM staged GROUP BY r HAVING COUNT(*) > 1
UNION ALL SELECT 'cnpj', c, COUNT(*) FROM staged GROUP BY c HAVING COUNT(*) > 1
UNION ALL SELECT 'razao_social', razao_social, COUNT(*) FROM totals GROUP BY razao_social HAVING COUNT(*) > 1""",
    "audit_not_null": f"""WITH {STAGED}
SELECT 'registro_operadora' AS coluna, COUNT(*) FILTER (WHERE o_custkey IS NULL) AS linhas FROM orders
UNION ALL SELECT 'trimestre', COUNT(*) FILTER (WHERE o_orderdate IS NULL) FROM orders
UNION ALL SELECT 'ano', COUNT(*) FILTER (WHERE o_orderdate IS NULL) FROM orders
UNION ALL SELECT 'valor_despesas', COUNT(*) FILTER (WHERE o_orderkey % 40 = 0) FROM orders
UNION ALL SELECT 'registro_operadora', COUNT(*) FILTER (WHERE registro_operadora IS NULL) FROM staged
UNION ALL SELECT 'cnpj', COUNT(*) FILTER (WHERE cnpj IS NULL) FROM staged
UNION ALL SELECT 'razao_social', COUNT(*) FILTER (WHERE razao_social IS NULL) FROM staged
UNION ALL SELECT 'complemento', COUNT(*) FILTER (WHERE complemento IS NULL) FROM staged""",
    "audit_on_write": f"""WITH {STAGED}, flags AS (SELECT *, registro_operadora IS NULL OR cnpj IS NULL
    OR razao_social IS NULL OR complemento IS NULL AS nulo, LENGTH(registro_operadora) > 6 AS l1, LENGTH(cnpj) > 14 AS l2,
    LENGTH(bairro) > 50 AS l3, LENGTH(cidade) > 50 AS l4, LENGTH(uf) > 2 AS l5, LENGTH(cep) > 8 AS l6,
    LENGTH(telefone) > 20 AS l7, COALESCE(LENGTH(fax) > 20, false) AS l8 FROM staged),
bad AS (SELECT *, nulo OR l1 OR l2 OR l3 OR l4 OR l5 OR l6 OR l7 OR l8 AS ruim FROM flags)
SELECT 'obrigatoria' AS regra, 'registro_operadora' AS coluna, COUNT(*) FILTER (WHERE registro_operadora IS NULL) AS linhas FROM bad
UNION ALL SELECT 'obrigatoria', 'cnpj', COUNT(*) FILTER (WHERE cnpj IS NULL) FROM bad
UNION ALL SELECT 'obrigatoria', 'razao_social', COUNT(*) FILTER (WHERE razao_social IS NULL) FROM bad
UNION ALL SELECT 'obrigatoria', 'complemento', COUNT(*) FILTER (WHERE complemento IS NULL) FROM bad
UNION ALL SELECT 'largura', 'registro_operadora', COUNT(*) FILTER (WHERE l1) FROM bad
UNION ALL SELECT 'largura', 'cnpj', COUNT(*) FILTER (WHERE l2) FROM bad
UNION ALL SELECT 'largura', 'bairro', COUNT(*) FILTER (WHERE l3) FROM bad
UNION ALL SELECT 'largura', 'cidade', COUNT(*) FILTER (WHERE l4) FROM bad
UNION ALL SELECT 'largura', 'uf', COUNT(*) FILTER (WHERE l5) FROM bad
UNION ALL SELECT 'largura', 'cep', COUNT(*) FILTER (WHERE l6) FROM bad
UNION ALL SELECT 'largura', 'telefone', COUNT(*) FILTER (WHERE l7) FROM bad
UNION ALL SELECT 'largura', 'fax', COUNT(*) FILTER (WHERE l8) FROM bad
UNION ALL SELECT 'rejeitada', '', COUNT(*) FILTER (WHERE ruim) FROM bad
UNION ALL SELECT 'lida', '', COUNT(*) FROM bad
UNION ALL SELECT 'gravada', 'validas', COUNT(*) FILTER (WHERE NOT ruim) FROM bad
UNION ALL SELECT 'gravada', 'invalidas', COUNT(*) FILTER (WHERE ruim) FROM bad""",
    "audit_width": f"""WITH {STAGED}, {FACTS}, widths AS (
  SELECT * FROM (VALUES ('registro_operadora', 6), ('cnpj', 14), ('bairro', 50), ('cidade', 50), ('uf', 2),
    ('cep', 8), ('telefone', 20), ('fax', 20)) AS w(coluna, n)),
long AS (
  SELECT 'registro_operadora' AS coluna, registro_operadora AS v FROM staged
  UNION ALL SELECT 'cnpj', cnpj FROM staged UNION ALL SELECT 'bairro', bairro FROM staged
  UNION ALL SELECT 'cidade', cidade FROM staged UNION ALL SELECT 'uf', uf FROM staged
  UNION ALL SELECT 'cep', cep FROM staged UNION ALL SELECT 'telefone', telefone FROM staged
  UNION ALL SELECT 'fax', fax FROM staged)
SELECT coluna, COUNT(*) FILTER (WHERE LENGTH(v) > n) AS linhas FROM long JOIN widths USING (coluna) GROUP BY coluna
UNION ALL SELECT 'registro_operadora', COUNT(*) FILTER (WHERE LENGTH(registro_operadora) > 6) FROM dp
UNION ALL SELECT 'trimestre', COUNT(*) FILTER (WHERE LENGTH(trimestre) > 2) FROM dp""",
    "audit_fk": f"""WITH {OP}, {FACTS} SELECT registro_operadora, COUNT(*) AS linhas FROM dp
WHERE registro_operadora NOT IN (SELECT registro_operadora FROM op) GROUP BY registro_operadora""",
}
