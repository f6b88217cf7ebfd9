"""Independent ANSI-SQL statements (DuckDB dialect) for the registered queries.

Each statement reads the given tables directly -- it does not go through
messages, JSON, deduplication or surrogate-key machinery -- and must return
the same rows as the Spark query of the same name.
"""

from __future__ import annotations

from .functions.lookup import STATE_CODES, STATES, UNKNOWN_LABEL
from .functions.money import sql_rounded_mean

_STATE_LIST = "[" + ", ".join(f"'{c}'" for c in STATE_CODES) + "]"
_STATES_VALUES = (
    "(VALUES " + ", ".join(f"('{u}', '{n}', '{r}')" for u, n, r in STATES) + ") AS st(uf, estado_completo, regiao)"
)
_UNKNOWN = f"'{UNKNOWN_LABEL}'"
PUBLICATIONS = 2

INVOICES = f"""
amounts AS (
  SELECT l_orderkey,
         SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS vp,
         CAST(ROUND(SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2))), 2) AS DECIMAL(18,2)) AS vd
  FROM lineitem GROUP BY l_orderkey),
issuers AS (
  SELECT c.c_custkey, lpad(CAST(c.c_custkey AS VARCHAR), 14, '0') AS cnpj_emitente, c.c_name AS nome_emitente,
         {_STATE_LIST}[n.n_nationkey + 1] AS uf_emitente, c.c_mktsegment AS municipio_emitente
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey),
invoices AS (
  SELECT 'NFe' || lpad(CAST(o.o_orderkey AS VARCHAR), 44, '0') AS id_nfe,
         CAST(o.o_orderkey AS VARCHAR) AS numero_nfe,
         o.o_orderstatus AS serie,
         strftime(o.o_orderdate, '%Y-%m-%dT%H:%M:%S') || '-03:00' AS data_emissao,
         o.o_orderpriority AS natureza_operacao,
         i.cnpj_emitente, i.nome_emitente, i.uf_emitente, i.municipio_emitente,
         CAST(NULL AS VARCHAR) AS cpf_destinatario, CAST(NULL AS VARCHAR) AS cnpj_destinatario,
         CAST(NULL AS VARCHAR) AS nome_destinatario,
         CAST(a.vp AS VARCHAR) AS valor_produtos, CAST(a.vd AS VARCHAR) AS valor_desconto,
         CAST(CAST(o.o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS valor_total_nf,
         'nfe_' || CAST(o.o_orderkey AS VARCHAR) || '.xml' AS arquivo_origem,
         o.o_orderkey, o.o_orderdate AS issue_ts
  FROM orders o
  LEFT JOIN amounts a ON a.l_orderkey = o.o_orderkey
  LEFT JOIN issuers i ON i.c_custkey = o.o_custkey),
typed AS (
  SELECT *, TRY_CAST(valor_produtos AS DOUBLE) AS vp_d, TRY_CAST(valor_desconto AS DOUBLE) AS vd_d,
         TRY_CAST(valor_total_nf AS DOUBLE) AS vt_d
  FROM invoices),
silver AS (
  SELECT id_nfe, numero_nfe, serie, data_emissao, trim(natureza_operacao, ' ') AS natureza_operacao,
         cnpj_emitente, trim(nome_emitente, ' ') AS nome_emitente, uf_emitente,
         trim(municipio_emitente, ' ') AS municipio_emitente, trim(nome_destinatario, ' ') AS nome_destinatario,
         vp_d AS valor_produtos, vd_d AS valor_desconto, vt_d AS valor_total_nf, arquivo_origem,
         o_orderkey, issue_ts
  FROM typed
  WHERE id_nfe IS NOT NULL AND cnpj_emitente IS NOT NULL AND vt_d IS NOT NULL AND data_emissao IS NOT NULL
    AND vt_d > 0 AND vp_d > 0 AND vd_d >= 0)"""

DIMS = f"""
dim_e AS (
  SELECT CAST(row_number() OVER (ORDER BY cnpj) AS BIGINT) AS id_emitente, cnpj, nome, uf, municipio
  FROM (SELECT cnpj_emitente AS cnpj, nome_emitente AS nome, uf_emitente AS uf, municipio_emitente AS municipio,
               row_number() OVER (PARTITION BY cnpj_emitente
                                  ORDER BY issue_ts DESC, id_nfe DESC, nome_emitente DESC NULLS LAST,
                                           uf_emitente DESC NULLS LAST, municipio_emitente DESC NULLS LAST) AS rn
        FROM silver) WHERE rn = 1),
dim_d AS (
  SELECT CAST(row_number() OVER (ORDER BY d NULLS FIRST) AS BIGINT) AS id_data, strftime(d, '%Y-%m-%d') AS data,
         CAST(day(d) AS INTEGER) AS dia, CAST(month(d) AS INTEGER) AS mes, CAST(year(d) AS INTEGER) AS ano,
         CAST(quarter(d) AS INTEGER) AS trimestre
  FROM (SELECT DISTINCT CAST(issue_ts AS DATE) AS d FROM silver)),
dim_l AS (
  SELECT CAST(row_number() OVER (ORDER BY u.uf NULLS FIRST) AS BIGINT) AS id_localidade, u.uf,
         coalesce(st.regiao, {_UNKNOWN}) AS regiao, coalesce(st.estado_completo, {_UNKNOWN}) AS estado_completo
  FROM (SELECT DISTINCT uf_emitente AS uf FROM silver) u LEFT JOIN {_STATES_VALUES} ON u.uf = st.uf),
fact AS (
  SELECT CAST(row_number() OVER (ORDER BY s.id_nfe, d.id_data NULLS FIRST) AS BIGINT) AS id_venda, s.id_nfe,
         e.id_emitente, d.id_data, l.id_localidade,
         ROUND(s.valor_total_nf, 2) AS valor_total, ROUND(s.valor_produtos, 2) AS valor_produtos,
         ROUND(s.valor_desconto, 2) AS valor_desconto
  FROM silver s
  LEFT JOIN dim_e e ON e.cnpj = s.cnpj_emitente
  LEFT JOIN dim_l l ON l.uf IS NOT DISTINCT FROM s.uf_emitente
  LEFT JOIN dim_d d ON d.data = strftime(CAST(s.issue_ts AS DATE), '%Y-%m-%d'))"""

_SUM = "SUM(CAST(s.valor_total_nf AS DECIMAL(18,2)))"
_MEASURES = (
    "COUNT(s.id_nfe) AS quantidade_nfe, "
    f"CAST({_SUM} AS DOUBLE) AS faturamento_total, "
    f"{sql_rounded_mean(_SUM, 'COUNT(s.valor_total_nf)')} AS ticket_medio"
)

_SILVER_COLS = (
    "id_nfe, numero_nfe, serie, data_emissao, natureza_operacao, cnpj_emitente, nome_emitente, uf_emitente, "
    "municipio_emitente, nome_destinatario, valor_produtos, valor_desconto, valor_total_nf, arquivo_origem"
)

SALES_BY_STATE = f"""WITH {INVOICES}
SELECT s.uf_emitente AS uf, coalesce(st.regiao, {_UNKNOWN}) AS regiao, {_MEASURES}
FROM silver s LEFT JOIN {_STATES_VALUES} ON st.uf = s.uf_emitente
GROUP BY s.uf_emitente, coalesce(st.regiao, {_UNKNOWN})
ORDER BY faturamento_total DESC, uf, regiao"""

TOP_EMITTERS = f"""WITH {INVOICES}
SELECT s.cnpj_emitente AS cnpj, s.nome_emitente AS nome, s.uf_emitente AS uf, {_MEASURES}
FROM silver s
GROUP BY s.cnpj_emitente, s.nome_emitente, s.uf_emitente
ORDER BY faturamento_total DESC, cnpj, uf, nome
LIMIT 10"""

MONTHLY_EVOLUTION = f"""WITH {INVOICES}
SELECT CAST(year(s.issue_ts) AS INTEGER) AS ano, CAST(month(s.issue_ts) AS INTEGER) AS mes, {_MEASURES}
FROM silver s
GROUP BY 1, 2
ORDER BY ano, mes"""

# the gate's other checks, counted on the clean rows
_BAD = "valor_total_nf <= 0 OR valor_produtos <= 0 OR valor_desconto < 0"
_NO_AMOUNT = "valor_total_nf IS NULL OR valor_produtos IS NULL OR valor_desconto IS NULL"
_NOT_GIVEN = "id_nfe IS NULL OR cnpj_emitente IS NULL OR valor_total_nf IS NULL OR data_emissao IS NULL"
GATE_VALUES = "\nUNION ALL ".join(
    f"SELECT '{name}', COUNT(*) FILTER (WHERE {rule}), CAST(0 AS BIGINT), COUNT(*) FILTER (WHERE {rule}) = 0 FROM silver"
    for name, rule in (("invalid_values", _BAD), ("null_amounts", _NO_AMOUNT), ("null_required", _NOT_GIVEN))
)

ORACLE: dict[str, str] = {
    "silver_layer": f"WITH {INVOICES} SELECT {_SILVER_COLS} FROM silver",
    "reject_counts": f"""WITH {INVOICES},
counts AS (
  SELECT COUNT(*) AS total,
         COUNT(*) FILTER (WHERE id_nfe IS NULL OR cnpj_emitente IS NULL OR vt_d IS NULL OR data_emissao IS NULL) AS nr,
         (SELECT COUNT(*) FROM silver) AS ok
  FROM typed)
SELECT 'input' AS stage, CAST({PUBLICATIONS} * total AS BIGINT) AS rows FROM counts
UNION ALL SELECT 'null_required', CAST({PUBLICATIONS} * nr AS BIGINT) FROM counts
UNION ALL SELECT 'invalid_value', CAST({PUBLICATIONS} * (total - nr - ok) AS BIGINT) FROM counts
UNION ALL SELECT 'duplicate', CAST(({PUBLICATIONS} - 1) * ok AS BIGINT) FROM counts
UNION ALL SELECT 'output', CAST(ok AS BIGINT) FROM counts""",
    "quality_report": f"""WITH {INVOICES},
c AS (SELECT COUNT(*) AS n, COUNT(DISTINCT id_nfe) AS k FROM silver)
SELECT 'row_count' AS "check", CAST(n AS BIGINT) AS observed,
       (SELECT CAST(COUNT(DISTINCT o_orderkey) AS BIGINT) FROM orders) AS expected,
       n = (SELECT COUNT(DISTINCT o_orderkey) FROM orders) AS passed FROM c
UNION ALL SELECT 'duplicate_keys', CAST(n - k AS BIGINT), CAST(0 AS BIGINT), n = k FROM c
UNION ALL {GATE_VALUES}""",
    "dim_emitter": f"WITH {INVOICES}, {DIMS} SELECT * FROM dim_e",
    "dim_date": f"WITH {INVOICES}, {DIMS} SELECT * FROM dim_d",
    "dim_location": f"WITH {INVOICES}, {DIMS} SELECT * FROM dim_l",
    "fact_sales": f"WITH {INVOICES}, {DIMS} SELECT * FROM fact",
    "star_row_totals": f"""WITH {INVOICES}, {DIMS}
SELECT 'dim_emitente' AS table_name, CAST(COUNT(*) AS BIGINT) AS row_count FROM dim_e
UNION ALL SELECT 'dim_data', CAST(COUNT(*) AS BIGINT) FROM dim_d
UNION ALL SELECT 'dim_localidade', CAST(COUNT(*) AS BIGINT) FROM dim_l
UNION ALL SELECT 'fato_vendas', CAST(COUNT(*) AS BIGINT) FROM fact""",
    "sales_by_state": SALES_BY_STATE,
    "top_emitters": TOP_EMITTERS,
    "monthly_evolution": MONTHLY_EVOLUTION,
    "sales_by_state_sql": SALES_BY_STATE,
    "top_emitters_sql": TOP_EMITTERS,
    "monthly_evolution_sql": MONTHLY_EVOLUTION,
}

_HEADER_COLS = (
    "id_nfe, numero_nfe, serie, data_emissao, natureza_operacao, cnpj_emitente, nome_emitente, uf_emitente, "
    "municipio_emitente, cpf_destinatario, cnpj_destinatario, nome_destinatario, valor_produtos, valor_desconto, "
    "valor_total_nf"
)
_INVOICE_FIELDS = _HEADER_COLS.split(", ") + ["arquivo_origem"]


def _json_object(fields: list[str]) -> str:
    parts = [
        f"""'"{f}":' || CASE WHEN {f} IS NULL THEN 'null' ELSE '"' || {f} || '"' END""" for f in fields
    ]
    return "'{' || " + " || ',' || ".join(parts) + " || '}'"


def _per_publication(select: str, where: str = "") -> str:
    """The same rows once per publication (offset = key * publications + run)."""
    return "\nUNION ALL\n".join(
        select.replace("{run}", str(r)) + (f" WHERE {where}" if where else "") for r in range(PUBLICATIONS)
    )


ORACLE.update(
    {
        "xml_header": f"WITH {INVOICES} SELECT {_HEADER_COLS}, arquivo_origem FROM invoices",
        "xml_items": """
SELECT 'NFe' || lpad(CAST(l_orderkey AS VARCHAR), 44, '0') AS id_nfe,
       'nfe_' || CAST(l_orderkey AS VARCHAR) || '.xml' AS arquivo_origem,
       CAST(l_linenumber AS VARCHAR) AS numero_item, CAST(l_partkey AS VARCHAR) AS codigo,
       CAST(NULL AS VARCHAR) AS descricao, CAST(l_suppkey AS VARCHAR) AS ncm, l_linestatus AS cfop,
       l_returnflag AS unidade, CAST(CAST(l_quantity AS DECIMAL(18,4)) AS VARCHAR) AS quantidade,
       CAST(NULL AS VARCHAR) AS valor_unitario,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS valor_total_item
FROM lineitem""",
        "xml_errors": """
SELECT 'nfe_' || CAST(o_orderkey AS VARCHAR) || '.xml' AS arquivo_origem,
       CASE o_orderpriority WHEN '5-LOW' THEN 'malformed XML'
                            WHEN '4-NOT SPECIFIED' THEN 'infNFe not found'
                            ELSE 'ide not found' END AS erro
FROM orders WHERE o_orderpriority IN ('5-LOW', '4-NOT SPECIFIED', '3-MEDIUM')""",
        "xml_files": f"WITH {INVOICES} SELECT {_HEADER_COLS} FROM invoices",
        "message_roundtrip": f"WITH {INVOICES} SELECT {_HEADER_COLS}, arquivo_origem FROM invoices",
        "json_payload_roundtrip": f"WITH {INVOICES} SELECT {_HEADER_COLS}, arquivo_origem FROM invoices",
        "bronze_layer": f"WITH {INVOICES}\n"
        + _per_publication(
            f"SELECT {_json_object(_INVOICE_FIELDS)} AS payload, o_orderkey * {PUBLICATIONS} + {{run}} AS \"offset\" FROM invoices"
        ),
        "topic_not_empty": """
SELECT 'messages_not_empty' AS "check", CAST(LEAST(COUNT(*), 1) AS BIGINT) AS observed,
       CAST(1 AS BIGINT) AS expected, COUNT(*) >= 1 AS passed
FROM orders""",
        "json_extract_cast": "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events",
        "filter_required": f"WITH {INVOICES}\n"
        + _per_publication(
            f"SELECT id_nfe, o_orderkey * {PUBLICATIONS} + {{run}} AS \"offset\", vp_d AS valor_produtos, "
            "vd_d AS valor_desconto, vt_d AS valor_total_nf FROM typed",
            "id_nfe IS NOT NULL AND cnpj_emitente IS NOT NULL AND vt_d IS NOT NULL AND data_emissao IS NOT NULL "
            "AND vp_d IS NOT NULL",
        ),
        "filter_values": "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 0",
        "dedupe_by_key": """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, l_shipdate
FROM (SELECT *, row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST,
                 l_quantity DESC NULLS LAST, l_extendedprice DESC NULLS LAST, l_discount DESC NULLS LAST,
                 l_tax DESC NULLS LAST, l_returnflag DESC NULLS LAST, l_linestatus DESC NULLS LAST) AS rn
      FROM lineitem)
WHERE rn = 1""",
        "trim_text": "SELECT doc_id, trim(text, ' ') AS text FROM documents",
        "state_region_lookup": f"""WITH {INVOICES}
SELECT i.c_custkey, i.uf_emitente AS uf, coalesce(st.regiao, {_UNKNOWN}) AS regiao,
       coalesce(st.estado_completo, {_UNKNOWN}) AS estado_completo
FROM issuers i LEFT JOIN {_STATES_VALUES} ON st.uf = i.uf_emitente""",
        "sales_by_state_catalog": SALES_BY_STATE,
    }
)

ORACLE["rounded_mean_boundary"] = "SELECT o_orderkey, CAST(o_custkey AS DOUBLE) / 100 AS ticket_medio FROM orders"
ORACLE["silver_incremental"] = ORACLE["silver_layer"]

ORACLE.update(
    {
        "quarantine_rows": f"""WITH {INVOICES}
SELECT id_nfe, o_orderkey * {PUBLICATIONS} + r.run AS "offset",
       CASE WHEN vp_d IS NULL OR vd_d IS NULL OR NOT (vt_d > 0 AND vp_d > 0 AND vd_d >= 0) THEN 'invalid_value'
            ELSE 'duplicate' END AS reject_reason
FROM typed JOIN (SELECT range AS run FROM range({PUBLICATIONS})) r
  ON r.run < {PUBLICATIONS} - 1 OR vp_d IS NULL OR vd_d IS NULL OR NOT (vt_d > 0 AND vp_d > 0 AND vd_d >= 0)""",
        "items_reconciliation": f"""WITH {INVOICES}
SELECT 'NFe' || lpad(CAST(l.l_orderkey AS VARCHAR), 44, '0') AS id_nfe,
       CAST(SUM(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS soma_itens,
       CAST(MAX(a.vp) AS DOUBLE) AS valor_produtos,
       coalesce(SUM(CAST(l.l_extendedprice AS DECIMAL(18,2))) = MAX(a.vp), false) AS confere
FROM lineitem l JOIN amounts a ON a.l_orderkey = l.l_orderkey
GROUP BY l.l_orderkey""",
        "fact_sales_timestamp_grain": """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS data, COUNT(*) AS notas, COUNT(DISTINCT ts) AS instantes,
       COUNT(*) * COUNT(DISTINCT ts) AS linhas_fato
FROM events GROUP BY CAST(ts AS DATE)""",
        "sales_by_state_saved": SALES_BY_STATE,
    }
)

ORACLE.update({"parquet_roundtrip": "SELECT * FROM orders", "json_roundtrip": "SELECT * FROM customer"})

ORACLE["sales_by_state_from_documents"] = SALES_BY_STATE

ORACLE["stream_reject_counts"] = ORACLE["reject_counts"]
ORACLE["silver_incremental_deduplicated"] = ORACLE["silver_layer"]
ORACLE["stream_quarantine"] = f"SELECT * FROM ({ORACLE['quarantine_rows']}) WHERE reject_reason <> 'duplicate'"
# of the copies of a valid invoice all but the first are dropped; its id is held
ORACLE["stream_dedupe_totals"] = f"""WITH {INVOICES},
c AS (SELECT (SELECT COUNT(*) FROM invoices) AS n, (SELECT COUNT(*) FROM silver) AS ok)
SELECT 'input' AS stage, CAST({PUBLICATIONS} * n AS BIGINT) AS rows FROM c
UNION ALL SELECT 'dropped', CAST(({PUBLICATIONS} - 1) * ok AS BIGINT) FROM c
UNION ALL SELECT 'ids', CAST(ok AS BIGINT) FROM c
UNION ALL SELECT 'held', CAST(ok AS BIGINT) FROM c"""

ORACLE["xml_directory_stream"] = ORACLE["xml_header"]
ORACLE["gate_against_ledger"] = f"""WITH {INVOICES},
c AS (SELECT COUNT(*) AS n, COUNT(DISTINCT id_nfe) AS k FROM silver),
p AS (SELECT COUNT(DISTINCT id_nfe) AS e FROM typed WHERE NOT ({_NOT_GIVEN.replace("valor_total_nf", "vt_d")})
        AND vt_d > 0 AND vp_d > 0 AND vd_d >= 0)
SELECT 'row_count' AS "check", CAST(n AS BIGINT) AS observed, CAST(e AS BIGINT) AS expected, n = e AS passed FROM c, p
UNION ALL SELECT 'duplicate_keys', CAST(n - k AS BIGINT), CAST(0 AS BIGINT), n = k FROM c
UNION ALL {GATE_VALUES}"""
ORACLE["gate_on_orders"] = """
WITH a AS (SELECT l_orderkey, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS v FROM lineitem GROUP BY 1),
o AS (SELECT o_custkey, a.v, c.c_acctbal AS b FROM orders LEFT JOIN a ON a.l_orderkey = o_orderkey LEFT JOIN customer c ON c.c_custkey = o_custkey),
t AS (SELECT 'row_count' AS "check", COUNT(*) AS observed, (SELECT COUNT(*) FROM customer) AS expected FROM o
  UNION ALL SELECT 'duplicate_keys', COUNT(*) - COUNT(DISTINCT o_custkey), 0 FROM o
  UNION ALL SELECT 'invalid_values', COUNT(*) FILTER (WHERE b <= 0 OR v < 0), 0 FROM o
  UNION ALL SELECT 'null_amounts', COUNT(*) FILTER (WHERE b IS NULL OR v IS NULL), 0 FROM o
  UNION ALL SELECT 'null_required', COUNT(*) FILTER (WHERE v IS NULL), 0 FROM o)
SELECT "check", CAST(observed AS BIGINT) AS observed, CAST(expected AS BIGINT) AS expected, observed = expected AS passed FROM t"""
ORACLE["item_text_rules"] = """
SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag = 'A' THEN l_linestatus || chr(9) ELSE l_linestatus END AS codigo,
       CASE WHEN l_returnflag <> 'R' THEN CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) END AS valor,
       ROUND(CAST(l_quantity AS DOUBLE) / 8, 2) AS oitavos
FROM lineitem"""

# items: whole cents of each share, the cents left over to the largest remainders
_ITEMS = f"""
lines AS (
  SELECT l.*, s.id_nfe, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS HUGEINT) AS p,
         CAST(CAST(s.valor_desconto AS DECIMAL(18,2)) * 100 AS HUGEINT) AS d, CAST(s.valor_total_nf AS DECIMAL(18,2)) AS total,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
                            l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS posicao
  FROM lineitem l JOIN silver s ON s.o_orderkey = l.l_orderkey),
shares AS (
  SELECT *, (d * p) // SUM(p) OVER o AS whole, (d * p) % SUM(p) OVER o AS rest FROM lines WINDOW o AS (PARTITION BY l_orderkey)),
spread AS (
  SELECT *, whole + CASE WHEN row_number() OVER (PARTITION BY l_orderkey ORDER BY rest DESC, posicao)
                              <= d - SUM(whole) OVER (PARTITION BY l_orderkey) THEN 1 ELSE 0 END AS cut
  FROM shares)"""
ORACLE["fact_items"] = f"""WITH {INVOICES}, {DIMS}, {_ITEMS}
SELECT CAST(row_number() OVER (ORDER BY i.id_nfe, posicao) AS BIGINT) AS id_item, i.id_nfe, CAST(posicao AS INTEGER) AS posicao,
       f.id_venda, f.id_emitente, f.id_data, f.id_localidade, CAST(l_linenumber AS VARCHAR) AS numero_item,
       CAST(l_partkey AS VARCHAR) AS codigo, CAST(CAST(l_quantity AS DECIMAL(18,4)) AS DOUBLE) AS quantidade,
       CAST(p AS DOUBLE) / 100 AS valor_item, CAST(cut AS DOUBLE) / 100 AS valor_desconto, CAST(p - cut AS DOUBLE) / 100 AS valor_liquido
FROM spread i JOIN fact f ON f.id_nfe = i.id_nfe"""
ORACLE["items_against_totals"] = f"""WITH {INVOICES}, {_ITEMS}
SELECT id_nfe, CAST(SUM(p) AS BIGINT) AS itens_centavos, CAST(SUM(cut) AS BIGINT) AS desconto_centavos,
       CAST(MAX(total) * 100 AS BIGINT) AS total_centavos, SUM(cut) = MAX(d) AS desconto_confere,
       SUM(p) - SUM(cut) = CAST(MAX(total) * 100 AS BIGINT) AS total_confere
FROM spread GROUP BY id_nfe"""

# members of the first load are numbered first
_EARLY = "early AS (SELECT * FROM silver WHERE natureza_operacao = '1-URGENT')"
_DIMS_TWO = (
    DIMS.replace("row_number() OVER (ORDER BY cnpj)", "row_number() OVER (ORDER BY cnpj NOT IN (SELECT cnpj_emitente FROM early), cnpj)")
    .replace("row_number() OVER (ORDER BY d NULLS FIRST)",
             "row_number() OVER (ORDER BY NOT EXISTS (SELECT 1 FROM early e WHERE CAST(e.issue_ts AS DATE) IS NOT DISTINCT FROM x.d), d NULLS FIRST)")
    .replace("(SELECT DISTINCT CAST(issue_ts AS DATE) AS d FROM silver))", "(SELECT DISTINCT CAST(issue_ts AS DATE) AS d FROM silver) x)")
    .replace("row_number() OVER (ORDER BY u.uf NULLS FIRST)",
             "row_number() OVER (ORDER BY NOT EXISTS (SELECT 1 FROM early e WHERE e.uf_emitente IS NOT DISTINCT FROM u.uf), u.uf NULLS FIRST)")
    .replace("row_number() OVER (ORDER BY s.id_nfe, d.id_data NULLS FIRST)",
             "row_number() OVER (ORDER BY s.natureza_operacao <> '1-URGENT', s.id_nfe)")
)
ORACLE["dim_emitter_two_loads"] = f"WITH {INVOICES}, {_EARLY}, {_DIMS_TWO} SELECT * FROM dim_e"
ORACLE["fact_sales_two_loads"] = f"WITH {INVOICES}, {_EARLY}, {_DIMS_TWO} SELECT * FROM fact"
