"""Independent DuckDB SQL for every registered query (same column names).

Rounding note: Spark rounds a double HALF_UP on its shortest decimal text,
DuckDB on the binary value, so shares are rounded here through
``varchar -> decimal`` to compare like with like.
"""

from __future__ import annotations


def _pct(num: str, den: str) -> str:
    return (f"CAST(round(CAST(CAST({num} / {den} * 100 AS VARCHAR) AS DECIMAL(38,20)), 1)"
            f" AS DOUBLE)")


_OC = """(SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, o_orderstatus,
                 o_orderpriority, c_custkey, c_mktsegment, c_nationkey
          FROM orders JOIN customer ON o_custkey = c_custkey)"""

_OCG = f"""(SELECT oc.*, n_name, r_name FROM {_OC} oc
           JOIN nation ON c_nationkey = n_nationkey
           JOIN region ON n_regionkey = r_regionkey)"""

_TYPE_CELLS = """(SELECT l_orderkey,
                 string_agg(DISTINCT p_type || ' (novo, usado).', ', '
                            ORDER BY p_type || ' (novo, usado).') AS cell
          FROM lineitem JOIN part ON l_partkey = p_partkey
          GROUP BY l_orderkey)"""

_DOC_PIECES = """(SELECT lang, doc_id, trim(piece, ' ') AS option
          FROM documents, unnest(regexp_split_to_array(text, ',\\s*')) AS t(piece))"""

_EVENTS = "(SELECT CAST(ts AS DATE) AS day, event_type, user_id FROM events)"

_DAILY_REACH = f"""
WITH e AS {_EVENTS},
c AS (SELECT day, event_type, count(DISTINCT user_id) AS n_users FROM e GROUP BY day, event_type),
t AS (SELECT day, count(DISTINCT user_id) AS total FROM e GROUP BY day)
SELECT c.day, c.event_type, c.n_users, {_pct('c.n_users', 't.total')} AS pct_users
FROM c JOIN t USING (day)"""


def _count_sql(source: str, keys: list[str], measure: str) -> str:
    k = ", ".join(keys)
    return f"SELECT {k}, count(*) AS {measure} FROM {source} s GROUP BY {k}"


MARKET_PANORAMA = _count_sql(_OC, ["year", "o_orderstatus", "c_mktsegment", "o_orderpriority"],
                             "n_orders")
PROFESSIONAL_PROFILES = _count_sql(_OC, ["year", "c_mktsegment", "o_orderpriority"], "n_orders")
DIVERSITY_PROFILE = _count_sql(_OCG, ["year", "c_mktsegment", "o_orderpriority", "o_orderstatus",
                                      "n_name", "r_name"], "n_orders")
REGIONAL_PROFILE = _count_sql(_OCG, ["year", "r_name", "o_orderpriority", "o_orderstatus"],
                              "n_orders")


def _invalid(name: str, sql: str) -> str:
    return (f"SELECT '{name}' AS mart, count(*) FILTER (WHERE n_orders <= 0) AS invalid_rows, "
            f"count(*) AS mart_rows FROM ({sql}) m")


_WIDE_COLUMNS = (
    "c_custkey c_name c_nationkey c_acctbal c_mktsegment o_orderkey o_custkey o_orderstatus o_totalprice "
    "o_orderdate o_orderpriority l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice "
    "l_discount l_tax l_returnflag l_linestatus l_shipdate").split()
_TOP_NULLS = """
WITH w AS (SELECT * FROM customer LEFT JOIN orders ON c_custkey = o_custkey
           LEFT JOIN lineitem ON o_orderkey = l_orderkey),
p AS (""" + " UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_nulls, "
    f"count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*) AS pct_nulls FROM w"
    for i, c in enumerate(_WIDE_COLUMNS, start=1)) + """)
SELECT * FROM p ORDER BY n_nulls DESC, position ASC LIMIT 15"""

_CONTENT_COLUMNS = {
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount "
                "l_tax l_returnflag l_linestatus l_shipdate",
}


def _content_row(name: str, table: str, column: str, read: str, status: str = "OK", where: str = "true") -> str:
    def nulls(t):
        return "0" if column == "*" else f"(SELECT count(*) - count({column}) FROM {t})"
    return (f"SELECT '{name}' AS table_name, '{column}' AS column_name, (SELECT count(*) FROM {table}) AS rows_written, "
            f"(SELECT count(*) FROM {read}) AS rows_read, {nulls(table)} AS nulls_written, "
            f"{nulls(read)} AS nulls_read, '{status}' AS status WHERE {where}")


_EDGE = "(SELECT {} FROM orders WHERE o_orderkey = (SELECT {}(o_orderkey) FROM orders))"
_CONTENT_REPORT = """
WITH changed AS (SELECT * REPLACE (o_totalprice + CASE WHEN o_orderkey =
         (SELECT min(o_orderkey) FROM orders) THEN 1 ELSE 0 END AS o_totalprice) FROM orders),
doubled AS (SELECT * FROM orders WHERE o_orderkey <> (SELECT max(o_orderkey) FROM orders)
            UNION ALL SELECT * FROM orders WHERE o_orderkey = (SELECT min(o_orderkey) FROM orders))
""" + " UNION ALL ".join(
    [_content_row(t, t, c, t) for t, columns in _CONTENT_COLUMNS.items() for c in [*columns.split(), "*"]]
    + [_content_row("orders, a cell changed", "orders", c, "changed", "DIVERGENTE") for c in ("o_totalprice", "*")]
    + [_content_row("orders, two cells exchanged", "orders", "*", "orders", "DIVERGENTE",
                    f"{_EDGE.format('o_custkey', 'min')} IS DISTINCT FROM {_EDGE.format('o_custkey', 'max')}")]
    + [_content_row("orders, a row doubled", "orders", c, "doubled", "DIVERGENTE", "true" if c == "*" else
                    f"{_EDGE.format(c, 'min')} IS DISTINCT FROM {_EDGE.format(c, 'max')}")
       for c in [*_CONTENT_COLUMNS["orders"].split(), "*"]])

_STORED = {       # columns in order; the folders' column comes last
    "documents_labels": "doc_id source n_chars quality toxic lang",
    "documents": "doc_id text lang source n_chars",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": ("l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
                 "l_returnflag l_linestatus l_shipdate"),
    "embeddings": "vec_id embedding label"}
_STORED_NULLS = """
WITH documents_labels AS (SELECT * FROM documents LEFT JOIN labels USING (doc_id))
""" + " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, {i} AS position, '{c}' AS column_name, count(*) AS n_rows, "
    f"count(*) FILTER (WHERE {c} IS NULL) AS n_nulls, "
    f"count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*) AS pct_nulls FROM {t}"
    for t, cols in _STORED.items() for i, c in enumerate(cols.split(), start=1))

_FREQUENT = """
WITH w AS (SELECT * REPLACE (strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate)
           FROM orders LEFT JOIN customer ON o_custkey = c_custkey),
n AS (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS n_rows FROM w GROUP BY 2"
    for c in ("o_orderkey o_custkey o_orderstatus o_orderdate o_orderpriority "
              "c_custkey c_name c_nationkey c_mktsegment").split()) + """)
SELECT column_name, rank, value, n_rows FROM (
  SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY n_rows DESC, value ASC NULLS FIRST) AS rank FROM n)
WHERE rank <= 15"""

ORACLE_SQL: dict[str, str] = {
    "technology_adoption": f"""
WITH p AS {_DOC_PIECES},
c AS (SELECT lang, option, count(DISTINCT doc_id) AS n_docs FROM p
      WHERE option <> '' GROUP BY lang, option),
t AS (SELECT lang, count(DISTINCT doc_id) AS total FROM documents GROUP BY lang)
SELECT c.lang, c.option, c.n_docs, {_pct('c.n_docs', 't.total')} AS pct_docs
FROM c JOIN t USING (lang)""",

    "market_panorama": MARKET_PANORAMA,

    "order_flag_adoption": f"""
WITH o AS (SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders),
f AS (SELECT DISTINCT l_orderkey, 'Return flag' AS categoria, l_returnflag AS tecnologia
      FROM lineitem
      UNION
      SELECT DISTINCT l_orderkey, 'Line status', l_linestatus FROM lineitem),
c AS (SELECT o.year, f.categoria, f.tecnologia, count(DISTINCT o.o_orderkey) AS n_orders
      FROM o JOIN f ON f.l_orderkey = o.o_orderkey
      GROUP BY o.year, f.categoria, f.tecnologia),
t AS (SELECT year, count(DISTINCT o_orderkey) AS total FROM o GROUP BY year)
SELECT c.year, c.categoria, c.tecnologia, c.n_orders,
       {_pct('c.n_orders', 't.total')} AS pct_orders
FROM c JOIN t USING (year)""",
    "professional_profiles": PROFESSIONAL_PROFILES,
    "diversity_profile": DIVERSITY_PROFILE,
    "regional_profile": REGIONAL_PROFILE,
    "daily_event_reach": _DAILY_REACH,

    "part_type_adoption": """
SELECT p_type || ' (novo, usado).' AS option, count(DISTINCT l_orderkey) AS n_orders
FROM lineitem JOIN part ON l_partkey = p_partkey
GROUP BY 1""",

    "order_adoption_long": f"""
WITH b AS (SELECT oc.*, n_name FROM {_OC} oc JOIN nation ON c_nationkey = n_nationkey),
t AS (SELECT DISTINCT l_orderkey, p_type || ' (novo, usado).' AS valor
      FROM lineitem JOIN part ON l_partkey = p_partkey),
l AS (
  SELECT b.year, 'part_types' AS dimension, b.c_mktsegment, b.o_orderpriority, t.valor,
         b.o_orderkey
  FROM b JOIN t ON t.l_orderkey = b.o_orderkey
  UNION ALL
  SELECT year, 'order_status', c_mktsegment, o_orderpriority, o_orderstatus, o_orderkey FROM b
  UNION ALL
  SELECT year, 'customer_nation', c_mktsegment, o_orderpriority, n_name, o_orderkey FROM b)
SELECT year, dimension, c_mktsegment, o_orderpriority, valor,
       count(DISTINCT o_orderkey) AS n_orders
FROM l GROUP BY year, dimension, c_mktsegment, o_orderpriority, valor""",

    "document_maturity_long": f"""
WITH l AS (
  SELECT lang, 'source' AS dimension, source AS valor, doc_id FROM documents
  UNION ALL
  SELECT lang, 'text_option', option, doc_id FROM {_DOC_PIECES} p WHERE option <> '')
SELECT lang, dimension, valor, count(DISTINCT doc_id) AS n_docs
FROM l GROUP BY lang, dimension, valor""",

    "order_status_priority_long": """
WITH o AS (SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year,
                  o_orderstatus, o_orderpriority FROM orders),
l AS (SELECT year, 'status' AS dimension, o_orderstatus AS valor, o_orderkey FROM o
      UNION ALL
      SELECT year, 'priority', o_orderpriority, o_orderkey FROM o)
SELECT year, dimension, valor, count(DISTINCT o_orderkey) AS n_orders
FROM l GROUP BY year, dimension, valor""",

    "distinct_rollups": f"""
WITH l AS (
  SELECT oc.year, 'return_flag' AS dimension, c_mktsegment, o_orderpriority, l_returnflag AS valor, c_custkey
  FROM {_OC} oc JOIN lineitem ON l_orderkey = o_orderkey
  UNION ALL
  SELECT year, 'order_status', c_mktsegment, o_orderpriority, o_orderstatus, c_custkey FROM {_OC} oc
  UNION ALL
  SELECT year, 'priority', c_mktsegment, o_orderpriority, o_orderpriority, c_custkey FROM {_OC} oc
  UNION ALL
  SELECT year, 'everyone', c_mktsegment, o_orderpriority, '', c_custkey FROM {_OC} oc),
v AS (SELECT * FROM l WHERE valor IS NOT NULL),
c AS (SELECT year, dimension, valor, count(DISTINCT c_custkey) AS n FROM v
      WHERE dimension = 'return_flag' GROUP BY ALL),
t AS (SELECT year, count(DISTINCT c_custkey) AS total FROM {_OC} oc GROUP BY year)
SELECT 'technology' AS mart, c.year, dimension, CAST(NULL AS VARCHAR) AS c_mktsegment,
       CAST(NULL AS VARCHAR) AS o_orderpriority, valor, n AS n_customers, {_pct('n', 't.total')} AS pct_customers
FROM c JOIN t USING (year)
UNION ALL
SELECT 'adoption', year, dimension, c_mktsegment, o_orderpriority, valor, count(DISTINCT c_custkey), NULL
FROM v WHERE dimension = 'order_status' GROUP BY ALL
UNION ALL
SELECT 'maturity', year, dimension, c_mktsegment, NULL, valor, count(DISTINCT c_custkey), NULL
FROM v WHERE dimension = 'priority' GROUP BY ALL
UNION ALL
SELECT 'overall', NULL, dimension, NULL, NULL, valor, count(DISTINCT c_custkey), NULL
FROM v GROUP BY ALL""",

    "respondent_base": f"""
SELECT o_orderkey, year, o_orderstatus, o_orderpriority, c_custkey, c_mktsegment,
       n_name, r_name FROM {_OCG} s""",

    "edition_union": """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status,
       o_totalprice AS total, o_orderdate AS order_date, CAST(NULL AS VARCHAR) AS priority,
       CAST(NULL AS VARCHAR) AS clerk, CAST(NULL AS VARCHAR) AS comment, 1 AS edition
FROM orders WHERE year(o_orderdate) <= 1997
UNION ALL
SELECT o_orderkey, o_custkey, CAST(NULL AS VARCHAR), o_totalprice, o_orderdate,
       o_orderpriority, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), 2
FROM orders WHERE year(o_orderdate) > 1997 OR o_orderdate IS NULL""",

    "dictionary_check": """
WITH d(edition, field, "column") AS (VALUES
  ('early', 'order_id', 'o_orderkey'), ('early', 'customer_id', 'o_custkey'),
  ('early', 'status', 'o_orderstatus'), ('early', 'total', 'o_totalprice'),
  ('early', 'order_date', 'o_orderdate'), ('early', 'clerk', 'o_clerk'),
  ('late', 'order_id', 'o_orderkey'), ('late', 'customer_id', 'o_custkey'),
  ('late', 'total', 'o_totalprice'), ('late', 'order_date', 'o_orderdate'),
  ('late', 'priority', 'o_orderpriority'), ('late', 'comment', 'o_comment')),
e AS (SELECT CASE WHEN year(o_orderdate) <= 1997 THEN 'early' ELSE 'late' END AS edition,
             count(o_orderkey) AS o_orderkey, count(o_custkey) AS o_custkey,
             count(o_orderstatus) AS o_orderstatus, count(o_totalprice) AS o_totalprice,
             count(o_orderdate) AS o_orderdate, count(o_orderpriority) AS o_orderpriority
      FROM orders GROUP BY 1),
n AS (UNPIVOT e ON o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
      o_orderpriority INTO NAME "column" VALUE n_values)
SELECT d.edition, d.field, d."column", n.n_values IS NOT NULL AS present, n.n_values
FROM d LEFT JOIN n ON d.edition = n.edition AND d."column" = n."column" """,

    "boolean_recode_counts": """
WITH j AS (SELECT CAST(l.quality AS VARCHAR) AS q, CAST(l.toxic AS VARCHAR) AS t
           FROM documents d LEFT JOIN labels l USING (doc_id)),
r AS (SELECT CASE WHEN q IN ('1', 'TRUE') THEN 'Sim' WHEN q IN ('0', 'FALSE') THEN 'Não' END
               AS quality,
             CASE WHEN t IN ('1', 'TRUE') THEN 'Sim' WHEN t IN ('0', 'FALSE') THEN 'Não' END
               AS toxic
      FROM j)
SELECT quality, toxic, count(*) AS n_docs FROM r GROUP BY quality, toxic""",

    "value_recode_counts": """
SELECT o_orderstatus,
       CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '5-LOW' ELSE o_orderpriority END
         AS o_orderpriority,
       count(*) AS n_orders
FROM orders GROUP BY 1, 2""",

    "typed_parse": """
SELECT event_id,
       try_strptime(CASE WHEN event_type = 'error' THEN strftime(ts, '%Y-%m-%d')
                         ELSE strftime(ts, '%d/%m/%Y %H:%M:%S') END,
                    '%d/%m/%Y %H:%M:%S') AS sent_at,
       TRY_CAST(CASE WHEN event_type = 'error' THEN event_type
                     ELSE regexp_extract(props, ':\\s*(-?\\d+)', 1) END AS INTEGER) AS k_value
FROM events""",

    "null_profile_report": """
WITH j AS (SELECT * FROM documents d LEFT JOIN labels l USING (doc_id)),
c AS (SELECT count(*) AS n,
             count(*) FILTER (WHERE doc_id IS NULL) AS c1,
             count(*) FILTER (WHERE text IS NULL) AS c2,
             count(*) FILTER (WHERE lang IS NULL) AS c3,
             count(*) FILTER (WHERE source IS NULL) AS c4,
             count(*) FILTER (WHERE n_chars IS NULL) AS c5,
             count(*) FILTER (WHERE quality IS NULL) AS c6,
             count(*) FILTER (WHERE toxic IS NULL) AS c7 FROM j)
SELECT position, column_name, n_nulls, n_nulls * 100.0 / n AS pct_nulls FROM (
  SELECT 1 AS position, 'doc_id' AS column_name, c1 AS n_nulls, n FROM c UNION ALL
  SELECT 2, 'text', c2, n FROM c UNION ALL SELECT 3, 'lang', c3, n FROM c UNION ALL
  SELECT 4, 'source', c4, n FROM c UNION ALL SELECT 5, 'n_chars', c5, n FROM c UNION ALL
  SELECT 6, 'quality', c6, n FROM c UNION ALL SELECT 7, 'toxic', c7, n FROM c)""",

    "layer_table": """
WITH e AS (SELECT *, CASE WHEN year(o_orderdate) <= 1997 THEN 'early' ELSE 'late' END AS edition FROM orders)
SELECT 'early' AS registered, 5 AS columns_added, edition, count(*) AS n_rows, count(o_orderstatus) AS n_status,
       CAST(0 AS BIGINT) AS n_priority
FROM e WHERE edition = 'early' GROUP BY edition
UNION ALL
SELECT 'late', 1, edition, count(*), count(o_orderstatus) FILTER (WHERE edition = 'early'),
       count(o_orderpriority) FILTER (WHERE edition = 'late')
FROM e GROUP BY edition""",

    "published_marts": f"""
SELECT 'mart_profiles' AS mart, year, count(*) AS n_rows, sum(n_orders) AS n_orders
FROM ({PROFESSIONAL_PROFILES}) p GROUP BY year
UNION ALL
SELECT 'mart_panorama', year, count(*), sum(n_orders) FROM ({MARKET_PANORAMA}) m
WHERE year <= 1997 GROUP BY year""",

    "stored_null_report": _STORED_NULLS,

    "null_overall_report": """
WITH j AS (SELECT * FROM documents d LEFT JOIN labels l USING (doc_id))
SELECT count(*) AS n_rows, 7 AS n_columns,
       count(*) FILTER (WHERE quality IS NULL) + count(*) FILTER (WHERE toxic IS NULL)
       + count(*) FILTER (WHERE text IS NULL) + count(*) FILTER (WHERE lang IS NULL)
       + count(*) FILTER (WHERE source IS NULL) + count(*) FILTER (WHERE n_chars IS NULL)
       + count(*) FILTER (WHERE doc_id IS NULL) AS null_cells,
       (count(*) FILTER (WHERE quality IS NULL) + count(*) FILTER (WHERE toxic IS NULL)
       + count(*) FILTER (WHERE text IS NULL) + count(*) FILTER (WHERE lang IS NULL)
       + count(*) FILTER (WHERE source IS NULL) + count(*) FILTER (WHERE n_chars IS NULL)
       + count(*) FILTER (WHERE doc_id IS NULL)) * 100.0 / (count(*) * 7) AS pct_null_cells
FROM j""",

    "duplicate_line_keys": """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",

    "reconcile_tables": """
SELECT 'customer' AS table_name, count(*) AS rows_written, count(*) AS rows_read,
       5 AS columns_written, 5 AS columns_read, 'OK' AS status FROM customer
UNION ALL SELECT 'orders', count(*), count(*), 6, 6, 'OK' FROM orders
UNION ALL SELECT 'lineitem', count(*), count(*), 11, 11, 'OK' FROM lineitem""",

    "content_report": _CONTENT_REPORT,

    "duplicate_line_key_count": """
SELECT count(*) AS duplicated_keys FROM (
  SELECT l_orderkey, l_linenumber FROM lineitem
  GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) d""",

    "orders_per_year": """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n_orders FROM orders GROUP BY 1""",

    "unmapped_recode_values": """
SELECT 'o_orderstatus' AS column_name, o_orderstatus AS value, count(*) AS n_rows
FROM orders WHERE o_orderstatus NOT IN ('F', 'O') GROUP BY 2
UNION ALL
SELECT 'o_orderpriority', o_orderpriority, count(*)
FROM orders WHERE o_orderpriority NOT IN ('F', 'O') GROUP BY 2""",

    "frequent_values_report": _FREQUENT,

    "top_null_columns": _TOP_NULLS,

    "value_frequencies": """
SELECT 'event_type' AS column_name, event_type AS value, count(*) AS n_rows
FROM events GROUP BY 2
UNION ALL SELECT 'o_orderstatus', o_orderstatus, count(*) FROM orders GROUP BY 2
UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders GROUP BY 2""",

    "invalid_mart_rows": " UNION ALL ".join([
        _invalid("market_panorama", MARKET_PANORAMA),
        _invalid("professional_profiles", PROFESSIONAL_PROFILES),
        _invalid("diversity_profile", DIVERSITY_PROFILE),
        _invalid("regional_profile", REGIONAL_PROFILE)]),

    "text_slug": """
WITH s AS (SELECT doc_id,
                  trim(regexp_replace(strip_accents(replace(lower(text), 'ß', '')),
                                      '[^a-z0-9]+', '_', 'g'), '_') AS s
           FROM documents)
SELECT doc_id, CASE WHEN s = '' THEN 'col'
                    WHEN regexp_matches(s, '^[0-9]') THEN 'c_' || s ELSE s END AS slug
FROM s""",

    "column_map": """
SELECT position, coluna_bruta, coluna_saneada,
       (SELECT count(*) FROM customer) AS n_values
FROM (VALUES (1, 'Cliente ID', 'cliente_id'), (2, 'Nome do Cliente', 'nome_do_cliente'),
             (3, 'Nação (código)', 'nacao_codigo'), (4, 'Saldo R$', 'saldo_r'),
             (5, 'Segmento de Mercado', 'segmento_de_mercado'),
             (6, 'nome do cliente!', 'nome_do_cliente_1')) v(position, coluna_bruta, coluna_saneada)""",

    "lineage_columns": """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS _ano_pesquisa,
       'orders.parquet' AS _arquivo_origem, '2024-01-01T00:00:00+00:00' AS _data_ingestao
FROM orders""",

    "vocabulary_discovery": f"""
SELECT DISTINCT cell AS option, CAST(length(cell) AS INTEGER) AS length FROM {_TYPE_CELLS} c
WHERE cell <> '' AND NOT contains(cell, '., ')""",

    "top_sources": """
SELECT source AS value, count(*) AS n_rows FROM documents
GROUP BY source ORDER BY n_rows DESC, value ASC LIMIT 15""",

    "bronze_round_trip": """
SELECT CAST(year(o_orderdate) AS INTEGER) AS ano, count(*) AS rows_written,
       count(*) AS rows_read, 'OK' AS status
FROM orders GROUP BY 1""",

    "csv_round_trip": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "csv_split_round_trip": "SELECT doc_id, text, lang, source, n_chars FROM documents",

    "top_segment_sql": f"""
SELECT year, c_mktsegment, n_orders FROM (
  SELECT year, c_mktsegment, count(*) AS n_orders,
         row_number() OVER (PARTITION BY year ORDER BY count(*) DESC, c_mktsegment) AS rk
  FROM {_OC} s GROUP BY year, c_mktsegment) r
WHERE rk = 1""",

    "distinct_denominator": f"""
SELECT day, count(DISTINCT user_id) AS n_users FROM {_EVENTS} e GROUP BY day""",

    "purchase_reach": f"SELECT * FROM ({_DAILY_REACH}) r WHERE event_type = 'purchase'",

    "mart_file_round_trip": f"""
SELECT row_number() OVER (ORDER BY year, n_orders DESC, c_mktsegment, o_orderpriority) AS place,
       year, c_mktsegment, o_orderpriority, n_orders FROM ({PROFESSIONAL_PROFILES}) m""",

    "mart_parts_round_trip": f"""
SELECT row_number() OVER (ORDER BY year, c_mktsegment, n_orders DESC, o_orderpriority) AS place,
       year, c_mktsegment, o_orderpriority, n_orders FROM ({PROFESSIONAL_PROFILES}) m""",

    "edition_leaves": """
SELECT 'early' AS edition, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_priority, 6 AS n_columns
FROM orders WHERE year(o_orderdate) <= 1997
UNION ALL
SELECT 'late', count(*), count(o_orderpriority), 6
FROM orders WHERE year(o_orderdate) > 1997 OR o_orderdate IS NULL""",

    "missing_dictionary_fields": """
SELECT 'early' AS edition, 'clerk' AS field, 'o_clerk' AS "column", count(*) AS n_rows
FROM orders WHERE year(o_orderdate) <= 1997
UNION ALL
SELECT 'late', 'comment', 'o_comment', count(*)
FROM orders WHERE year(o_orderdate) > 1997 OR o_orderdate IS NULL""",

    "column_map_file": """
WITH e AS (SELECT CASE WHEN year(o_orderdate) <= 1997 THEN 'early' ELSE 'late' END AS edition,
                  count(*) AS n_rows FROM orders GROUP BY 1)
SELECT edition, coluna_bruta, coluna_saneada, n_rows
FROM e, (VALUES ('Pedido (nº)', 'pedido_no'), ('Prioridade!', 'prioridade')) v(coluna_bruta, coluna_saneada)""",

    "invalid_measure_rows": """
WITH l AS (SELECT count(*) FILTER (WHERE l_discount = 0) AS n FROM lineitem GROUP BY l_partkey),
o AS (SELECT count(*) FILTER (WHERE year(o_orderdate) > 1997) AS n FROM orders GROUP BY o_custkey)
SELECT 'full_price_lines' AS mart, count(*) FILTER (WHERE n <= 0) AS invalid_rows, count(*) AS mart_rows FROM l
UNION ALL SELECT 'late_orders', count(*) FILTER (WHERE n <= 0), count(*) FROM o""",

    "prefix_option_adoption": """
SELECT o_orderpriority || '.' AS option, count(DISTINCT o_orderkey) AS n_orders
FROM orders WHERE o_orderkey % 4 <> 1 GROUP BY 1
UNION ALL
SELECT o_orderpriority || '. more, ' || o_orderstatus || '.', count(DISTINCT o_orderkey)
FROM orders WHERE o_orderkey % 4 <> 0 GROUP BY 1""",
}
