"""What each query has to give, in SQL on the given tables."""


def _cells(source: str, key: str, cells: list[tuple]) -> str:
    """``(table, row, col, data[, attributes[, header[, row span[, col span]]]])``."""
    selects = []
    for table, row, col, data, *rest in cells:
        attributes, header, rows, cols = (*rest, *("''", 0, "1", "1")[len(rest):])
        selects.append(
            f"SELECT {key} || '_{table}' AS table_name, CAST({row} AS INTEGER) AS row, "
            f"CAST({col} AS INTEGER) AS col, {data} AS cell_data, {attributes} AS cell_attributes, "
            f"CAST({header} AS INTEGER) AS is_header, CAST({rows} AS BIGINT) AS row_span, "
            f"CAST({cols} AS BIGINT) AS col_span FROM {source}"
        )
    return "\nUNION ALL\n".join(selects)


def _escaped(expression: str) -> str:
    """XML text form in ASCII."""
    entities = f"replace(replace(replace({expression}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
    return (
        f"array_to_string(list_transform(string_split({entities}, ''), "
        "lambda c: CASE WHEN unicode(c) > 127 THEN '&#' || unicode(c) || ';' ELSE c END), '')"
    )


def _without_blank_lines(expression: str) -> str:
    return f"rtrim(regexp_replace({expression}, chr(10) || '+', chr(10), 'g'), chr(10))"


def _document_lines(show) -> str:
    """A row per line; what stands before the first pipe of a line is the attribute of its cell."""
    return f"""
WITH split AS (
  SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents
), numbered AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) - 1 AS i FROM split
), cut AS (
  SELECT doc_id, i, substr(line, instr(line, '|') + 1) AS line, left(line, greatest(instr(line, '|') - 1, 0)) AS attribute FROM numbered
)
SELECT 'Doc ' || doc_id || '_0' AS table_name, CAST(i AS INTEGER) AS row, CAST(0 AS INTEGER) AS col,
       {show("line")} AS cell_data, {show("attribute")} AS cell_attributes, CAST(0 AS INTEGER) AS is_header,
       CAST(1 AS BIGINT) AS row_span, CAST(1 AS BIGINT) AS col_span
FROM cut"""


_ORDER = "'Order ' || o_orderkey"
_PART = "'Part ' || p_partkey"
_NL = "chr(10)"

_CUSTOMER_CELLS = _cells("customer", "c_name", [
    (0, 0, 0, "c_mktsegment || ' &amp; &lt;i&gt; '"),
    (0, 0, 1, "' &#233; ' || c_nationkey"),
])
_CUSTOMER_TEXT = (
    "chr(10) || 'A & <b>' || chr(10) || '{|' || chr(10) || '| ' || c_mktsegment || "
    "' & <i> || ' || chr(233) || ' ' || c_nationkey || chr(10) || '|}'"
)
_ORDER_CELLS = [
    (0, 0, 0, "'status '"), (0, 0, 1, "' ' || o_orderstatus"),
    (0, 1, 0, "'priority '"), (0, 1, 1, "' ' || o_orderpriority"),
    (0, 2, 0, "'customer'"), (0, 2, 1, "CAST(o_custkey AS VARCHAR)"),
]

ORACLES = {
    "cells_basic": _cells("orders", _ORDER, _ORDER_CELLS),
    "cells_headers": _cells("part", _PART, [
        (0, 0, 0, "' key '", "''", 1), (0, 0, 1, "' ' || p_type", "''", 1),
        (0, 0, 2, "'brand '", "''", 1), (0, 0, 3, "' plain '"), (0, 0, 4, "' more'"),
        (0, 1, 0, "' ' || p_partkey", "''", 1), (0, 1, 1, "p_name || ' !! ' || p_brand"),
    ]),
    "cells_attributes": _cells("part", _PART, [
        (0, 0, 0, "'plain'"),
        (0, 0, 1, "' ' || p_name || ' '", "' class=' || p_brand || ' w=' || p_size || ' '"),
        (0, 0, 2, "' v=1 | ' || p_type"),
        (0, 1, 0, "'x'", "'w=' || p_size"),
        (0, 1, 1, "'y|z'"),
        (0, 1, 2, "' [[' || p_name || ']] '", "' h=1 '", 1),
        (0, 1, 3, "' t=2 | ' || p_type", "''", 1),
    ]),
    "spans": _cells("part", _PART, [
        (0, 0, 0, "' ' || p_name", "'rowspan=\"' || p_size || '\" '", 0, "p_size"),
        (0, 0, 1, "' ' || p_brand", "'colspan = ' || p_size || ' rowspan=2 '", 0, "2", "p_size"),
        (0, 0, 2, "' crossing'", "'rowspan=\"\" colspan=' || p_size || ' '", 0, "p_size", "p_size"),
        (0, 0, 3, "' none'", "'norowspan=9 Rowspan=8 '"),
    ]),
    "captions_info": """
SELECT c_name AS page_name, c_name || '_0' AS table_name, ' class=c' || c_nationkey AS table_attributes,
       ' Segment ' || c_mktsegment || '  of ' || c_name AS caption,
       ' r=1  k=' || c_nationkey || ' ' AS caption_attributes FROM customer
UNION ALL
SELECT c_name, c_name || '_1', '', '', '' FROM customer""",
    "captions_cells": _cells("customer", "c_name", [
        (0, 0, 0, "'a'"), (1, 0, 0, "'b'"), (1, 0, 1, "' last ' || c_custkey"),
    ]),
    "protected_links": _cells("customer", "c_name", [
        (0, 0, 0, "'[[' || c_name || '|' || c_mktsegment || ']] '", "' r=' || c_custkey"),
        (0, 0, 1, "' {{t|' || c_mktsegment || '||' || c_name || '}}'", "' r=' || c_custkey"),
        (0, 0, 2, f"'{{{{a|[[' || c_name || '|x]]|{{{{b|' || {_NL} || '|c}}}}}}}} '", "' r=' || c_custkey"),
        (0, 0, 3, "' d'"),
        (0, 0, 4, "' after argument'", "' r=' || c_custkey || ' {{{1|' || c_mktsegment || '}}} '"),
        (0, 0, 5, "' lone'", "' r=' || c_custkey || ' [http://e ' || c_name || '] '"),
        (0, 0, 6, "c_mktsegment", "' r=' || c_custkey || ' [[ {{ ]]'"),
        (0, 0, 7, "'{{{{{1|p}}}|' || c_name || '}}'", "' r=' || c_custkey"),
    ]),
    "raw_tables": f"""
SELECT o_orderkey AS page_id, {_ORDER} AS page_name, CAST(0 AS INTEGER) AS table_idx,
       '{{|' || {_NL} || '| ' || o_orderkey || {_NL} || '|}}' AS raw FROM orders
UNION ALL
SELECT o_orderkey, {_ORDER}, CAST(1 AS INTEGER), '{{| one line ' || o_orderstatus || ' |}}' FROM orders""",
    "multi_table_pages": _cells("orders", _ORDER, [
        (0, 0, 0, "CAST(o_orderkey AS VARCHAR)"), (1, 0, 0, "''"),
    ]),
    "nested_tables": _cells("orders", _ORDER, [
        (0, 0, 0, "' inner'", f"'a' || {_NL} || '{{'"),
        (0, 1, 0, "o_orderstatus"), (0, 1, 1, "'}'"), (0, 1, 2, "CAST(o_orderkey AS VARCHAR)"),
        (1, 0, 0, "'next ' || o_orderkey"),
    ]),
    "continuation_lines": _cells("conversations", "'Talk ' || conv_id || '.' || turn", [
        (0, 0, 0, _escaped(_without_blank_lines(f"role || {_NL} || text"))),
    ]),
    "phantom_rows": _cells("customer", "c_name", [
        (0, 0, 0, "'a'"), (0, 1, 0, "' s=' || c_custkey"),
        (1, 0, 0, "''"),
        (2, 0, 0, "' [[' || c_mktsegment || ']]'",
         f"{_NL} || 'lead ' || c_mktsegment || ' t=' || c_custkey || ' ' || {_NL} || 'more k=1 '", 1),
        (3, 0, 0, "'| ' || c_custkey"), (3, 0, 1, "''"), (3, 0, 2, f"{_NL} || c_mktsegment"),
    ]),
    "lost_breaks": _cells("customer", "c_name", [
        (0, 0, 0, "'[[' || c_mktsegment || ']]'", "'k=' || c_custkey || ' '"),
        (0, 0, 1, f"{_NL} || c_mktsegment", "'k=' || c_custkey || ' '"),
        (0, 0, 2, "'{{{' || c_custkey || '}}} |{{' || c_mktsegment || '}}'", "'a '"),
    ]),
    "cut_tables": _cells(
        "lineitem", "'Item ' || l_orderkey || '.' || l_linenumber || '.' || l_partkey || '.' || l_suppkey", [
            (3, 0, 0, "' order '", "''", 1), (3, 0, 1, "' line'"),
            (3, 1, 0, "l_orderkey || ' '"), (3, 1, 1, "' ' || l_linenumber"),
            (3, 1, 2, "' ' || l_returnflag", "'rowspan=' || l_linenumber || ' '", 0, "l_linenumber"),
        ]),
    "document_lines": _document_lines(str),
    "xml_escaped_cells": _document_lines(_escaped),
    "html_cells": _cells("pages", "'Html ' || page_id", [
        (0, 0, 0, "'{{html|' || " + _escaped(_without_blank_lines("html")) + " || '}}'"),
        (0, 0, 1, _escaped("url")),
    ]),
    "literal_text": _cells("events", "'Event ' || event_id", [
        (0, 0, 0, "'<nowiki>' || props || ' || [[</nowiki>'"),
        (0, 0, 1, f"' <!-- a' || {_NL} || '| b || ' || event_type || ' --> c '", "'k '"),
        (0, 0, 2, "' <pre>d|' || user_id || '</pre>'"),
    ]),
    "dump_pages": f"SELECT c_custkey AS page_id, c_name AS page_name, {_CUSTOMER_TEXT} AS text FROM customer",
    "dump_cells": f"""
SELECT CASE WHEN CAST(string_split(table_name, '#')[2][:9] AS INTEGER) % 2 = 0 THEN 'enwiki' ELSE 'dewiki' END
       || '-20201220-pages-articles-multistream' AS dump_id, * FROM ({_CUSTOMER_CELLS})""",
    "mixed_load": _CUSTOMER_CELLS,
    "rejected_rows": """
SELECT 'rejected' AS kind, CAST(c_custkey AS VARCHAR) AS name FROM customer WHERE c_custkey % 5 = 0 OR c_custkey % 7 = 0
UNION ALL
SELECT 'cell', c_name || '_0' FROM customer, range(2) WHERE c_custkey % 5 <> 0 AND c_custkey % 7 <> 0""",
    "table_pages": f"""
SELECT o_orderkey AS page_id, {_ORDER} AS page_name, CAST(0 AS INTEGER) AS table_idx,
       '{{|' || {_NL} || '| ' || o_orderkey || {_NL} || '|}}' AS raw FROM orders WHERE o_orderkey % 3 = 0""",
    "check_records": f"""
WITH items AS (
  SELECT *, 'Item ' || l_orderkey || '.' || l_linenumber || '.' || l_partkey || '.' || l_suppkey || '_3' AS name FROM lineitem
), found AS (
  SELECT 'information' AS kind, name AS table_name, unnest(['', '?']) AS value, unnest([1, 0]) AS actual, unnest([0, 1]) AS expected
  FROM items WHERE l_orderkey % 7 = 0
  UNION ALL
  SELECT 'data', name, ' ' || l_returnflag, 1, 0 FROM items WHERE l_orderkey % 11 = 0
)
SELECT kind, table_name, value, CAST(count(*) * actual AS BIGINT) AS actual_copies, CAST(count(*) * expected AS BIGINT) AS expected_copies
FROM found GROUP BY kind, table_name, value, actual, expected""",
    "lines_before_entry": _cells("documents", "'Doc ' || doc_id", [
        (0, 0, 0, _escaped(_without_blank_lines(f"{_NL} || '{{{{lead' || {_NL} || text || {_NL} || '}}}}'")) + " || doc_id"),
    ]),
    # A closer that meets an open run of the other kind is discarded; a template that is not closed protects nothing.
    "unbalanced_links": _cells("customer", "c_name", [
        (0, 0, 0, "' ' || c_mktsegment", "'[[ {{ ' || c_custkey || ' ]] '"),
        (1, 0, 0, "'{{t ]] | ' || c_mktsegment || ' }} | x'"),
        (2, 0, 0, "'{{ [[ ' || c_name || ' | b ]]]] | c }} | d'"),
        (3, 0, 0, "'[[' || c_name || '|b]' || chr(10) || '] | c'"),
        (4, 0, 0, "']] }} [[' || c_custkey || '|a]] '"),
        (4, 0, 1, "' }}} {{{1|' || c_mktsegment || '}}} | z'"),
    ]),
    "hidden_rows": _cells("documents", "'Doc ' || doc_id", [
        # Text before the first row mark goes in front of that mark's attribute, which is the last one of a single line.
        (0, 0, 0, "chr(10) || '}}[[' || doc_id || ']]'", "CASE WHEN contains(text, chr(10)) THEN '' ELSE chr(10) || '{{rows' END || "
            + _escaped("string_split(text, chr(10))[-1]")),
    ]),
    "dump_appended": "SELECT c_name || '_0' AS table_name, CAST(2 AS BIGINT) AS copies FROM customer",
    "load_once": f"""
SELECT table_name, col, cell_data FROM ({_CUSTOMER_CELLS})
UNION ALL
SELECT DISTINCT 'fixture-20201220-pages-articles-multistream1.xml-p' || c_custkey // 50 * 50 || 'p' || (c_custkey // 50 * 50 + 49) || '.bz2', CAST(-1 AS INTEGER), 'loaded'
FROM customer""",
    "damaged_streams": f"""
SELECT 'cell' AS kind, table_name AS name FROM ({_CUSTOMER_CELLS})
WHERE table_name NOT IN (SELECT c_name || '_0' FROM customer WHERE c_custkey BETWEEN 20 AND 39)
UNION ALL SELECT 'damaged', 'fixture-20201220-pages-articles-multistream1.xml-p0p999.bz2'""",
    "multistream_cells": _CUSTOMER_CELLS,
    "incremental_load": _CUSTOMER_CELLS,
    "dump_index_streams": """
WITH placed AS (
  SELECT c_custkey, c_custkey // 500 AS file, (row_number() OVER (PARTITION BY c_custkey // 500 ORDER BY c_custkey) - 1) // 40 + 1 AS stream
  FROM customer
)
SELECT 'fixture-20201220-pages-articles-multistream' AS dump_id, 'p' || file * 500 || 'p' || file * 500 + 499 || '.bz2' AS file, stream,
       count(*) AS pages, min(c_custkey) AS first_page_id, max(c_custkey) AS last_page_id, CAST(0 AS BIGINT) AS gap
FROM placed GROUP BY file, stream""",
    "file_pairs": """
WITH named AS (
  SELECT *, 'enwiki-' || (20000000 + c_custkey) || '-pages-articles-multistream' AS dump,
         'p' || c_custkey * 100 || 'p' || c_custkey * 100 + 99 || '.bz2' AS range_key FROM customer
)
SELECT dump AS dump_id, range_key, 'hdfs:/dumps/' || dump || '.xml-' || range_key AS data_path,
       c_custkey * 1000 AS data_length, 'hdfs:/dumps/' || dump || '-index.txt-' || range_key AS index_path
FROM named WHERE c_custkey % 7 <> 0""",
    "database_name": """
WITH names AS (
  SELECT 'enwiki-' || (20000000 + c_custkey) || '-pages' AS name FROM customer
), ends AS (
  SELECT min(name) AS a, max(name) AS b FROM names
)
SELECT left(a, CAST(max(n) AS BIGINT)) AS database FROM ends, range(0, 15) r(n) WHERE left(a, n) = left(b, n) GROUP BY a""",
    "selected_streams": f"""
WITH placed AS (
  SELECT *, c_custkey // 20 AS s FROM customer
)
SELECT c_custkey AS page_id, c_name AS page_name, {_CUSTOMER_TEXT} AS text
FROM placed WHERE s IN (SELECT s FROM placed WHERE c_acctbal > 9900)""",
    "indexed_streams": f"""
WITH pages AS (
  SELECT 'enwiki-20201220-pages-articles-multistream' AS dump_id, c_custkey AS page_id, * FROM customer
  UNION ALL SELECT 'dewiki-20201220-pages-articles-multistream', c_custkey * 7, * FROM customer
), placed AS (
  SELECT *, page_id // 7000 AS f, (row_number() OVER (PARTITION BY dump_id, page_id // 7000 ORDER BY page_id) - 1) // 20 AS s FROM pages
)
SELECT dump_id, page_id, c_name AS page_name, {_CUSTOMER_TEXT} AS text
FROM placed WHERE (dump_id, f, s) IN (SELECT (dump_id, f, s) FROM placed WHERE c_acctbal < -950)""",
    "compare_tables": f"""
WITH actual AS (
  {_cells("orders", _ORDER, _ORDER_CELLS)}
), cells AS (
  {_cells("orders", _ORDER, _ORDER_CELLS)}
), expected AS (
  SELECT c.* REPLACE (CASE WHEN row = 0 AND col = 1 AND k % 5 = 0 THEN ' ?' ELSE cell_data END AS cell_data)
  FROM (SELECT *, CAST(table_name[7:-3] AS BIGINT) AS k FROM cells) c, range(2) r(n)
  WHERE (n = 0 OR k % 11 = 0) AND NOT (k % 7 = 0 AND row = 2 AND col = 1)
), counted AS (
  SELECT *, 1 AS a, 0 AS e FROM actual UNION ALL SELECT * EXCLUDE (k), 0, 1 FROM expected
)
SELECT table_name, row, col, cell_data, cell_attributes, is_header, row_span, col_span,
       CAST(sum(a) AS BIGINT) AS actual_copies, CAST(sum(e) AS BIGINT) AS expected_copies
FROM counted GROUP BY ALL HAVING sum(a) <> sum(e)""",
    "info_data_join": f"""
SELECT {_PART} AS page_name, {_PART} || '_0' AS table_name, CAST(7 AS BIGINT) AS cells,
       CAST(4 AS BIGINT) AS headers FROM part""",
}
