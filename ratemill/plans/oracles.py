"""The same results as plain SQL over the same tables."""

from __future__ import annotations

from ratemill.plans.inputs import EVENT_CUT, SHIP_CUT

SHIP_ORDER = "l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag"
LINE_COLUMNS = (
    "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag"
)

STUMPAGE_NAMES = (
    "'TYPE','RATE_ID','PRODUCT_TYPE_CODE','PRODUCT_TYPE_NAME','SPECIES_GROUP_CODE',"
    "'SPECIES_GROUP_NAME','RATE_TYPE_CODE','RATE_TYPE_NAME','RATE','EFFECTIVE_DATE','EXPIRY_DATE'"
)

FEED_CASE = """CASE c_custkey % 6 WHEN 0 THEN 'renewal' WHEN 1 THEN 'stumpage' WHEN 2 THEN 'factor'
    WHEN 5 THEN 'stumpage' END"""

# events.value as text in eight shapes, and what each is worth.
RAW = """CASE event_id % 8
    WHEN 0 THEN CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR)
    WHEN 1 THEN ' ' || CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) || ' '
    WHEN 2 THEN '+' || CAST(CAST(floor(value) AS BIGINT) AS VARCHAR)
    WHEN 3 THEN format('{:,.2f}', value * 1000)
    WHEN 4 THEN CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) || 'e3'
    WHEN 5 THEN CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) || 'd'
    WHEN 6 THEN '' END"""
AS_INT = "CASE WHEN event_id % 8 IN (1, 2) THEN CAST(floor(value) AS INTEGER) END"
THOUSAND = "CAST(CAST(value AS DECIMAL(18,2)) * 1000 AS DOUBLE)"
AS_DECIMAL = f"""CASE WHEN event_id % 8 = 0 THEN value WHEN event_id % 8 IN (1, 2) THEN floor(value)
    WHEN event_id % 8 = 3 THEN {THOUSAND} END"""

STUMPAGE_ROWS = """
    p_type AS "TYPE", CAST(p_partkey AS INTEGER) AS "RATE_ID", p_brand AS "PRODUCT_TYPE_CODE",
    p_name AS "PRODUCT_TYPE_NAME", CAST(p_size AS VARCHAR) AS "SPECIES_GROUP_CODE",
    'size, ' || CAST(p_size AS VARCHAR) AS "SPECIES_GROUP_NAME",
    substr(p_type, 1, 1) AS "RATE_TYPE_CODE", lower(p_type) AS "RATE_TYPE_NAME",
    CAST(CAST(p_retailprice * 10 AS DECIMAL(18,2)) AS DOUBLE) AS "RATE",
    CAST(DATE '2026-04-01' + p_size AS DATE) AS "EFFECTIVE_DATE",
    CAST(DATE '2026-04-01' + p_size + 365 AS DATE) AS "EXPIRY_DATE" """

FACTOR_ORDER = "l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_tax"
FACTOR_ROWS = """
    l_returnflag AS "TYPE", CAST(l_orderkey AS INTEGER) AS "FACTOR_ID", '' AS "APPROVAL_NUMBER",
    '' AS "SCALING_METHOD_CODE", l_returnflag AS "TALLY_DESTINATION_CODE",
    '' AS "TALLY_SPECIES_CODE", '' AS "TALLY_GRADE", '' AS "CONTAINER_CODE", '' AS "CHARGE_TYPE",
    '' AS "LICENCE_NUMBER", '' AS "ACCOUNT_CODE", '' AS "MANAGEMENT_UNIT",
    l_extendedprice AS "REDUCTION_RATE", CAST(l_shipdate AS DATE) AS "EFFECTIVE_DATE",
    CAST(CAST(l_shipdate AS DATE) + 30 AS DATE) AS "EXPIRY_DATE",
    l_linestatus AS "DESTINATION_CODE", '' AS "PRODUCT_TYPE", '' AS "DESTINATION_TYPE",
    '' AS "TAX_CODE", l_tax AS "TAX_RATE", CAST(l_linenumber AS VARCHAR) AS "SPECIES_CODE",
    '' AS "SPECIES_GROUP", 'G' || CAST(l_partkey AS VARCHAR) AS "GRADE",
    CAST(0 AS DOUBLE) AS "DESTINATION_SHARE", CAST(0 AS DOUBLE) AS "SPECIES_SHARE",
    CAST(0 AS DOUBLE) AS "GRADE_SHARE", CAST(CAST(l_quantity AS INTEGER) AS DOUBLE) AS "MASS_VOLUME_RATIO",
    CAST(0 AS DOUBLE) AS "TREE_LENGTH_TABLE", CAST(0 AS DOUBLE) AS "CONTAINER_VOLUME",
    CAST(0 AS DOUBLE) AS "UNDERSIZE_DEDUCTION", CAST(0 AS DOUBLE) AS "CULL_DEDUCTION" """


def _upsert_lines(flag_on_match: str, flag_on_insert: str) -> str:
    return f"""
    WITH t AS (
        SELECT {LINE_COLUMNS}, row_number() OVER (ORDER BY l_orderkey, l_linenumber, {SHIP_ORDER}) AS id
        FROM lineitem WHERE l_shipdate < TIMESTAMP '{SHIP_CUT}'),
    b AS (
        SELECT *, row_number() OVER (ORDER BY {SHIP_ORDER}) AS n,
            row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {SHIP_ORDER}) AS up,
            count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS cnt
        FROM lineitem WHERE l_shipdate >= TIMESTAMP '{SHIP_CUT}'),
    c AS (
        SELECT z.l_orderkey, z.l_linenumber, z.l_partkey, z.l_suppkey, z.l_quantity,
            z.l_extendedprice, z.l_returnflag AS last_flag, a.l_returnflag AS first_flag, a.n
        FROM b z JOIN b a ON a.l_orderkey = z.l_orderkey AND a.l_linenumber = z.l_linenumber
        WHERE z.up = z.cnt AND a.up = 1)
    SELECT t.l_orderkey, t.l_linenumber, coalesce(c.l_partkey, t.l_partkey) AS l_partkey,
        coalesce(c.l_suppkey, t.l_suppkey) AS l_suppkey,
        coalesce(c.l_quantity, t.l_quantity) AS l_quantity,
        coalesce(c.l_extendedprice, t.l_extendedprice) AS l_extendedprice,
        {flag_on_match} AS l_returnflag, CAST(t.id AS BIGINT) AS "ID"
    FROM t LEFT JOIN c ON c.l_orderkey = t.l_orderkey AND c.l_linenumber = t.l_linenumber
    UNION ALL
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
        {flag_on_insert} AS l_returnflag,
        CAST((SELECT max(id) FROM t) + row_number() OVER (ORDER BY n) AS BIGINT) AS "ID"
    FROM c WHERE NOT EXISTS (
        SELECT 1 FROM t WHERE t.l_orderkey = c.l_orderkey AND t.l_linenumber = c.l_linenumber)
    """


LEVELS = f"""
    e AS (SELECT event_id, user_id, event_type, CAST(floor(value / 10) AS BIGINT) AS level,
            ts < TIMESTAMP '{EVENT_CUT}' AS old FROM events),
    t AS (SELECT user_id, event_type, level,
            row_number() OVER (ORDER BY user_id, event_type) AS id
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS r
            FROM e WHERE old) WHERE r = 1),
    b AS (SELECT * FROM e WHERE NOT old)"""

ACTIONS = f"""
    WITH {LEVELS},
    p AS (
        SELECT b.event_id, b.event_type, b.level, t.level AS stored, t.user_id IS NOT NULL AS known,
            lag(b.level) OVER w AS prior, row_number() OVER w AS r
        FROM b LEFT JOIN t ON t.user_id = b.user_id AND t.event_type = b.event_type
        WINDOW w AS (PARTITION BY b.user_id, b.event_type ORDER BY b.event_id)),
    a AS (
        SELECT event_id, event_type, CASE
            WHEN r = 1 AND NOT known THEN 'INSERT'
            WHEN level IS DISTINCT FROM (CASE WHEN r = 1 THEN stored ELSE prior END) THEN 'UPDATE'
            ELSE 'UNCHANGED' END AS action
        FROM p)"""

ORACLES = {
    "csv_parse": """
        SELECT p_partkey, p_name, p_brand, p_type,
            CASE WHEN p_partkey % 14 <> 0 THEN p_size END AS p_size,
            CASE WHEN p_partkey % 14 <> 0
                THEN CAST(CAST(p_retailprice * 10 AS DECIMAL(18,2)) AS DOUBLE) END AS price
        FROM part""",
    "csv_quote_split": """
        WITH l AS (
            SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) - 1 AS line_no
            FROM (SELECT doc_id, regexp_split_to_array(text, '\\r\\n|\\r|\\n') AS lines FROM documents)),
        p AS (
            SELECT doc_id, line_no, string_split(line, '"') AS pieces FROM l
            WHERE regexp_matches(line, '[^\\s\\p{Z}\\x{85}\\x{0B}]')),
        f AS (
            SELECT doc_id, line_no, string_split(array_to_string(list_transform(pieces,
                lambda s, i: CASE WHEN (len(pieces) - i) % 2 = 0 THEN replace(s, ',', chr(10)) ELSE s END),
                '"'), chr(10)) AS fields
            FROM p)
        SELECT doc_id, CAST(line_no AS BIGINT) AS line_no,
            CAST(generate_subscripts(fields, 1) - 1 AS BIGINT) AS field_no,
            trim(unnest(fields), ' "') AS field
        FROM f""",
    "line_order": """
        SELECT o_orderkey, CAST(row_number() OVER (ORDER BY o_orderkey) AS BIGINT) AS line_no
        FROM orders""",
    "header_names": """
        SELECT c_custkey, CAST(generate_subscripts(names, 1) - 1 AS BIGINT) AS pos, unnest(names) AS name
        FROM (SELECT c_custkey, [c_mktsegment, 'Column_2', lower(c_mktsegment) || '_2',
            c_mktsegment || '_3', c_name, 'Column_6'] AS names FROM customer)""",
    "file_counts": """
        SELECT o_orderkey AS file_id, CAST(greatest(coalesce(n, 0) - 1, 0) AS BIGINT) AS row_count,
            CASE WHEN n IS NULL THEN 'empty' WHEN n = 1 THEN 'header_only' ELSE 'ok' END AS status
        FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1)
            ON l_orderkey = o_orderkey""",
    "preview_top": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
            CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority
        FROM orders ORDER BY o_orderkey LIMIT 1000""",
    "classify_feed": f"SELECT c_custkey, {FEED_CASE} AS feed FROM customer",
    "route_counts": f"""
        SELECT feed, count(*) AS n FROM (SELECT {FEED_CASE} AS feed FROM customer)
        WHERE feed IS NOT NULL GROUP BY feed""",
    "header_alignment": f"""
        WITH wanted AS (
            SELECT unnest([{STUMPAGE_NAMES}]) AS column_name,
                generate_subscripts([{STUMPAGE_NAMES}], 1) - 1 AS pos)
        SELECT c_custkey, column_name,
            CASE WHEN pos = c_nationkey % 11 THEN 'missing' ELSE 'matched' END AS status
        FROM customer JOIN wanted ON true
        UNION ALL SELECT c_custkey, c_mktsegment, 'extra' FROM customer""",
    "feed_dates": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 18 < 13 THEN CAST(o_orderdate AS DATE) END AS day
        FROM orders""",
    "safe_convert": f"""
        SELECT event_id, coalesce({RAW}, '') AS as_text, coalesce({AS_INT}, 0) AS as_int,
            CASE WHEN event_id % 8 = 4 THEN {THOUSAND} ELSE coalesce({AS_DECIMAL}, 0) END AS as_double
        FROM events""",
    "strict_values": f"""
        SELECT event_id, {AS_INT} AS as_int, {AS_DECIMAL} AS as_decimal FROM events""",
    "strict_convert": f"""
        SELECT event_id, 'as_int' AS column_name, 'conversion' AS reason, {RAW} AS raw_value
        FROM events WHERE event_id % 8 NOT IN (1, 2)
        UNION ALL
        SELECT event_id, 'as_decimal', 'conversion', {RAW} FROM events WHERE event_id % 8 > 3""",
    "normalize_code": """
        SELECT c_custkey, CASE WHEN c_custkey % 4 < 3 THEN CAST(c_custkey AS VARCHAR) END AS code
        FROM customer""",
    "defaults_fill": """
        SELECT '' AS "TYPE", CAST(c_custkey AS INTEGER) AS "RATE_ID",
            c_mktsegment AS "PRODUCT_TYPE_CODE", '' AS "PRODUCT_TYPE_NAME",
            '' AS "SPECIES_GROUP_CODE", '' AS "SPECIES_GROUP_NAME", '' AS "RATE_TYPE_CODE",
            nullif(c_mktsegment, 'HOUSEHOLD') AS "RATE_TYPE_NAME", CAST(0 AS DOUBLE) AS "RATE",
            DATE '1900-01-01' AS "EFFECTIVE_DATE", DATE '1900-01-01' AS "EXPIRY_DATE"
        FROM customer""",
    "feed_projection_stumpage": f"SELECT {STUMPAGE_ROWS} FROM part",
    "feed_projection_renewal": """
        SELECT 'R' AS "TYPE", CAST(s_suppkey AS INTEGER) AS "RATE_ID",
            CAST(s_nationkey AS VARCHAR) AS "MANAGEMENT_UNIT_CODE", s_name AS "MANAGEMENT_UNIT_NAME",
            CAST(s_nationkey AS VARCHAR) AS "SPECIES_GROUP_CODE", upper(s_name) AS "SPECIES_GROUP_NAME",
            'A' AS "RATE_TYPE_CODE", 'all' AS "RATE_TYPE_NAME", s_acctbal AS "RATE",
            CAST(DATE '2026-04-01' + s_nationkey AS DATE) AS "EFFECTIVE_DATE",
            CAST(DATE '2026-04-01' + s_nationkey AS DATE) AS "EXPIRY_DATE"
        FROM supplier""",
    "feed_projection_factor": f"SELECT {FACTOR_ROWS} FROM lineitem",
    "changed_rows": """
        WITH b AS (
            SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 1
                ELSE o_totalprice END AS o_totalprice, nullif(o_orderstatus, 'P') AS o_orderstatus
            FROM orders)
        SELECT b.* FROM b JOIN orders o ON o.o_orderkey = b.o_orderkey
        WHERE b.o_totalprice IS DISTINCT FROM o.o_totalprice
            OR b.o_orderstatus IS DISTINCT FROM o.o_orderstatus""",
    "new_rows": """
        SELECT o_orderkey AS l_orderkey, o_custkey FROM orders
        WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""",
    "untouched_rows": """
        SELECT doc_id, source, lang, text FROM documents d
        WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
    "upsert_always": _upsert_lines("coalesce(c.last_flag, t.l_returnflag)", "last_flag"),
    "upsert_insert_only": _upsert_lines("t.l_returnflag", "first_flag"),
    "upsert_changed": f"""
        WITH {LEVELS},
        c AS (
            SELECT user_id, event_type, arg_max(level, event_id) AS level, min(event_id) AS n
            FROM b GROUP BY user_id, event_type)
        SELECT t.user_id, t.event_type, coalesce(c.level, t.level) AS level, CAST(t.id AS BIGINT) AS "ID"
        FROM t LEFT JOIN c ON c.user_id = t.user_id AND c.event_type = t.event_type
        UNION ALL
        SELECT user_id, event_type, level,
            CAST((SELECT max(id) FROM t) + row_number() OVER (ORDER BY n) AS BIGINT)
        FROM c WHERE NOT EXISTS (
            SELECT 1 FROM t WHERE t.user_id = c.user_id AND t.event_type = c.event_type)""",
    "merge_actions": f"{ACTIONS} SELECT event_id, action FROM a",
    "import_counts": f"""{ACTIONS}
        SELECT event_type, count(*) AS row_count,
            CAST(sum(CASE WHEN action = 'INSERT' THEN 1 ELSE 0 END) AS BIGINT) AS inserted,
            CAST(sum(CASE WHEN action = 'UPDATE' THEN 1 ELSE 0 END) AS BIGINT) AS updated,
            CAST(sum(CASE WHEN action <> 'UNCHANGED' THEN 1 ELSE 0 END) AS BIGINT) AS processed
        FROM a GROUP BY event_type""",
    "collapse_batch": f"""
        SELECT {LINE_COLUMNS} FROM (
            SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
                    l_extendedprice DESC, l_returnflag DESC) AS r
            FROM lineitem) WHERE r = 1""",
    "upsert_multi_match": """
        WITH t AS (
            SELECT l_orderkey, l_linenumber, l_extendedprice, l_returnflag,
                row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_extendedprice, l_returnflag) AS id
            FROM lineitem)
        SELECT l_orderkey, l_linenumber,
            CASE WHEN o_orderkey IS NULL THEN l_extendedprice ELSE o_totalprice END AS l_extendedprice,
            CASE WHEN o_orderkey IS NULL THEN l_returnflag ELSE o_orderstatus END AS l_returnflag,
            CAST(id AS BIGINT) AS "ID"
        FROM t LEFT JOIN orders ON o_orderkey = l_orderkey AND l_linenumber = 1
        UNION ALL
        SELECT o_orderkey, 1, o_totalprice, o_orderstatus, CAST((SELECT count(*) FROM t)
            + row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS BIGINT) FROM orders
        WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linenumber = 1)""",
    "assign_ids": """
        SELECT o_orderkey, o_custkey, o_orderpriority,
            CAST(100 + row_number() OVER (ORDER BY o_orderpriority, o_custkey, o_orderkey) AS BIGINT) AS "ID"
        FROM orders""",
    "add_surrogate_key": """
        SELECT *, CAST(row_number() OVER (ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber,
            l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate)
            AS BIGINT) AS "ID"
        FROM lineitem""",
    "duplicate_keys": """
        SELECT l_orderkey, l_linenumber, count(*) AS "DuplicateCount" FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "duplicate_keys_4col": """
        SELECT l_partkey, l_suppkey, l_returnflag, l_linestatus, count(*) AS "DuplicateCount"
        FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
    "primary_key_violations": """
        SELECT o_custkey, count(*) AS "DuplicateCount" FROM orders
        GROUP BY o_custkey HAVING count(*) > 1""",
    "not_null_violations": """
        WITH m AS (
            SELECT d.doc_id, d.source, l.quality, l.toxic
            FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)
        SELECT doc_id, 'source' AS column_name, 'not_null' AS reason, CAST(NULL AS VARCHAR) AS raw_value
        FROM m WHERE source IS NULL
        UNION ALL SELECT doc_id, 'quality', 'not_null', NULL FROM m WHERE quality IS NULL
        UNION ALL SELECT doc_id, 'toxic', 'not_null', NULL FROM m WHERE toxic IS NULL""",
    "length_violations": """
        SELECT doc_id, 'text' AS column_name, 'length' AS reason, text AS raw_value
        FROM documents WHERE length(text) > 50
        UNION ALL SELECT doc_id, 'lang', 'length', lang FROM documents WHERE length(lang) > 50
        UNION ALL SELECT doc_id, 'source', 'length', source FROM documents WHERE length(source) > 50""",
    "quarantine_good": f"""
        SELECT event_id, props, {AS_DECIMAL} AS amount FROM events
        WHERE event_id % 8 < 4 AND length(props) <= 8""",
    "quarantine_rejects": f"""
        SELECT event_id, 'raw' AS column_name, 'not_null' AS reason, CAST(NULL AS VARCHAR) AS raw_value
        FROM events WHERE event_id % 8 = 7
        UNION ALL SELECT event_id, 'props', 'length', props FROM events WHERE length(props) > 8
        UNION ALL SELECT event_id, 'amount', 'conversion', {RAW} FROM events WHERE event_id % 8 > 3""",
    "import_end_to_end": f"""
        SELECT {STUMPAGE_ROWS}, CAST(row_number() OVER (ORDER BY p_partkey) AS BIGINT) AS "ID"
        FROM part""",
    "import_log": """
        SELECT 'SUCCESS' AS level, CAST(p_partkey // 50000 AS BIGINT) AS file_no, 'stumpage' AS feed,
            count(*) AS row_count, count(*) AS processed, CAST(0 AS BIGINT) AS error_count
        FROM part GROUP BY p_partkey // 50000""",
    "import_two_months": f"""
        WITH a AS (SELECT *, l_shipdate >= TIMESTAMP '{SHIP_CUT}' AS late FROM lineitem),
        o AS (
            SELECT *, row_number() OVER (ORDER BY late, 2 * (l_orderkey * 4 // 50000) + l_suppkey % 2,
                l_orderkey, {FACTOR_ORDER}) AS n FROM a),
        k AS (
            SELECT *, row_number() OVER (
                    PARTITION BY l_orderkey, l_returnflag, l_linestatus, l_linenumber ORDER BY n DESC) AS r,
                min(n) OVER (PARTITION BY l_orderkey, l_returnflag, l_linestatus, l_linenumber) AS first
            FROM o)
        SELECT {FACTOR_ROWS}, CAST(row_number() OVER (ORDER BY first) AS BIGINT) AS "ID"
        FROM k WHERE r = 1""",
    "import_headers": f"""
        WITH f AS (SELECT DISTINCT p_partkey % 3 AS shape, p_partkey // 50000 AS file_no FROM part),
        c AS (SELECT unnest([{STUMPAGE_NAMES}, 'NOTE']) AS column_name)
        SELECT CAST(shape AS BIGINT) AS shape, CAST(file_no AS BIGINT) AS file_no, 'stumpage' AS feed,
            column_name, CASE WHEN column_name = 'NOTE' THEN 'extra'
                WHEN shape = 2 AND column_name = 'RATE' THEN 'missing' ELSE 'matched' END AS status
        FROM f JOIN c ON column_name <> 'NOTE' OR shape = 0""",
    "import_stream": f"""
        SELECT {STUMPAGE_ROWS}, CAST(row_number() OVER (ORDER BY p_partkey % 3, p_partkey) AS BIGINT) AS "ID"
        FROM part""",
    "lenient_defaults": """
        WITH l AS (
            SELECT *, p.c_custkey // 50000 AS file_no,
                row_number() OVER (PARTITION BY p.c_custkey // 50000 ORDER BY p.c_custkey) + 1 AS line_no
            FROM customer p),
        d AS (
            SELECT file_no, line_no, 'FACTOR_ID' AS column_name, 'x' || CAST(c_custkey AS VARCHAR) AS raw_value
            FROM l WHERE c_custkey % 5 = 0
            UNION ALL SELECT file_no, line_no, 'TAX_RATE', 'n/a' FROM l WHERE c_custkey % 3 = 0
            UNION ALL SELECT file_no, line_no, 'CULL_DEDUCTION', '1e999' FROM l WHERE c_custkey % 7 = 0)
        SELECT CAST(file_no AS BIGINT) AS file_no, CAST(line_no AS BIGINT) AS line_no, column_name, raw_value
        FROM d""",
    "table_defaults": f"""
        SELECT {STUMPAGE_ROWS}, CASE WHEN p_partkey % 2 = 1 THEN p_brand ELSE 'unknown' END AS "REGION",
            CAST(CASE WHEN p_partkey % 2 = 1 THEN p_size ELSE 0 END AS INTEGER) AS "LEVEL",
            CAST(row_number() OVER (ORDER BY p_partkey % 2, p_partkey) AS BIGINT) AS "ID"
        FROM part""",
}
