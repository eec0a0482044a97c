"""The same results in DuckDB SQL, written apart from the Spark side."""

from __future__ import annotations

from feedwright.operators.records import BAD_KEY, DUPLICATE, FACT_LOOKUP, LOOKUP


def orders_as(form: str, where: str = "true", day: str = "o_orderdate") -> str:
    return f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
               o_orderstatus, CAST(o_totalprice AS VARCHAR) AS o_totalprice,
               strftime({day}, '{form}') AS o_orderdate, o_orderpriority
        FROM orders WHERE {where}"""


def lines_as(form: str, day: str = "l_shipdate") -> str:
    return f"""
        SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_partkey AS VARCHAR) AS l_partkey,
               CAST(l_suppkey AS VARCHAR) AS l_suppkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber,
               CAST(l_quantity AS VARCHAR) AS l_quantity, CAST(l_extendedprice AS VARCHAR) AS l_extendedprice,
               CAST(l_discount AS VARCHAR) AS l_discount, CAST(l_tax AS VARCHAR) AS l_tax,
               l_returnflag, l_linestatus, strftime({day}, '{form}') AS l_shipdate
        FROM lineitem"""


DASHED = "%Y-%m-%d"
SLASHED = "%m/%d/%Y"
PACKED = "%Y%m%d"
MONTH_ENDING = "last_day(CAST({} AS DATE))"

CUSTOMER = """
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
           CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment
    FROM customer"""

ORDER_TEXT = "concat(o_orderkey, ',', o_custkey, ',', o_orderstatus, ',', o_totalprice, ',', o_orderdate, ',', o_orderpriority)"

SHELF = f"""
    WITH lines AS ({lines_as(DASHED)}), shelf AS (
      SELECT l_orderkey, l_linenumber,
             CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN '-' || l_quantity ELSE l_quantity END AS height,
             CASE WHEN l_linestatus = 'F' THEN replace(l_discount, '0.', '.') ELSE l_discount END AS depth,
             CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN '' ELSE l_returnflag END AS merch_group
      FROM lines)
    SELECT * FROM shelf WHERE """
SHELF_OK = "merch_group <> '' AND l_orderkey <> '' AND CAST(height AS DOUBLE) >= 0 AND CAST(depth AS DOUBLE) >= 0"
SHELF_OK_TEXT = "merch_group <> '' AND l_orderkey <> '' AND height >= '0' AND depth >= '0'"

LISTED = "SELECT 1 FROM part WHERE p_size <= 25 AND p_partkey = l_partkey"
NEAR = "SELECT 1 FROM supplier WHERE s_nationkey < 12 AND s_suppkey = l_suppkey"
FINAL = "SELECT 1 FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey = l_orderkey"


def grouped(keys: str, table: str, having: str) -> str:
    return f"SELECT {keys} FROM {table} GROUP BY {keys} HAVING {having}"


def weeks(days: str, name: str, dataset: str, as_of: str) -> str:
    """Coverage over the dates ``d`` of the query ``days``."""
    return f"""
    WITH days AS ({days}),
    bounds AS (SELECT min(d) AS lo, max(d) AS hi FROM days),
    spine AS (
      SELECT lo, hi, CAST(unnest(generate_series(
               CAST(date_trunc('week', lo) AS TIMESTAMP) + INTERVAL 5 DAY,
               CAST(DATE '{as_of}' - CAST((isodow(DATE '{as_of}') + 1) % 7 AS INTEGER) AS TIMESTAMP),
               INTERVAL 7 DAY)) AS DATE) AS sat
      FROM bounds),
    have AS (SELECT DISTINCT CAST(date_trunc('week', d + 1) AS DATE) AS wk FROM days)
    SELECT '{dataset}' AS "Dataset_Name", strftime(sat, '{SLASHED}') AS {name},
           CASE WHEN wk IS NULL THEN 'No' ELSE 'Yes' END AS "Availability",
           strftime(DATE '{as_of}', '{SLASHED}') AS "DBInsertDate",
           strftime(lo, '%-m/%-d/%Y') AS "MinDate", strftime(hi, '%-m/%-d/%Y') AS "MaxDate"
    FROM spine LEFT JOIN have ON wk = CAST(date_trunc('week', sat + 1) AS DATE)"""


MIXED = """
    SELECT l_orderkey, l_linenumber,
           CASE l_returnflag WHEN 'A' THEN strftime(l_shipdate, '%Y-%m-%d')
                             WHEN 'N' THEN strftime(l_shipdate, '%Y%m%d')
                             ELSE 'wk ' || strftime(l_shipdate, '%y') END AS ship_text
    FROM lineitem"""
MIXED_DAY = "coalesce(try_strptime(ship_text, '%Y-%m-%d'), try_strptime(ship_text, '%Y%m%d'))"

LATE = orders_as(SLASHED, "o_orderdate >= TIMESTAMP '2001-07-01' AND o_orderstatus = 'F'")
RESTATED = f"""
    WITH hist AS ({orders_as(SLASHED)}), clean AS ({LATE}),
    bounds AS (SELECT min(strptime(o_orderdate, '{SLASHED}')) AS lo, max(strptime(o_orderdate, '{SLASHED}')) AS hi
               FROM clean)
    SELECT hist.* FROM hist, bounds
    WHERE strptime(o_orderdate, '{SLASHED}') < lo OR strptime(o_orderdate, '{SLASHED}') > hi
    UNION SELECT * FROM clean"""

# One customer run: names without '#', lower-case segments, three-digit nations.
CUSTOMER_CHECKED = f"""
    first AS ({CUSTOMER}),
    changed AS (
      SELECT c_custkey, c_name, c_nationkey, CAST(CAST(c_acctbal AS DOUBLE) + 1 AS VARCHAR) AS c_acctbal, c_mktsegment
      FROM first WHERE c_nationkey = '3'),
    second AS (
      SELECT * FROM changed
      UNION ALL SELECT c_custkey, c_name, c_nationkey, '0', c_mktsegment FROM changed WHERE c_mktsegment = 'BUILDING'),
    sent AS (SELECT 1 AS run, * FROM first UNION ALL SELECT 2, * FROM second),
    checked AS (
      SELECT run, c_custkey, replace(c_name, '#', '') AS c_name, c_nationkey, c_acctbal, c_mktsegment,
             c_custkey = '0' AS bad
      FROM sent),
    conformed AS (
      SELECT run, c_custkey, c_name, lpad(c_nationkey, 3, '0') AS c_nationkey, c_acctbal,
             lower(c_mktsegment) AS c_mktsegment, count(*) OVER (PARTITION BY run, c_custkey) AS n
      FROM checked WHERE NOT bad)"""
CUSTOMER_COLUMNS = "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment"
CUSTOMER_TEXT = "concat(c_custkey, ',', c_name, ',', c_nationkey, ',', c_acctbal, ',', c_mktsegment)"

# The restating delivery of lines with its three lookups. ``{zero}`` says whether
# the masters went through their own key rule, which takes out key 0.
LINE_COLUMNS = "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag, l_shipdate"
LINE_TEXT = (
    "concat(l_orderkey, ',', l_partkey, ',', l_suppkey, ',', l_linenumber, ',', l_quantity, ',', "
    "l_extendedprice, ',', l_returnflag, ',', l_shipdate)"
)


def lines_checked(zero: str) -> str:
    return f"""
    lines AS ({lines_as(DASHED, MONTH_ENDING.format("l_shipdate"))}),
    delivery AS (
      SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, '0' AS l_quantity, l_extendedprice, l_returnflag,
             CASE WHEN l_linestatus = 'O' THEN replace(l_shipdate, '-0', '-9') ELSE l_shipdate END AS l_shipdate
      FROM lines WHERE l_returnflag = 'R' AND l_shipdate >= '2001-01-01'),
    conformed AS (
      SELECT * EXCLUDE (l_shipdate),
             coalesce(strftime(try_strptime(l_shipdate, '{DASHED}'), '{SLASHED}'), 'Unparceable') AS l_shipdate
      FROM delivery),
    checked AS (
      SELECT *, l_orderkey = '0' OR l_partkey = '0' OR l_shipdate = 'Unparceable' AS bad,
             l_partkey IN (SELECT CAST(p_partkey AS VARCHAR) FROM part WHERE p_size <= 25 {zero and 'AND p_partkey <> 0'}) AS ok_part,
             l_suppkey IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier WHERE s_nationkey < 12 {zero and 'AND s_suppkey <> 0'}) AS ok_supp,
             l_orderkey IN (SELECT CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderstatus <> 'P' {zero and 'AND o_orderkey <> 0'}) AS ok_order
      FROM conformed),
    clean AS (SELECT {LINE_COLUMNS} FROM checked WHERE NOT bad AND ok_part AND ok_supp AND ok_order),
    hist AS (SELECT {LINE_COLUMNS} FROM ({lines_as(SLASHED, MONTH_ENDING.format("l_shipdate"))})),
    bounds AS (SELECT min(strptime(l_shipdate, '{SLASHED}')) AS lo, max(strptime(l_shipdate, '{SLASHED}')) AS hi
               FROM clean),
    kept AS (SELECT hist.* FROM hist, bounds
             WHERE strptime(l_shipdate, '{SLASHED}') < lo OR strptime(l_shipdate, '{SLASHED}') > hi)"""


EVENTS = "SELECT event_id, ts, user_id, event_type, value, props FROM events"
AS_OF = "2002-03-15"

SALES_CHECKED = """products AS (
        SELECT p_partkey FROM part WHERE p_size > 2 AND p_partkey <> 0),
    stores AS (SELECT s_suppkey FROM supplier WHERE s_nationkey > 3 AND s_suppkey <> 0),
    sales AS (
        SELECT *, l_returnflag = 'R' OR l_partkey = 0 OR l_suppkey = 0 AS bad, l_partkey IN (SELECT p_partkey FROM products) AS product,
               l_suppkey IN (SELECT s_suppkey FROM stores) AS store
        FROM lineitem)"""

BASKET_CHECKED = """baskets AS (
        SELECT *, l_returnflag = 'R' AS bad, o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey > 3) AS guest,
               l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 10) AS item,
               l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_nationkey > 2) AS concept,
               l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 20) AS held
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

ORACLE: dict[str, str] = {
    "key_rule_clean": f"WITH f AS ({orders_as(DASHED)}) SELECT * FROM f WHERE o_orderkey NOT IN ('', '0') AND o_custkey NOT IN ('', '0')",
    "key_rule_errors": f"""
        WITH f AS ({orders_as(DASHED)})
        SELECT 'orders' AS "Data_Set_Name",
               'Columns: o_orderkey,o_custkey is not proper(null/blank/0/Unparceable)' AS "Error_Description",
               {ORDER_TEXT} AS "Error_Record"
        FROM f WHERE o_orderkey IN ('', '0') OR o_custkey IN ('', '0')""",
    "key_rule_any": f"""
        SELECT c_custkey, c_name, nullif(c_nationkey, '3') AS c_nationkey, c_acctbal,
               nullif(c_mktsegment, 'BUILDING') AS c_mktsegment
        FROM ({CUSTOMER}) WHERE nullif(c_mktsegment, 'BUILDING') IS NOT NULL OR nullif(c_nationkey, '3') IS NOT NULL""",
    "planogram_clean": f"{SHELF} {SHELF_OK}",
    "planogram_errors": f"{SHELF} NOT ({SHELF_OK})",
    "planogram_clean_text_order": f"{SHELF} {SHELF_OK_TEXT}",
    "planogram_errors_text_order": f"{SHELF} NOT ({SHELF_OK_TEXT})",
    "unique_split_clean": "SELECT * EXCLUDE (n) FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem) WHERE n = 1",
    "unique_split_dups": "SELECT * EXCLUDE (n) FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem) WHERE n > 1",
    "unique_split_dups_distinct": """
        WITH twice AS (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_returnflag = 'R')
        SELECT DISTINCT * EXCLUDE (n)
        FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM twice) WHERE n > 1""",
    "unique_dup_records": f"""
        WITH f AS (SELECT *, count(*) OVER (PARTITION BY o_custkey) AS n FROM ({orders_as(DASHED)}))
        SELECT 'orders' AS "Data_Set_Name", 'Columns: o_custkey is Duplicate in data' AS "Error_Description",
               {ORDER_TEXT} AS "Error_Record" FROM f WHERE n > 1""",
    "key_counts": "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL",
    "single_key_counts": grouped("l_orderkey, l_linenumber", "lineitem", "count(*) = 1"),
    "fk_keep": f"SELECT * FROM lineitem WHERE EXISTS ({LISTED})",
    "fk_errors": f"SELECT DISTINCT * FROM lineitem WHERE NOT EXISTS ({LISTED})",
    "fk_documents_keep": "SELECT * FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
    "fk_documents_errors": "SELECT DISTINCT * FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
    "fk_chain_clean": f"SELECT * FROM lineitem WHERE EXISTS ({LISTED}) AND EXISTS ({NEAR}) AND EXISTS ({FINAL})",
    "fk_chain_errors": f"""
        SELECT DISTINCT *, 'l_partkey' AS failed FROM lineitem WHERE NOT EXISTS ({LISTED})
        UNION ALL SELECT DISTINCT *, 'l_suppkey' FROM lineitem WHERE NOT EXISTS ({NEAR})
        UNION ALL SELECT DISTINCT *, 'l_orderkey' FROM lineitem WHERE NOT EXISTS ({FINAL})""",
    "fk_chain_records": f"""
        WITH bad AS (
          SELECT DISTINCT *, 'l_partkey' AS failed FROM lineitem WHERE NOT EXISTS ({LISTED})
          UNION ALL SELECT DISTINCT *, 'l_suppkey' FROM lineitem WHERE NOT EXISTS ({NEAR})
          UNION ALL SELECT DISTINCT *, 'l_orderkey' FROM lineitem WHERE NOT EXISTS ({FINAL}))
        SELECT 'lineitem' AS "Data_Set_Name", 'Refrential Integrity failed at column: ' || failed AS "Error_Description",
               concat(l_orderkey, ',', l_partkey, ',', l_suppkey, ',', l_linenumber, ',', CAST(l_quantity AS VARCHAR), ',',
                      CAST(l_extendedprice AS VARCHAR), ',', CAST(l_discount AS VARCHAR), ',', CAST(l_tax AS VARCHAR), ',',
                      l_returnflag, ',', l_linestatus, ',', strftime(l_shipdate, '{DASHED}')) AS "Error_Record"
        FROM bad""",
    "fk_ci_spelling": f"""
        WITH m AS (SELECT upper(c_mktsegment) AS u, min(word) AS word FROM (
                     SELECT c_mktsegment, c_mktsegment AS word FROM customer WHERE c_mktsegment <> 'FURNITURE'
                     UNION ALL
                     SELECT c_mktsegment, upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) FROM customer
                     WHERE c_mktsegment <> 'FURNITURE') GROUP BY 1)
        SELECT c_custkey, c_name, c_nationkey, c_acctbal, m.word AS c_mktsegment
        FROM ({CUSTOMER}) f JOIN m ON m.u = upper(lower(f.c_mktsegment))""",
    "master_key_scan": "SELECT DISTINCT c_nationkey FROM customer",
    "merge_append": f"""
        {orders_as(DASHED, "o_orderstatus IN ('F', 'O')")} UNION {orders_as(DASHED, "o_orderstatus IN ('O', 'P')")}""",
    "merge_append_new_rows": f"""
        {orders_as(DASHED, "o_orderstatus IN ('O', 'P')")} EXCEPT {orders_as(DASHED, "o_orderstatus IN ('F', 'O')")}""",
    "merge_upsert": """
        WITH clean AS (SELECT * REPLACE (c_acctbal + 1 AS c_acctbal) FROM customer WHERE c_nationkey = 3)
        SELECT * FROM customer h WHERE NOT EXISTS (SELECT 1 FROM clean c WHERE c.c_custkey = h.c_custkey)
        UNION SELECT * FROM clean""",
    "merge_replace_range": RESTATED,
    "merge_replace_dates": f"""
        WITH hist AS ({orders_as(SLASHED)}), clean AS ({LATE})
        SELECT * FROM hist WHERE o_orderdate NOT IN (SELECT o_orderdate FROM clean) UNION SELECT * FROM clean""",
    "merge_per_file": "SELECT DISTINCT event_type AS file, user_id, props FROM events",
    "union_all_rows": f"""
        {orders_as(DASHED, "o_orderstatus IN ('F', 'O')")} UNION ALL {orders_as(DASHED, "o_orderstatus IN ('O', 'P')")}""",
    "except_distinct_rows": """
        SELECT l_partkey, l_suppkey, l_returnflag FROM lineitem
        EXCEPT SELECT l_partkey, l_suppkey, l_returnflag FROM lineitem WHERE l_returnflag = 'R'""",
    "except_keep_copies_rows": """
        SELECT l_partkey, l_returnflag FROM lineitem a WHERE NOT EXISTS (
          SELECT 1 FROM lineitem b
          WHERE b.l_returnflag = 'R' AND a.l_partkey = b.l_partkey AND a.l_returnflag = b.l_returnflag)""",
    "distinct_rows": "SELECT DISTINCT role, text FROM conversations",
    "distinct_key_pairs": "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem",
    "missing_weeks": weeks("SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders", "o_orderdate", "orders", AS_OF),
    "missing_weeks_large_urgent": weeks(
        "SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 480000",
        "o_orderdate",
        "large urgent orders",
        AS_OF,
    ),
    "missing_weeks_events": weeks("SELECT DISTINCT CAST(ts AS DATE) AS d FROM events", "day", "events", "2024-03-31"),
    "first_and_last_day": "SELECT CAST(min(o_orderdate) AS DATE) AS first_day, CAST(max(o_orderdate) AS DATE) AS last_day FROM orders",
    "week_labels": f"""
        WITH f AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)
        SELECT strftime(d, '{SLASHED}') AS o_orderdate,
               concat(CAST(year(d + 1) AS VARCHAR), '/', CAST(weekofyear(d + 1) AS VARCHAR)) AS label,
               CAST(date_trunc('week', d + 1) AS DATE) AS week_start,
               CAST(date_trunc('week', d) AS DATE) + 5 AS saturday,
               d - CAST((isodow(d) + 1) % 7 AS INTEGER) AS saturday_before
        FROM f""",
    "date_reformat": f"SELECT *, coalesce(strftime({MIXED_DAY}, '{SLASHED}'), 'Unparceable') AS ship_date FROM ({MIXED})",
    "date_epoch_millis": f"SELECT *, coalesce(epoch_ms({MIXED_DAY}), 0) AS millis FROM ({MIXED})",
    "date_year": f"SELECT *, coalesce(year({MIXED_DAY}), 0) AS year FROM ({MIXED})",
    "date_millis_year": "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, year(o_orderdate) AS year FROM orders",
    "date_compare": f"""
        SELECT l_orderkey, l_linenumber, ship_text,
               CAST(coalesce(sign(date_diff('day', o_orderdate, {MIXED_DAY})), 0) AS BIGINT) AS sign
        FROM ({MIXED}) JOIN orders ON o_orderkey = l_orderkey""",
    "date_bounds": "SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders",
    "range_half_open": orders_as(
        DASHED, "o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1998-07-01'"
    ),
    "bucket_52_weeks": f"""
        SELECT f.*, CAST(date_diff('day', lo, strptime(o_orderdate, '{SLASHED}')) // 364 AS INTEGER) AS bucket
        FROM ({orders_as(SLASHED)}) f, (SELECT min(o_orderdate) AS lo FROM orders)""",
    "bucket_52_weeks_sink": """
        SELECT CAST(date_diff('day', lo, o_orderdate) // 364 AS INTEGER) AS bucket, count(*) AS n,
               min(CAST(o_orderkey AS VARCHAR)) AS first_key
        FROM orders, (SELECT min(o_orderdate) AS lo FROM orders) GROUP BY 1""",
    "code_padding": """
        SELECT p_partkey, lpad(CAST(p_partkey AS VARCHAR), 13, '0') AS code13,
               lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS code9, lpad(p_name, 9, '0') AS name9 FROM part""",
    "strip_chars": """
        SELECT o_orderkey, replace(o_orderpriority, '-', '') AS priority,
               strftime(o_orderdate, '%Y%m%d') AS packed_date FROM orders""",
    "strip_quotes": "SELECT event_id, coalesce(replace(props, '\"', ''), '') AS props FROM events",
    "strip_line_quotes": "SELECT page_id, replace(html, '\"', '') AS html FROM pages",
    "replace_text": "SELECT doc_id, replace(replace(replace(text, '&', 'and'), ' ', '_'), '`', '') AS text FROM documents",
    "blank_to_null": "SELECT c_custkey, nullif(c_mktsegment, 'MACHINERY') AS segment FROM customer",
    "upper_keys": "SELECT p_partkey, upper(p_name) AS p_name FROM part",
    "row_text": """
        SELECT c_custkey, concat(CAST(c_custkey AS VARCHAR), ',', c_name, ',', CAST(c_nationkey AS VARCHAR), ',',
               CAST(c_acctbal AS VARCHAR), ',', coalesce(nullif(c_mktsegment, 'BUILDING'), 'null')) AS line FROM customer""",
    "dataset_names": "SELECT p_partkey, p_name AS dataset FROM part",
    "row_counts": """
        SELECT count(*) AS received, count(*) FILTER (WHERE o_orderkey <> 0 AND o_custkey <> 0) AS processed,
               count(*) FILTER (WHERE o_orderkey = 0 OR o_custkey = 0) AS rejected FROM orders""",
    "rejected_arithmetic": f"""
        SELECT (SELECT count(*) FROM lineitem) AS received, n AS processed, (SELECT count(*) FROM lineitem) - n AS rejected
        FROM (SELECT count(*) AS n FROM lineitem WHERE EXISTS ({LISTED}) AND EXISTS ({NEAR}) AND EXISTS ({FINAL}))""",
    "raw_to_stage": f"""
        SELECT CAST(event_id AS VARCHAR) AS event_id, strftime(ts, '{DASHED}') AS ts, CAST(user_id AS VARCHAR) AS user_id,
               event_type, CAST(value AS VARCHAR) AS value, replace(props, '"', '') AS props FROM events""",
    "raw_to_stage_manifest": """
        SELECT 'Processed' AS "Status", 'NA' AS "Error_description", count(*) AS total_rows FROM events
        UNION ALL SELECT 'Rejected', 'File Renameing Failed / File already present in Stage', count(*) FROM events
        UNION ALL SELECT 'Rejected', 'Schema validation failed', 2 * count(*) FROM customer""",
    "header_check": """
        SELECT true AS valid, '' AS width, '' AS missing, '' AS extra, '' AS misplaced, count(*) AS total_rows FROM events
        UNION ALL
        SELECT false, 'LESS: 5 columns, 6 declared', 'event_id,ts,user_id,event_type,value,props',
               'c_custkey,c_name,c_nationkey,c_acctbal,c_mktsegment', 'event_id,ts,user_id,event_type,value,props',
               count(*) FROM customer""",
    "pipe_feed": orders_as(DASHED),
    "pipe_line_widths": """
        SELECT (SELECT count(*) FROM orders) + (SELECT count(*) FROM customer) AS total_rows,
               (SELECT count(*) FROM customer) AS off_rows""",
    "catalog_weather": """
        SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS zip, strftime(o_orderdate, '%Y-%m-%d') AS date,
               o_orderstatus AS rh
        FROM orders WHERE o_orderpriority <> '1-URGENT'""",
    "catalog_product": """
        SELECT CAST(p_partkey AS VARCHAR) AS ProductNbr, p_name AS ProductName FROM part WHERE p_size > 2 AND p_partkey <> 0
        UNION ALL SELECT 'P2', min(p_name) FROM part WHERE p_size = 2 HAVING count(*) = 1""",
    "catalog_product_errors": f"""
        SELECT '{BAD_KEY.format("ProductNbr")}' AS Error_Description, count(*) AS n
        FROM part WHERE p_size = 1 OR p_size > 2 AND p_partkey = 0 HAVING count(*) > 0
        UNION ALL SELECT '{DUPLICATE.format("ProductNbr")}', count(*) FROM part WHERE p_size = 2 HAVING count(*) > 1""",
    "catalog_sales": f"""
        WITH {SALES_CHECKED}
        SELECT CAST(l_orderkey AS VARCHAR) AS TotalSales, CAST(l_linenumber AS VARCHAR) AS TotalUnits,
               CAST(l_suppkey AS VARCHAR) AS LocationNbr, CAST(l_partkey AS VARCHAR) AS ProductNbr
        FROM sales WHERE NOT bad AND product AND store""",
    "catalog_sales_errors": f"""
        WITH {SALES_CHECKED}
        SELECT '{BAD_KEY.format("LocationNbr, ProductNbr, TransWeek")}' AS Error_Description, count(*) AS n
        FROM sales WHERE bad HAVING count(*) > 0
        UNION ALL SELECT '{FACT_LOOKUP.format("ProductNbr")}', count(*) FROM sales
        WHERE NOT bad AND NOT product HAVING count(*) > 0
        UNION ALL SELECT '{FACT_LOOKUP.format("LocationNbr")}', count(*) FROM sales
        WHERE NOT bad AND NOT store HAVING count(*) > 0""",
    "raw_inventory": f"""
        WITH {SALES_CHECKED}
        SELECT CAST(l_orderkey AS VARCHAR) AS EOHSales, CAST(l_linenumber AS VARCHAR) AS EOHUnits,
               CAST(l_suppkey AS VARCHAR) AS LocationNbr, CAST(l_partkey AS VARCHAR) AS ProductNbr
        FROM sales WHERE NOT bad AND product AND store""",
    "raw_inventory_errors": f"""
        WITH {SALES_CHECKED}
        SELECT '{BAD_KEY.format("LocationNbr, ProductNbr, TransWeek")}' AS Error_Description, count(*) AS n
        FROM sales WHERE bad HAVING count(*) > 0
        UNION ALL SELECT '{FACT_LOOKUP.format("ProductNbr")}', count(*) FROM sales
        WHERE NOT bad AND NOT product HAVING count(*) > 0
        UNION ALL SELECT '{FACT_LOOKUP.format("LocationNbr")}', count(*) FROM sales
        WHERE NOT bad AND NOT store HAVING count(*) > 0""",
    "raw_basket": f"""
        WITH {BASKET_CHECKED}
        SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS RGTN_I, CAST(l_linenumber AS VARCHAR) AS LITM_ENTR_SEQ_I,
               CAST(o_custkey + 1 AS VARCHAR) AS GST_REF_I, CAST(l_partkey + 1 AS VARCHAR) AS MDSE_ITEM_I,
               CAST(l_suppkey + 1 AS VARCHAR) AS CO_LOC_I, strftime(date_trunc('month', o_orderdate), '{SLASHED}') AS SLS_D
        FROM baskets WHERE NOT bad AND guest AND item AND concept AND held""",
    "raw_basket_errors": f"""
        WITH {BASKET_CHECKED}, failed AS (
          SELECT * FROM (VALUES ('GST_REF_I when mapped to GST_DEMOS.GST_REF_I', 'guest'),
            ('CO_LOC_REF_I when mapped to STR_CNCPT.CO_LOC_REF_I', 'concept'), ('CO_LOC_REF_I when mapped to STR_CURR.STR_I', 'held'),
            ('CO_LOC_I when mapped to STR_CNCPT.CO_LOC_I', 'concept'), ('CO_LOC_I when mapped to STR_CURR.SITE_SEQ_I', 'held'),
            ('MDSE_ITEM_I when mapped to ITEM_HIER.MDSE_ITEM_I', 'item'),
            ('MDSE_ITEM_REF_I when mapped to ITEM_HIER.MDSE_ITEM_REF_I', 'item')) v(label, kind))
        SELECT '{BAD_KEY.format("GST_REF_I, MDSE_ITEM_I, MDSE_ITEM_REF_I,SLS_D,CO_LOC_I,CO_LOC_REF_I")}' AS Error_Description,
               count(*) AS n FROM baskets WHERE bad HAVING count(*) > 0
        UNION ALL
        SELECT replace('{FACT_LOOKUP}', '{{}}', label), count(DISTINCT (o_custkey, o_orderdate, l_orderkey, l_linenumber, l_partkey, l_suppkey))
        FROM baskets, failed
        WHERE NOT bad AND NOT CASE kind WHEN 'guest' THEN guest WHEN 'item' THEN item WHEN 'concept' THEN concept ELSE held END
        GROUP BY label""",
    "raw_assortment_tree": """
        SELECT lpad('0' || CAST(p_partkey + 1 AS VARCHAR), 9, '0') AS DPCI, p_brand AS brand, p_type AS Form
        FROM part WHERE p_size > 10 AND p_size <> 50""",
    "raw_assortment_tree_errors": f"""
        SELECT '{BAD_KEY.format("DPCI")}' AS Error_Description, count(DISTINCT (p_brand, p_type)) AS n
        FROM part WHERE p_size = 50 HAVING count(*) > 0
        UNION ALL SELECT '{LOOKUP.format("DPCI")}', count(*) FROM part WHERE p_size <= 10 HAVING count(*) > 0""",
    "raw_price_list": f"""
        SELECT lpad(CAST(o_orderkey AS VARCHAR), 13, '0') AS UNIT_UPC, strftime(o_orderdate, '{SLASHED}') AS Material_status_date,
               CAST(o_custkey AS VARCHAR) AS GTIN
        FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey <> 0""",
    "raw_promotion_events": f"""
        SELECT DISTINCT o_orderstatus AS Retailer, o_orderpriority AS PPG, strftime(o_orderdate, '{SLASHED}') AS AMPS_Event_Start_Date
        FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority < '4'""",
    "raw_promotion_errors": f"""
        WITH o AS (SELECT DISTINCT o_orderstatus, o_orderpriority, o_orderdate FROM orders)
        SELECT '{BAD_KEY.format("Retailer,PPG")}' AS Error_Description, count(*) AS n FROM o WHERE o_orderstatus = 'P' HAVING count(*) > 0
        UNION ALL SELECT '{LOOKUP.format("PPG")}', count(*) FROM o WHERE o_orderstatus <> 'P' AND o_orderpriority >= '4' HAVING count(*) > 0""",
    "ragged_rows": """
        SELECT concat_ws(',', o_orderkey, o_custkey, o_orderstatus, 'EXTRA') AS Line
        FROM orders WHERE o_orderstatus = 'P'""",
    "piped_every_line": """
        SELECT 'Processed' AS Status, count(*) AS total_rows FROM orders
        UNION ALL SELECT 'Rejected', count(*) FROM orders""",
    "text_line_sink": orders_as(DASHED),
    "nested_file_scan": """
        SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, CAST(p_size AS VARCHAR) AS p_size,
               CAST(p_retailprice AS VARCHAR) AS p_retailprice FROM part""",
    "master_run": f"""
        WITH {CUSTOMER_CHECKED}, good AS (SELECT * FROM conformed WHERE n = 1)
        SELECT {CUSTOMER_COLUMNS} FROM good g WHERE run = 1
          AND NOT EXISTS (SELECT 1 FROM good h WHERE h.run = 2 AND h.c_custkey = g.c_custkey)
        UNION ALL SELECT {CUSTOMER_COLUMNS} FROM good WHERE run = 2""",
    "master_run_errors": f"""
        WITH {CUSTOMER_CHECKED}
        SELECT 'customers' AS "Data_Set_Name",
               'Columns: c_custkey,c_mktsegment is not proper(null/blank/0/Unparceable)' AS "Error_Description",
               {CUSTOMER_TEXT} AS "Error_Record" FROM checked WHERE bad
        UNION ALL
        SELECT 'customers', 'Columns: c_custkey is Duplicate in data', {CUSTOMER_TEXT} FROM conformed WHERE n > 1""",
    "run_manifests": f"""
        WITH {CUSTOMER_CHECKED}
        SELECT 'customers' AS "Data_Set_Name", 'Processed' AS "Status", s.n AS "No_Of_records_received",
               s.n - g.n AS "No_Of_records_rejected", g.n AS "No_Of_records_processed"
        FROM (SELECT run, count(*) AS n FROM sent GROUP BY run) s
        JOIN (SELECT run, count(*) AS n FROM conformed WHERE n = 1 GROUP BY run) g ON s.run = g.run""",
    "fact_run": f"WITH {lines_checked('')} SELECT * FROM kept UNION SELECT * FROM clean",
    "fact_run_errors": f"""
        WITH {lines_checked('')}, failed AS (
          SELECT DISTINCT {LINE_COLUMNS}, 'l_partkey' AS c FROM checked WHERE NOT bad AND NOT ok_part
          UNION ALL SELECT DISTINCT {LINE_COLUMNS}, 'l_suppkey' FROM checked WHERE NOT bad AND NOT ok_supp
          UNION ALL SELECT DISTINCT {LINE_COLUMNS}, 'l_orderkey' FROM checked WHERE NOT bad AND NOT ok_order)
        SELECT 'lines' AS "Data_Set_Name",
               'Columns: l_orderkey,l_partkey,l_shipdate is not proper(null/blank/0/Unparceable)' AS "Error_Description",
               {LINE_TEXT} AS "Error_Record" FROM checked WHERE bad
        UNION ALL
        SELECT 'lines', 'Refrential Integrity failed at column: ' || c, {LINE_TEXT} FROM failed""",
    "fact_run_in_folders": f"WITH {lines_checked('zero')} SELECT * FROM kept UNION ALL SELECT DISTINCT * FROM clean",
    "fact_run_increment": f"WITH {lines_checked('zero')} SELECT * FROM clean",
    "fact_run_coverage": "",
    "snapshot_restatement": f"""
        WITH hist AS ({orders_as(SLASHED, day=MONTH_ENDING.format("o_orderdate"))}),
        sent AS (SELECT *, CAST(strptime(o_orderdate, '{SLASHED}') AS DATE) AS d FROM hist),
        clean AS (SELECT * FROM sent WHERE d IN (DATE '2001-04-30', DATE '2001-06-30') AND o_orderstatus = 'F'),
        bounds AS (SELECT min(d) AS lo, max(d) AS hi FROM clean)
        SELECT sent.* EXCLUDE (d) FROM sent, bounds WHERE d < lo OR d > hi
        UNION SELECT * EXCLUDE (d) FROM clean""",
    "increment_sink": LATE,
    "padded_collisions": """
        WITH own AS (SELECT lpad(k, greatest(4, length(k))::INTEGER, '0') AS original, count(*) AS n
                     FROM (SELECT CAST(l_orderkey AS VARCHAR) AS k FROM lineitem) GROUP BY 1)
        SELECT lpad(original, 4, '0') AS code, count(*) AS originals, CAST(sum(n) AS BIGINT) AS rows,
               min(original) AS first_original, max(original) AS last_original
        FROM own GROUP BY 1 HAVING count(*) > 1""",
    "quoted_line_breaks": """
        SELECT CAST(doc_id AS VARCHAR) AS doc_id, nullif(lang, '') AS lang, nullif(replace(text, '"', ''), '') AS text
        FROM documents""",
    "restaged_run": "SELECT CAST(o_orderkey AS VARCHAR) AS key FROM orders",
    "file_ledger": """
        SELECT 'r1' AS run_id, 'Processed' AS "Status", 'NA' AS "Error_description", count(*) AS total_rows FROM orders
        UNION ALL SELECT 'r1', 'Rejected', 'Schema validation failed', count(*) FROM customer
        UNION ALL SELECT 'r2', 'Rejected', 'Schema validation failed', count(*) FROM customer
        UNION ALL SELECT 'r2', 'Rejected', 'File Renameing Failed / File already present in Stage', count(*) FROM orders""",
    "empty_delivery": f"""
        WITH {CUSTOMER_CHECKED}
        SELECT count(*) AS kept, 'Processed' AS "Status", CAST(0 AS BIGINT) AS "No_Of_records_received",
               CAST(0 AS BIGINT) AS "No_Of_records_processed" FROM conformed WHERE n = 1 AND run = 1""",
    "upsert_in_buckets": """
        SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
               CAST(CASE WHEN c_nationkey = 3 THEN c_acctbal + 1 ELSE c_acctbal END AS VARCHAR) AS c_acctbal, c_mktsegment
        FROM customer""",
    "append_by_fingerprint": f"SELECT DISTINCT * FROM ({orders_as(DASHED)})",
    "compacted_appends": f"""
        SELECT o_orderdate, count(*) AS rows, CAST(1 AS BIGINT) AS files
        FROM ({orders_as(SLASHED, day=MONTH_ENDING.format("o_orderdate"))}) GROUP BY o_orderdate""",
    "load_order_run": """
        SELECT 'region' AS "Data_Set_Name", 0 AS "Level", 'Processed' AS "Status", n AS "Received", ok AS "Processed"
        FROM (SELECT count(*) AS n, count(*) FILTER (r_regionkey <> 0) AS ok FROM region)
        UNION ALL SELECT 'nation', 1, 'Processed', n, ok FROM (
            SELECT count(*) AS n, count(*) FILTER (n_nationkey <> 0 AND n_regionkey <> 0) AS ok FROM nation)
        UNION ALL SELECT 'supplier', 2, 'Processed', n, ok FROM (
            SELECT count(*) AS n, count(*) FILTER (s_suppkey <> 0 AND s_nationkey IN (
                SELECT n_nationkey FROM nation WHERE n_nationkey <> 0 AND n_regionkey <> 0)) AS ok FROM supplier)
        UNION ALL SELECT 'customer', 2, 'Processed', n, ok FROM (
            SELECT count(*) AS n, count(*) FILTER (c_custkey <> 0 AND c_nationkey IN (
                SELECT n_nationkey FROM nation WHERE n_nationkey <> 0 AND n_regionkey <> 0)) AS ok FROM customer)
        UNION ALL SELECT 'part', 0, 'Exception Occured while Processing', NULL, NULL
        UNION ALL SELECT 'orders', 1, 'Held back', NULL, NULL""",
    "per_file_sink": "SELECT DISTINCT event_type AS file, user_id, props FROM events",
}

_COVERED = f"SELECT DISTINCT CAST(strptime(l_shipdate, '{SLASHED}') AS DATE) AS d FROM (SELECT l_shipdate FROM kept UNION ALL SELECT l_shipdate FROM clean)"
ORACLE["fact_run_coverage"] = weeks(f"WITH {lines_checked('zero')} {_COVERED}", "l_shipdate", "lines", AS_OF)
