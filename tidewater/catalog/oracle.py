"""DuckDB SQL equivalents of the query catalogue (the correctness oracle).

Each statement runs on the driver tables registered as views and must give
the same rows, column names and types as the matching Spark query.
"""

from __future__ import annotations


def half_up(expr: str, digits: int) -> str:
    """Spark's ``round`` on a double: half away from zero on the value's
    shortest decimal text."""
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


def half_up_decimal(expr: str, digits: int) -> str:
    """The same as an exact number of six decimals."""
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DECIMAL(38,6))"


MONEY = "CAST({} AS DECIMAL(18,2))"

_ENGINE_AGGS = [
    ("avg_rpm", "avg", "rpm", 1),
    ("max_rpm", "max", "rpm", 1),
    ("avg_speed_kmh", "avg", "speed", 2),
    ("max_speed_kmh", "max", "speed", 2),
    ("avg_maf", "avg", "maf", 4),
    ("avg_log_maf", "avg", "log_maf", 4),
    ("avg_load_pct", "avg", "engine_load", 2),
    ("avg_oat_c", "avg", "oat", 2),
    ("avg_stft_b1", "avg", "stft1", 4),
    ("avg_ltft_b1", "avg", "ltft1", 4),
    ("avg_stft_b2", "avg", "stft2", 4),
    ("avg_ltft_b2", "avg", "ltft2", 4),
    ("avg_fuel_consumption_proxy", "avg", "proxy", 4),
]

def _exact_mean(x: str) -> str:
    """The mean of the doubles themselves, exact until it is rounded once:
    the sum of whole multiples of 2**-60, divided, with a last bit that tells
    of a remainder, in a number that a double's rounding reads as it is."""
    total, count = f"SUM(CAST({x} * {1 << 60} AS HUGEINT))", f"COUNT({x})"
    whole = f"(abs({total}) // {count})"

    def rounded(bits: int) -> str:
        more = f"CAST(abs({total}) % {count} <> 0 OR {whole} % {1 << bits} <> 0 AS BIGINT)"
        return f"CAST(CAST({whole} // {1 << bits} AS BIGINT) | {more} AS DOUBLE) * {1 << bits}"

    size = f"CASE WHEN {whole} < {1 << 62} THEN {rounded(0)} WHEN {whole} < {1 << 70} THEN {rounded(8)} ELSE {rounded(16)} END"
    return f"CASE WHEN {total} < 0 THEN -1 ELSE 1 END * ({size}) / {1 << 60}"


_AGG = {"avg": _exact_mean("{0}"), "max": "max({0})"}

ENGINE_PROFILE = f"""
WITH r AS (
  SELECT l_returnflag AS EngineType, l_linestatus AS Generalized_Weight,
         l_extendedprice / l_quantity AS rpm, l_quantity * 3 AS speed,
         l_extendedprice / 1000 AS maf, ln(l_extendedprice / 1000) AS log_maf,
         l_discount * 1000 AS engine_load, l_tax * 500 - 10 AS oat,
         (l_tax - 0.04::DOUBLE) * 400 AS stft1, (l_discount - 0.05::DOUBLE) * 200 AS ltft1,
         (l_tax - 0.04::DOUBLE) * -300 AS stft2, (l_discount - 0.05::DOUBLE) * -100 AS ltft2
  FROM lineitem
), e AS (
  SELECT *, maf / speed * 100.0::DOUBLE AS proxy,
         CASE WHEN speed > 100 AND engine_load > 60 THEN 'aggressive'
              WHEN speed BETWEEN 60 AND 100 AND engine_load BETWEEN 20 AND 60 THEN 'cruising'
              WHEN speed < 30 THEN 'urban'
              ELSE 'mixed' END AS driving_mode,
         CASE WHEN stft1 IS NOT NULL AND abs(stft1) > 10 THEN 1 ELSE 0 END AS anomaly
  FROM r
  WHERE rpm IS NOT NULL AND rpm > 0 AND speed IS NOT NULL AND speed > 0
)
SELECT EngineType, Generalized_Weight, driving_mode, COUNT(*) AS record_count,
       {", ".join(f"{half_up(_AGG[fn].format(col), d)} AS {name}" for name, fn, col, d in _ENGINE_AGGS)},
       CAST(SUM(anomaly) AS BIGINT) AS fuel_trim_anomaly_count
FROM e
GROUP BY EngineType, Generalized_Weight, driving_mode
"""


def _extremes(src: str) -> str:
    return f"""
WITH src AS ({src}),
band AS (
  SELECT quantile_cont(temp, 0.05) AS lo, quantile_cont(temp, 0.95) AS hi
  FROM src WHERE temp IS NOT NULL AND NOT isnan(temp)
),
kept AS (SELECT src.* FROM src, band WHERE src.temp >= band.lo AND src.temp <= band.hi),
daily AS (
  SELECT CAST(ts AS DATE) AS noted_date, out_in,
         round_even({_exact_mean("temp")} * 1000, 0) / 1000 AS temp
  FROM kept GROUP BY 1, 2
),
ranked AS (
  SELECT *,
         row_number() OVER (PARTITION BY year(noted_date) ORDER BY temp DESC, noted_date) AS hot,
         row_number() OVER (PARTITION BY year(noted_date) ORDER BY temp ASC, noted_date) AS cold
  FROM daily
)
SELECT noted_date, temp, out_in FROM ranked WHERE hot <= 5
UNION ALL
SELECT noted_date, temp, out_in FROM ranked WHERE cold <= 5
"""


_DIRTY_CUSTOMER = """CASE WHEN o_orderkey % 7 = 0 THEN NULL
            WHEN o_orderkey % 11 = 0 THEN 'Unknown'
            WHEN o_orderkey % 13 = 0 THEN ' unknown '
            {extra}
            ELSE CAST(o_custkey AS VARCHAR) END"""

_PLACEHOLDERS = "('unknown', 'none', 'nan', '', 'null')"

def money_mean(total: str, count: str) -> str:
    """Mean of two-decimal money to six decimals, half up, in whole numbers."""
    millionths = f"((CAST({total} * 100 AS HUGEINT) * 20000 + {count}) // (2 * {count}))"
    return f"CAST(CAST({millionths} // 1000000 AS VARCHAR) || '.' || lpad(CAST({millionths} % 1000000 AS VARCHAR), 6, '0') AS DECIMAL(22,6))"


ORACLE: dict[str, str] = {
    "customer_activity": f"""
SELECT o_custkey AS customer_id,
       COUNT(o_orderkey) AS total_orders,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_spent,
       {money_mean("SUM(CAST(o_totalprice AS DECIMAL(18,2)))", "COUNT(o_totalprice)")} AS avg_check,
       MAX(o_orderdate) AS last_order_timestamp
FROM orders
WHERE CAST(o_totalprice AS DECIMAL(18,2)) > 0
GROUP BY o_custkey
""",
    "supplier_performance": """
SELECT l_suppkey AS restaurant_id,
       COUNT(l_orderkey) AS total_orders,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_revenue,
       COUNT(CASE WHEN l_returnflag = 'N' THEN 1 END) AS successful_orders
FROM lineitem
WHERE CAST(l_extendedprice AS DECIMAL(18,2)) > 0
GROUP BY l_suppkey
""",
    "engine_profile": ENGINE_PROFILE,
    "daily_extremes": _extremes(
        "SELECT o_orderdate AS ts, o_totalprice AS temp, o_orderstatus AS out_in FROM orders WHERE o_orderstatus = 'F'"
    ),
    "daily_extremes_recent": _extremes(
        "SELECT ts, value AS temp, event_type AS out_in FROM events "
        "WHERE event_type = 'error' AND ts >= (SELECT max(ts) FROM events) - INTERVAL 3 DAY"
    ),
    "json_fields": """
SELECT event_id, CAST(json_extract(props, '$') AS VARCHAR) AS doc, json_extract_string(props, '$.k') AS k
FROM events WHERE props IS NOT NULL
""",
    "json_array_rows": """
SELECT conv_id, role AS name, CAST(NULL AS VARCHAR) AS species,
       CAST(to_json(string_split(text, chr(10))) AS VARCHAR) AS favFoods,
       CAST(turn AS VARCHAR) AS birthYear, text AS photo
FROM conversations
""",
    "xml_rows": """
SELECT CASE p_size % 5 WHEN 1 THEN '<' || p_name || '> 2' WHEN 2 THEN 'a <tag> ' || p_name ELSE p_name END AS name,
       p_brand || ' <b>& co</b> ' AS manufacturer,
       CAST(p_size AS DECIMAL(18,4)) AS serving_value, p_type AS serving_units,
       CAST(p_size * 10 AS INTEGER) AS calories_total,
       CAST(CASE WHEN p_size % 2 = 0 THEN p_size END AS INTEGER) AS calories_fat,
       CAST(p_retailprice AS DECIMAL(18,4)) AS total_fat,
       CAST(p_retailprice / 4 AS DECIMAL(18,4)) AS saturated_fat,
       CAST(p_size AS INTEGER) AS cholesterol, CAST(p_size * 5 AS INTEGER) AS sodium,
       CAST(p_retailprice / 10 AS DECIMAL(18,4)) AS carbs,
       CAST(NULL AS DECIMAL(18,4)) AS fiber,
       CAST(p_size / 2 AS DECIMAL(18,4)) AS protein,
       CAST(p_size AS INTEGER) AS vitamin_a, CAST(NULL AS INTEGER) AS vitamin_c,
       CAST(p_size + 1 AS INTEGER) AS calcium, CAST(NULL AS INTEGER) AS iron
FROM part
""",
    # A text flatten prints JSON numbers as doubles: decimals lose trailing
    # zeros (values are kept >= 0.001, where both engines print plainly).
    "nested_messages": """
SELECT CAST(o_orderkey AS VARCHAR) AS application_id,
       CAST(c_custkey AS VARCHAR) AS customer_id,
       n_name AS region,
       CAST(c_nationkey AS VARCHAR) AS age,
       CAST(CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS VARCHAR) AS income,
       c_mktsegment AS employment,
       CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS VARCHAR) AS loan_amount,
       CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '1999-01-01') AS VARCHAR) AS term_months,
       o_orderpriority AS loan_purpose,
       upper(substr(n_name, 1, 3)) AS currency,
       CAST(o_orderkey % 97 AS VARCHAR) AS score,
       substr(o_orderpriority, 1, 1) AS risk_level,
       CAST(CAST(CAST(abs(c_acctbal) / 100000 + 0.001::DOUBLE AS DECIMAL(10,4)) AS DOUBLE) AS VARCHAR) AS pd,
       CAST(CAST(CAST(o_totalprice / 1000000 + 0.001::DOUBLE AS DECIMAL(10,4)) AS DOUBLE) AS VARCHAR) AS lgd,
       o_orderstatus AS decision_status,
       strftime(o_orderdate, '%d.%m.%Y') AS submitted_at
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
""",
    "struct_rows": """
SELECT conv_id AS customer_id, role AS action_type,
       TIMESTAMP '2024-01-01 00:00:00' + turn * INTERVAL 1 MINUTE AS action_timestamp,
       CAST(0 AS BIGINT) AS rows_sharing_an_id
FROM conversations
UNION ALL
SELECT conv_id, role, TIMESTAMP '2024-01-01 00:00:00' + turn * INTERVAL 1 MINUTE, 0 FROM conversations WHERE turn = 2
""",
    "clean_orders": f"""
WITH d AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
         {_DIRTY_CUSTOMER.format(extra="WHEN o_orderkey % 31 = 0 THEN 'NULL'")} AS customer_id,
         CAST(o_custkey % 100 + 1 AS VARCHAR) AS restaurant_id,
         CAST(CASE WHEN o_orderkey % 17 = 0 THEN NULL
                   WHEN o_orderkey % 19 = 0 THEN -1
                   WHEN o_orderkey % 23 = 0 THEN NULL
                   WHEN o_orderkey % 37 = 0 THEN 0
                   WHEN o_orderkey % 41 = 0 THEN 0.004
                   WHEN o_orderkey % 43 = 0 THEN 99999999999999999.5
                   WHEN o_orderkey % 47 = 0 THEN 12.345
                   ELSE CAST(CAST(o_totalprice AS VARCHAR) AS DECIMAL(38,18)) END AS DECIMAL(38,18)) AS order_amount,
         COALESCE(CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus END, 'unknown') AS status,
         o_orderdate AS order_time
  FROM orders
)
SELECT * FROM d
WHERE order_amount > 0 AND customer_id IS NOT NULL AND lower(customer_id) NOT IN {_PLACEHOLDERS}
""",
    "typed_by_name": """
SELECT upper(lpad(printf('%x', o_orderkey), 24, '0')) AS document_id,
       CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
       CAST(CAST(o_totalprice AS VARCHAR) AS DECIMAL(38,18)) AS order_amount, o_orderstatus AS status,
       CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE o_orderdate END AS order_time,
       CAST(CAST(o_orderdate + INTERVAL 1 DAY AS DATE) AS TIMESTAMP) AS created_at
FROM orders
WHERE CAST(o_totalprice AS DECIMAL(18,2)) > 0
""",
    "adults_table": """
SELECT DISTINCT c_custkey AS PassengerId,
       CAST(c_nationkey % 2 AS INTEGER) AS Survived,
       CAST(c_nationkey % 3 + 1 AS INTEGER) AS Pclass,
       c_name AS Name,
       CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS Sex,
       abs(c_acctbal) / 100 AS Age,
       0 AS SibSp, 0 AS Parch,
       c_mktsegment AS Ticket,
       abs(c_acctbal) / 50 AS Fare,
       CAST(NULL AS VARCHAR) AS Cabin,
       substr(c_mktsegment, 1, 1) AS Embarked,
       upper(c_name) AS Name_Upper,
       CASE WHEN c_nationkey % 2 = 1 THEN 'Выжил' ELSE 'Погиб' END AS Survived_Label,
       CASE WHEN abs(c_acctbal) / 50 > 50 THEN 'Дорогой' ELSE 'Дешёвый' END AS Fare_Category
FROM customer
WHERE abs(c_acctbal) / 100 > 18 AND c_nationkey % 10 <> 0
""",
    "merged_schema": """
SELECT l_orderkey, l_linenumber, l_quantity,
       CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_discount END AS l_discount,
       CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_tax END AS l_tax
FROM lineitem
""",
    "year_partitions": """
SELECT CASE WHEN year(o_orderdate) IN (1996, 1997, 1998) THEN CAST(year(o_orderdate) AS VARCHAR)
            ELSE 'default' END AS order_year,
       COUNT(*) AS n_orders,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_price
FROM orders GROUP BY 1
""",
    "load_modes": """
SELECT * FROM orders UNION ALL SELECT NULL, NULL, 'N', 0.0, TIMESTAMP '1999-01-01', 'none'
""",
    "table_modes": """
SELECT mode, row_count, CAST(key_sum AS BIGINT) AS key_sum, CAST(amount AS DECIMAL(38,2)) AS amount FROM (
SELECT 'external' AS mode, COUNT(*) AS row_count, CAST(SUM(c_custkey) AS BIGINT) AS key_sum,
       CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS amount FROM customer
UNION ALL SELECT 'if_absent', COUNT(*), SUM(s_suppkey), SUM(CAST(s_acctbal AS DECIMAL(18,2))) FROM supplier
UNION ALL SELECT 'replace', COUNT(*), SUM(o_orderkey), SUM(CAST(o_totalprice AS DECIMAL(18,2))) FROM orders
)
""",
    "key_checks": """
SELECT 'orders_pk' AS check_name, CAST(COALESCE(SUM(n), 0) AS BIGINT) AS bad_rows
FROM (SELECT o_orderkey, COUNT(*) AS n FROM orders GROUP BY o_orderkey
      HAVING COUNT(*) > 1 OR o_orderkey IS NULL)
UNION ALL
SELECT 'lineitem_pk', CAST(COALESCE(SUM(n), 0) AS BIGINT)
FROM (SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber
      HAVING COUNT(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL)
UNION ALL
SELECT 'orders_customer_fk', COUNT(*) FROM orders o
WHERE o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey)
UNION ALL
SELECT 'lineitem_orders_fk', COUNT(*) FROM lineitem l
WHERE l_orderkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey)
UNION ALL
SELECT 'lineitem_part_fk', COUNT(*) FROM lineitem l
WHERE l_partkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey)
UNION ALL
SELECT 'lineitem_supplier_fk', COUNT(*) FROM lineitem l
WHERE l_suppkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey = l.l_suppkey)
UNION ALL
SELECT 'conversations_pk', CAST(COALESCE(SUM(n), 0) AS BIGINT)
FROM (SELECT conv_id, COUNT(*) AS n FROM conversations GROUP BY conv_id HAVING COUNT(*) > 1 OR conv_id IS NULL)
UNION ALL
SELECT 'customer_orders_fk', COUNT(*) FROM customer c
WHERE c_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey)
UNION ALL
SELECT 'documents_labels_fk', COUNT(*) FROM documents d
WHERE doc_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
""",
    "column_ops": """
SELECT c_custkey AS customer_id, n_name AS nation, r_name AS region, c_acctbal AS balance,
       c_mktsegment AS out_in, 'tpch' AS source, (SELECT COUNT(*) FROM customer) AS customers_total
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
ORDER BY region ASC, balance DESC, customer_id ASC
LIMIT 10
""",
    "stream_flat": """
SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, event_type,
       CAST(value AS VARCHAR) AS amount, json_extract_string(props, '$.k') AS k
FROM events
""",
    "stream_text": "SELECT conv_id, turn, text FROM conversations",
    "rejected_input": """
SELECT 'csv' AS source, 'read' AS outcome, count(*) AS n_rows, CAST(sum(event_id) AS BIGINT) AS key_sum FROM events WHERE event_id % 50 NOT IN (7, 8)
UNION ALL SELECT 'csv', 'event_id is not bigint', count(*), CAST(sum(event_id) AS BIGINT) FROM events WHERE event_id % 50 = 7
UNION ALL SELECT 'csv', 'more cells than the header', count(*), CAST(sum(event_id) AS BIGINT) FROM events WHERE event_id % 50 = 8
UNION ALL SELECT 'json', 'read', count(*), CAST(sum(c_custkey) AS BIGINT) FROM customer WHERE c_custkey % 20 NOT IN (3, 4)
UNION ALL SELECT 'json', 'not a JSON document', count(*), CAST(sum(c_custkey) AS BIGINT) FROM customer WHERE c_custkey % 20 = 3
UNION ALL SELECT 'json', 'does not fit the schema', count(*), CAST(sum(c_custkey) AS BIGINT) FROM customer WHERE c_custkey % 20 = 4
""",
    "wide_means": """
SELECT l_linenumber, coalesce(bool_or(odd AND l_linenumber = 3), false) AS is_nan, coalesce(bool_or(odd AND l_linenumber = 4), false) AS is_infinite,
       CASE WHEN NOT coalesce(bool_or(odd AND l_linenumber IN (3, 4)), false)
            THEN round(avg(CAST(l_quantity AS DOUBLE)) FILTER (NOT (odd AND l_linenumber = 5)), 6) END AS mean
FROM (SELECT *, l_orderkey % 100 = 1 AS odd FROM lineitem) GROUP BY l_linenumber
""",
    "dense_line_ids": """
SELECT row_number() OVER (ORDER BY l_orderkey % 2, l_orderkey, l_linenumber) AS line_id, l_orderkey, l_linenumber FROM lineitem
""",
    "changed_years": """
SELECT CAST(year(o_orderdate) AS VARCHAR) AS order_year, count(*) AS orders,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2)) + CASE WHEN year(o_orderdate) IN (1993, 1995) THEN 1 ELSE 0 END) AS DECIMAL(38,2)) AS total,
       year(o_orderdate) NOT IN (1993, 1995) AS same_files
FROM orders GROUP BY year(o_orderdate)
""",
    "file_increments": """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS orders, CAST(sum(o_custkey) AS BIGINT) AS customers, (SELECT count(*) FROM orders) AS loaded
FROM orders GROUP BY 1
""",
    "stream_batches": """
SELECT event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids, (SELECT count(*) FROM events) AS ledger_rows, CAST(2 AS BIGINT) AS batches
FROM events GROUP BY event_type
""",
    "csv_dates": "SELECT event_id, date_trunc('minute', ts) AS noted_date FROM events",
    "batch_flat": """
SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, event_type,
       CAST(value AS VARCHAR) AS amount, json_extract_string(props, '$.k') AS k
FROM events
""",
    "collection_rows": """
SELECT c_custkey AS customer_id, c_name AS name, o_orderkey AS order_id,
       CAST(o_totalprice AS DECIMAL(18,2)) AS order_amount, o_orderstatus AS status, o_orderdate AS order_time
FROM orders JOIN customer ON o_custkey = c_custkey
""",
    "message_values": """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment
FROM customer
""",
    "mart_preview": """
(SELECT 'customer_activity' AS mart, o_custkey AS mart_key, COUNT(o_orderkey) AS total_orders
 FROM orders WHERE CAST(o_totalprice AS DECIMAL(18,2)) > 0
 GROUP BY o_custkey ORDER BY o_custkey LIMIT 10)
UNION ALL
(SELECT 'restaurant_performance' AS mart, l_suppkey AS mart_key, COUNT(l_orderkey) AS total_orders
 FROM lineitem WHERE CAST(l_extendedprice AS DECIMAL(18,2)) > 0
 GROUP BY l_suppkey ORDER BY l_suppkey LIMIT 10)
""",
    "all_loads": f"""
WITH o AS (
  SELECT o_orderkey, {_DIRTY_CUSTOMER.format(extra="")} AS customer_id,
         CAST(o_custkey % 100 + 1 AS VARCHAR) AS restaurant_id,
         CAST(CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 19 = 0 THEN -1
              WHEN o_orderkey % 41 = 0 THEN 0.004 WHEN o_orderkey % 43 = 0 THEN 99999999999999999.5
              ELSE CAST(o_totalprice AS DECIMAL(38,6)) END AS DECIMAL(38,6)) AS amount
  FROM orders
), clean AS (
  SELECT * FROM o
  WHERE amount > 0 AND customer_id IS NOT NULL AND lower(customer_id) NOT IN {_PLACEHOLDERS}
), keys AS (
  SELECT *, TRY_CAST(customer_id AS BIGINT) AS customer_key, CAST(restaurant_id AS BIGINT) AS restaurant_key FROM clean
)
SELECT table_name, CAST(row_count AS BIGINT) AS row_count, CAST(key_sum AS BIGINT) AS key_sum, CAST(amount AS DECIMAL(38,6)) AS amount FROM (
SELECT 'restaurants' AS table_name, COUNT(*) AS row_count, CAST(SUM(s_suppkey) AS BIGINT) AS key_sum,
       CAST(SUM({half_up_decimal("s_acctbal / 2000 + 2.5::DOUBLE", 2)}) AS DECIMAL(38,6)) AS amount FROM supplier
UNION ALL SELECT 'customers', COUNT(*), SUM(c_custkey), NULL FROM customer
UNION ALL SELECT 'customer_actions', 2 * COUNT(*), 2 * SUM(c_custkey), NULL FROM customer
UNION ALL SELECT 'delivery_drivers', COUNT(*), SUM(p_partkey), SUM({half_up_decimal("p_retailprice / 400", 6)}) FROM part
UNION ALL SELECT 'orders', COUNT(*), SUM(o_orderkey), SUM(amount) FROM clean
UNION ALL SELECT 'orderreviews', COUNT(*), SUM(l_orderkey), NULL FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)
UNION ALL SELECT 'mart_customer_activity', COUNT(*), SUM(customer_key), SUM(total)
  FROM (SELECT customer_id, any_value(customer_key) AS customer_key, SUM(amount) AS total FROM keys GROUP BY customer_id)
UNION ALL SELECT 'mart_restaurant_performance', COUNT(*), SUM(restaurant_key), SUM(total)
  FROM (SELECT restaurant_id, any_value(restaurant_key) AS restaurant_key, SUM(amount) AS total FROM keys GROUP BY restaurant_id)
)
""",
}
