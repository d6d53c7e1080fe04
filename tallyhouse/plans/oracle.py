"""The registered queries as plain SQL over the same tables, for comparison."""

from tallyhouse.operators import synth
from tallyhouse.schemas import CONTRACT

# The retail view of ``retail.Retail``.
_VIEW = """
WITH items AS (
  SELECT *, CAST(l_quantity AS INTEGER) AS q, CAST(l_extendedprice AS DECIMAL(18,2)) AS total
  FROM lineitem
),
fact AS (
  SELECT o_custkey AS customer_id,
         CAST(s_nationkey AS BIGINT) AS store_id,
         p_name AS product_name,
         CAST(l_shipdate AS DATE) AS sales_date,
         l_suppkey AS sales_person_id,
         CAST(CAST((2 * CAST(total * 100 AS BIGINT) + q) // (2 * q) AS DECIMAL(18,0))
              * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS price,
         q AS quantity,
         total AS total_cost,
         concat_ws(', ', l_returnflag, l_linestatus) AS additional_columns,
         CAST(date_trunc('month', l_shipdate) AS DATE) AS sales_month,
         l_orderkey, l_linenumber, l_returnflag, l_linestatus
  FROM items
  JOIN orders ON o_orderkey = l_orderkey
  LEFT JOIN supplier ON s_suppkey = l_suppkey
  LEFT JOIN part ON p_partkey = l_partkey
),
customers AS (
  SELECT c_custkey AS customer_id, c_name AS first_name, c_mktsegment AS last_name,
         'nation ' || c_nationkey AS address, CAST(c_nationkey AS VARCHAR) AS pincode,
         CAST(c_custkey AS VARCHAR) AS phone_number
  FROM customer
),
stores AS (
  SELECT CAST(n_nationkey AS BIGINT) AS id, 'manager of ' || n_name AS store_manager_name
  FROM nation
),
staff AS (
  SELECT s_suppkey AS id, s_name AS first_name, 'of nation ' || s_nationkey AS last_name,
         CAST(s_nationkey AS BIGINT) AS manager_id,
         CASE WHEN s_acctbal < 0 THEN 'Y' ELSE 'N' END AS is_manager,
         'nation ' || s_nationkey AS address, CAST(s_nationkey AS VARCHAR) AS pincode
  FROM supplier
),
enriched AS (
  SELECT f.customer_id, c.first_name, c.last_name, c.address, c.pincode, c.phone_number,
         f.store_id, s.store_manager_name, f.sales_person_id,
         p.first_name AS sales_person_first_name, p.last_name AS sales_person_last_name,
         p.manager_id, p.is_manager, p.address AS sales_person_address,
         p.pincode AS sales_person_pincode, f.sales_date, f.sales_month AS month_start,
         f.total_cost, f.additional_columns
  FROM fact f
  JOIN customers c ON f.customer_id = c.customer_id
  JOIN stores s ON f.store_id = s.id
  JOIN staff p ON f.sales_person_id = p.id
),
customer_totals AS (
  SELECT customer_id, month_start AS sales_date_month, sum(total_cost) AS total
  FROM enriched GROUP BY ALL
),
person_totals AS (
  SELECT store_id, sales_person_id, month_start AS sales_month, sum(total_cost) AS total
  FROM enriched GROUP BY ALL
)
"""

_FACT = """
customer_id, store_id, product_name, sales_date, sales_person_id,
CAST(price AS DOUBLE) AS price, quantity, CAST(total_cost AS DOUBLE) AS total_cost
"""

_FACT_ALL = _FACT + ", additional_columns"

_LINE = """
f.customer_id, f.store_id, f.sales_date, f.sales_person_id,
CAST(f.total_cost AS DOUBLE) AS total_cost, f.additional_columns
"""

_CUSTOMER_MART = """
SELECT customer_id, first_name || ' ' || last_name AS full_name, address, phone_number,
       month_start AS sales_date_month, CAST(sum(total_cost) AS DOUBLE) AS total_sales
FROM enriched GROUP BY ALL
"""

_LATEST_EVENT = """
SELECT user_id AS file_name, event_type AS status, event_id
FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
"""

_ORDERS = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority
FROM orders
"""


def _listed(values) -> str:
    return "[" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + "]"


def _headers() -> str:
    lacking = [c for c in CONTRACT if c != "store_id"] + ["payment_mode"]
    spelled = ["Customer_ID", *CONTRACT[1:], "note"]
    return f"""
WITH files AS (
  SELECT 'sales_' || o_orderkey || '.csv' AS file,
         CASE o_orderstatus WHEN 'F' THEN {_listed(lacking)} WHEN 'O' THEN {_listed(spelled)}
              ELSE {_listed(CONTRACT)} END AS names
  FROM orders
),
present AS (SELECT file, unnest(names) AS name FROM files),
required AS (SELECT unnest({_listed(CONTRACT)}) AS name)
"""


def _draw(factor: int, shift: int, choices: int) -> str:
    return f"(((k % 1000003) * {factor} + (k % 1000033) * {shift + 1}) % 999983 % {choices})"


def _synth() -> str:
    days = (synth.LAST_DAY - synth.FIRST_DAY).days + 1
    names = _listed([name for name, _ in synth.PRODUCTS])
    prices = _listed([price for _, price in synth.PRODUCTS])
    return f"""
SELECT o_orderkey, customer_id, store_id, product_name, sales_date, sales_person_id,
       price, quantity, price * quantity AS total_cost, payment_mode
FROM (
  SELECT k AS o_orderkey,
         {_draw(3571, 3, synth.CUSTOMERS)} + 1 AS customer_id,
         CAST({_listed(synth.STORES)}[{_draw(7919, 11, 3)} + 1] AS BIGINT) AS store_id,
         {names}[{_draw(6101, 29, 8)} + 1] AS product_name,
         DATE '{synth.FIRST_DAY}' + CAST({_draw(5477, 17, days)} AS INTEGER) AS sales_date,
         {_draw(7919, 11, 3)} * 3 + {_draw(8923, 7, 3)} + 1 AS sales_person_id,
         CAST({prices}[{_draw(6101, 29, 8)} + 1] AS DOUBLE) AS price,
         CAST({_draw(4507, 5, synth.MOST_PIECES)} + 1 AS INTEGER) AS quantity,
         {_listed(synth.PAYMENT_MODES)}[{_draw(2741, 13, 2)} + 1] AS payment_mode
  FROM (SELECT o_orderkey AS k FROM orders)
)
"""


ORACLES: dict[str, str] = {
    "salesperson_incentive": _VIEW
    + """,
totals AS (
  SELECT store_id, sales_person_id,
         sales_person_first_name || ' ' || sales_person_last_name AS full_name,
         month_start AS sales_month, sum(total_cost) AS total
  FROM enriched GROUP BY ALL
)
SELECT store_id, sales_person_id, full_name, sales_month, CAST(total AS DOUBLE) AS total_sales,
       CAST(CASE WHEN rank() OVER (PARTITION BY store_id, sales_month ORDER BY total DESC) = 1
                 THEN round(total * CAST(0.01 AS DECIMAL(3,2)), 2) ELSE 0 END AS DOUBLE) AS incentive
FROM totals
""",
    "customer_month_mart": _VIEW + _CUSTOMER_MART,
    "cumulative_mart": _VIEW + _CUSTOMER_MART,
    "corrected_drop": _VIEW + _CUSTOMER_MART,
    "touched_month_publish": _VIEW + _CUSTOMER_MART,
    "customer_lapse": _VIEW
    + """, spans AS (
  SELECT customer_id, min(sales_date_month) AS first,
         (SELECT max(sales_date_month) FROM customer_totals) AS last
  FROM customer_totals GROUP BY customer_id
), spine AS (
  SELECT customer_id, CAST(unnest(generate_series(first, last, INTERVAL 1 MONTH)) AS DATE) AS sales_date_month
  FROM spans
), filled AS (
  SELECT customer_id, sales_date_month, coalesce(total, 0) AS total,
         CASE WHEN total IS NOT NULL THEN sales_date_month END AS seen
  FROM spine LEFT JOIN customer_totals USING (customer_id, sales_date_month)
), told AS (
  SELECT *, lag(total) OVER w AS previous, max(seen) OVER w AS last_seen
  FROM filled WINDOW w AS (PARTITION BY customer_id ORDER BY sales_date_month)
)
SELECT customer_id, sales_date_month, CAST(total AS DOUBLE) AS total_sales,
       CAST(previous AS DOUBLE) AS previous_total, coalesce(total < previous, FALSE) AS declining,
       CAST(datediff('month', last_seen, sales_date_month) AS INTEGER) AS months_since
FROM told
""",
    "mixed_layout_scan": _VIEW + f"SELECT {_FACT}, l_linestatus AS additional_columns FROM fact",
    "field_errors": _VIEW
    + """, dropped AS (
  SELECT *, l_returnflag = 'R' AS no_number, l_linenumber = 3 AS finer, l_linenumber = 5 AS no_date,
         CASE WHEN l_linenumber = 3 THEN price + 0.01 ELSE price END AS read_price
  FROM fact
), found AS (
  SELECT 'quantity' AS "column", 'q' || quantity AS value, 'int' AS expected FROM dropped WHERE no_number
  UNION ALL
  SELECT 'price', price || '5', 'at most two decimals' FROM dropped WHERE finer
  UNION ALL
  SELECT 'sales_date', strftime(sales_date, '%d/%m/%Y'), 'date' FROM dropped WHERE no_date
  UNION ALL
  SELECT 'total_cost', CAST(total_cost AS VARCHAR), 'price times quantity' FROM dropped
  WHERE NOT no_number AND read_price * quantity <> total_cost
)
SELECT "column", value, expected, count(*) AS n_rows FROM found GROUP BY ALL
""",
    "salesperson_month_total": _VIEW
    + """
SELECT store_id, sales_person_id, sales_month, CAST(total AS DOUBLE) AS total_sales
FROM person_totals
""",
    "salesperson_rank": _VIEW
    + """
SELECT store_id, sales_person_id, sales_month, CAST(total AS DOUBLE) AS total_sales,
       CAST(rank() OVER (PARTITION BY store_id, sales_month ORDER BY total DESC) AS INTEGER) AS rnk
FROM person_totals
""",
    "top_performer": _VIEW
    + """
SELECT store_id, sales_person_id, sales_month, CAST(total AS DOUBLE) AS total_sales
FROM person_totals
QUALIFY rank() OVER (PARTITION BY store_id, sales_month ORDER BY total DESC) = 1
""",
    "customer_spend_trend": _VIEW
    + """
SELECT customer_id, sales_date_month, CAST(total AS DOUBLE) AS total_sales,
       CAST(previous AS DOUBLE) AS previous_total, CAST(total - previous AS DOUBLE) AS change,
       coalesce(total < previous, FALSE) AS declining
FROM (
  SELECT *, lag(total) OVER (PARTITION BY customer_id ORDER BY sales_date_month) AS previous
  FROM customer_totals
)
""",
    "customer_spend_segment": _VIEW
    + """
SELECT customer_id, sales_date_month, CAST(total AS DOUBLE) AS total_sales,
       CAST(ntile(4) OVER (PARTITION BY sales_date_month ORDER BY total, customer_id) AS INTEGER)
         AS segment
FROM customer_totals
""",
    "window_sum_customer": _VIEW
    + """
SELECT customer_id, sales_month AS sales_date_month, CAST(total_cost AS DOUBLE) AS total_cost,
       CAST(sum(total_cost) OVER (PARTITION BY customer_id, sales_month) AS DOUBLE) AS total_sales
FROM fact
""",
    "window_sum_salesperson": _VIEW
    + """
SELECT store_id, sales_person_id, sales_month, CAST(total_cost AS DOUBLE) AS total_cost,
       CAST(sum(total_cost) OVER (PARTITION BY store_id, sales_person_id, sales_month) AS DOUBLE)
         AS total_sales
FROM fact
""",
    "distinct_rows": _VIEW + "SELECT DISTINCT customer_id, store_id FROM fact",
    "join_customer": _VIEW
    + f"""
SELECT {_LINE}, c.first_name, c.last_name, c.address, c.pincode, c.phone_number
FROM fact f JOIN customers c ON f.customer_id = c.customer_id
""",
    "join_store": _VIEW
    + f"SELECT {_LINE}, s.store_manager_name FROM fact f JOIN stores s ON f.store_id = s.id",
    "join_salesperson": _VIEW
    + f"""
SELECT {_LINE}, p.first_name AS sales_person_first_name, p.last_name AS sales_person_last_name,
       p.manager_id, p.is_manager, p.address AS sales_person_address,
       p.pincode AS sales_person_pincode
FROM fact f JOIN staff p ON f.sales_person_id = p.id
""",
    "join_product": _VIEW
    + """,
by_name AS (
  SELECT p_name, p_partkey AS product_id, CAST(p_retailprice AS DECIMAL(10,2)) AS current_price
  FROM part QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) = 1
)
SELECT customer_id, product_name, sales_date, CAST(total_cost AS DOUBLE) AS total_cost,
       product_id, CAST(current_price AS DOUBLE) AS current_price
FROM fact LEFT JOIN by_name ON product_name = p_name
""",
    "enrich_sales": _VIEW
    + "SELECT * EXCLUDE (month_start) REPLACE (CAST(total_cost AS DOUBLE) AS total_cost) FROM enriched",
    "orphan_sales": _VIEW
    + """
SELECT customer_id, store_id, sales_person_id, sales_date, CAST(total_cost AS DOUBLE) AS total_cost
FROM fact f
WHERE NOT EXISTS (
  SELECT 1 FROM customers c WHERE c.customer_id = f.customer_id AND c.last_name = 'HOUSEHOLD'
)
""",
    "project_fact": _VIEW + f"SELECT {_FACT_ALL} FROM fact",
    "empty_seed_union": _VIEW + f"SELECT {_FACT_ALL} FROM fact",
    "parquet_roundtrip": _VIEW + f"SELECT {_FACT_ALL} FROM fact",
    "versioned_publish": _VIEW + f"SELECT {_FACT_ALL} FROM fact",
    "preview_limit": _VIEW
    + f"""
SELECT {_FACT_ALL} FROM (
  SELECT * FROM fact
  ORDER BY customer_id, store_id, product_name, sales_date, sales_person_id, price, quantity,
           total_cost, additional_columns
  LIMIT 20
)
""",
    "incremental_ingest": _VIEW
    + f"""
SELECT {_FACT}, CASE WHEN l_returnflag = 'A' THEN NULL ELSE l_linestatus END AS additional_columns
FROM fact
""",
    "streamed_ingest": _VIEW
    + f"""
SELECT {_FACT}, CASE WHEN l_returnflag = 'A' THEN NULL ELSE l_linestatus END AS additional_columns
FROM fact
""",
    "quarantine_rows": _VIEW
    + f"""
SELECT {_FACT_ALL},
       concat_ws('; ', CASE WHEN quantity > 40 THEN 'more than 40 pieces' END,
                 CASE WHEN customer_id IS NULL THEN 'no customer' END,
                 CASE WHEN l_returnflag = 'R' THEN 'returned' END) AS reason
FROM fact
WHERE quantity > 40 OR customer_id IS NULL OR l_returnflag = 'R'
""",
    "customer_rows": _VIEW
    + """
SELECT customer_id, first_name, last_name, address, pincode, phone_number, sales_date,
       CAST(total_cost AS DOUBLE) AS total_cost
FROM enriched
""",
    "sales_rows": _VIEW
    + """
SELECT store_id, sales_person_id, sales_person_first_name, sales_person_last_name,
       store_manager_name, manager_id, is_manager, sales_person_address, sales_person_pincode,
       sales_date, CAST(total_cost AS DOUBLE) AS total_cost,
       strftime(sales_date, '%Y-%m') AS sales_month
FROM enriched
""",
    "partitioned_write_prune": _VIEW
    + """
SELECT strftime(sales_date, '%Y-%m') AS sales_month, store_id, count(*) AS n_sales,
       CAST(sum(total_cost) AS DOUBLE) AS total_sales
FROM enriched WHERE strftime(sales_date, '%Y-%m') = '1995-03' GROUP BY ALL
""",
    "total_cost_check": _VIEW
    + """
SELECT l_orderkey, l_linenumber, CAST(price AS DOUBLE) AS price, quantity,
       CAST(total_cost AS DOUBLE) AS total_cost, CAST(price * quantity AS DOUBLE) AS expected_cost,
       price * quantity = total_cost AS matches
FROM fact
""",
    "month_bucket": """
SELECT o_orderkey,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS month_from_text,
       strftime(o_orderdate, '%Y-%m') AS month_label
FROM orders
""",
    "drop_unknown_noop": "SELECT p_partkey, p_name, p_brand, p_type, p_retailprice FROM part",
    "fold_extra_columns": """
SELECT o_orderkey,
       CASE WHEN o_orderstatus <> 'F' THEN
         concat_ws(', ', CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END,
                         CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END)
       END AS additional_columns
FROM orders
""",
    "full_name_concat": """
SELECT 'customer' AS role, c_custkey AS id,
       c_name || ' ' || CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_mktsegment END AS full_name
FROM customer
UNION ALL
SELECT 'staff', s_suppkey, s_name || ' of nation ' || s_nationkey
FROM supplier
""",
    "implicit_casts": """
SELECT p_partkey, measure, note, strftime(DATE '2023-03-03' + p_size, '%Y-%m') AS month,
       CASE WHEN measure > 20 THEN measure * CAST(0.5 AS DOUBLE) ELSE 0 END AS share
FROM (
  SELECT p_partkey, p_size, CAST(p_size AS DOUBLE) AS measure, NULL AS note FROM part
  UNION ALL
  SELECT p_partkey, p_size, p_retailprice, p_brand FROM part
)
""",
    "rebase_path": r"""
SELECT page_id, regexp_replace(url, '^[A-Za-z0-9+.-]+://[^/]*/?', '') AS url_key,
       split_part(url, '/', -1) AS base_name,
       CASE WHEN starts_with(url, 'https://') THEN substr(url, 9) ELSE url END AS without_scheme
FROM pages
""",
    "union_by_name": """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN floor(o_totalprice) ELSE o_totalprice END
         AS amount, o_orderpriority
FROM orders
""",
    "schema_missing_columns": _headers()
    + """
SELECT f.file, r.name AS missing_column
FROM files f CROSS JOIN required r
WHERE NOT EXISTS (SELECT 1 FROM present p WHERE p.file = f.file AND p.name = r.name)
""",
    "schema_extra_columns": _headers()
    + """
SELECT p.file, p.name AS extra_column FROM present p
WHERE p.name NOT IN (SELECT name FROM required)
""",
    "split_by_extension": """
SELECT 'landing/sales_' || o_orderkey || CASE o_orderstatus WHEN 'F' THEN '.csv' ELSE '.CSV' END
         AS path, o_orderstatus = 'F' AS is_csv
FROM orders WHERE o_orderstatus IN ('F', 'O')
""",
    "synth_sales": _synth(),
    "ledger_latest_state": _LATEST_EVENT,
    "ledger_after_compaction": _LATEST_EVENT,
    "ledger_unfinished": f"""
SELECT file_name FROM ({_LATEST_EVENT})
WHERE status = 'error' AND file_name IN (SELECT c_custkey FROM customer)
""",
    "landing_inventory": """
SELECT strftime(o_orderdate, '%Y-%m') AS month,
       CAST(sum(length(CAST(o_orderkey AS VARCHAR)) + length(CAST(o_custkey AS VARCHAR))
                + length(o_orderstatus) + length(o_orderpriority) + 10 + 6
                + length(CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS VARCHAR))) AS BIGINT)
         AS total_bytes
FROM orders GROUP BY ALL
""",
    "header_signature": f"""
SELECT DISTINCT
       CASE l_returnflag WHEN 'A' THEN 'plain' WHEN 'N' THEN 'extra' ELSE 'turned' END AS layout,
       CASE l_returnflag WHEN 'A' THEN '{",".join(CONTRACT)}'
            WHEN 'N' THEN '{",".join([*CONTRACT, "payment_mode"])}'
            ELSE '{",".join(["payment_mode", *reversed(CONTRACT)])}' END AS signature,
       CASE l_returnflag WHEN 'A' THEN 8 ELSE 9 END AS n_columns
FROM lineitem
""",
    "csv_typed_scan": _ORDERS,
    "json_typed_scan": _ORDERS,
}

ORACLES["mart_after_dimension_change"] = ORACLES["salesperson_incentive"]
ORACLES["bucketed_customer_join"] = ORACLES["join_customer"]
