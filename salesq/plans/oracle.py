"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

The driver registers only base tables, so every statement starts with the
CTE chain for its input. The chains live here once and are prefixed.
Money and ratios are compared as DECIMAL(18,2) / rounded doubles so both
engines print identical values.
"""

from __future__ import annotations

# ------------------------------------------------------------------ raw_sales
RAW_SALES = """
raw_base AS (
  SELECT *,
         (l_orderkey*31 + l_linenumber*17 + l_partkey*7 + l_suppkey) % 1000 AS k,
         CAST(5.0 AS DOUBLE) + CAST(1.5 AS DOUBLE) * CAST(p_partkey % 25 AS DOUBLE) AS price
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
),
raw_adj AS (
  SELECT *,
         CASE WHEN k BETWEEN 117 AND 121 THEN price + CAST(0.5 AS DOUBLE)
              WHEN k BETWEEN 122 AND 125 THEN price + CAST(0.75 AS DOUBLE)
              WHEN k BETWEEN 126 AND 129 THEN price + CAST(60.0 AS DOUBLE)
              ELSE price END AS adj
  FROM raw_base
),
raw_sales AS (
  SELECT
    concat_ws('_', 'TXN', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
              CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR)) AS transaction_id,
    CASE WHEN k BETWEEN 130 AND 134 THEN NULL ELSE 'CUST_' || CAST(o_custkey AS VARCHAR) END AS customer_id,
    p_type AS category,
    CASE WHEN k < 97 OR k BETWEEN 117 AND 129 THEN NULL
         ELSE 'Item_' || CAST(p_partkey % 25 + 1 AS VARCHAR) || '_' || p_type END AS item,
    CASE WHEN k BETWEEN 48 AND 96 THEN NULL ELSE adj END AS price_per_unit,
    CASE WHEN k < 48 OR k BETWEEN 97 AND 106 THEN NULL ELSE l_quantity END AS quantity,
    CASE WHEN k < 48 OR k BETWEEN 107 AND 116 THEN NULL
         WHEN k BETWEEN 117 AND 129 THEN adj * l_quantity
         WHEN k BETWEEN 135 AND 139 THEN price * l_quantity + CAST(1.0 AS DOUBLE)
         ELSE price * l_quantity END AS total_spent,
    o_orderpriority AS payment_method,
    o_orderstatus AS location,
    CASE WHEN k BETWEEN 140 AND 144 THEN 'not-a-date'
         ELSE substr(CAST(o_orderdate AS VARCHAR), 1, 10) END AS transaction_date,
    CASE WHEN k % 3 = 0 THEN NULL WHEN l_discount > 0.05 THEN 'True' ELSE 'False' END AS discount_applied
  FROM raw_adj
)"""

# ------------------------------------------------------------------ clean chain
CLEAN = """
c_mark AS (
  SELECT *,
         CASE WHEN transaction_id IS NULL OR customer_id IS NULL THEN 'missing_key'
              WHEN quantity IS NULL AND total_spent IS NULL THEN 'unrecoverable' END AS drop_reason
  FROM raw_sales
),
c_live AS (SELECT * EXCLUDE (drop_reason) FROM c_mark WHERE drop_reason IS NULL),
c4 AS (
  SELECT * REPLACE (CASE WHEN discount_applied = 'True' THEN TRUE ELSE FALSE END AS discount_applied),
         discount_applied IS NULL AS f_disc
  FROM c_live
),
c5 AS (
  SELECT * REPLACE (CASE WHEN rec_p THEN round_even(total_spent / quantity * 100, 0) / 100
                         ELSE price_per_unit END AS price_per_unit)
  FROM (SELECT *, (price_per_unit IS NULL AND quantity IS NOT NULL AND total_spent IS NOT NULL
                   AND quantity > 0) AS rec_p FROM c4)
),
c6 AS (
  SELECT * REPLACE (CASE WHEN rec_q THEN round_even(total_spent / price_per_unit * 10, 0) / 10
                         ELSE quantity END AS quantity)
  FROM (SELECT *, (quantity IS NULL AND price_per_unit IS NOT NULL AND total_spent IS NOT NULL
                   AND price_per_unit > 0) AS rec_q FROM c5)
),
c7 AS (
  SELECT * REPLACE (CASE WHEN rec_t THEN round_even(price_per_unit * quantity * 100, 0) / 100
                         ELSE total_spent END AS total_spent)
  FROM (SELECT *, (total_spent IS NULL AND price_per_unit IS NOT NULL AND quantity IS NOT NULL) AS rec_t
        FROM c6)
),
c_catalog AS (
  SELECT category, item, avg(price_per_unit) AS mean_price FROM c7
  WHERE category IS NOT NULL AND item IS NOT NULL AND price_per_unit IS NOT NULL
  GROUP BY category, item
),
c_probe AS (
  SELECT DISTINCT category, price_per_unit FROM c7
  WHERE item IS NULL AND category IS NOT NULL AND price_per_unit IS NOT NULL
),
c_match AS (
  SELECT category, price_per_unit, item FROM (
    SELECT p.category, p.price_per_unit, c.item,
           row_number() OVER (PARTITION BY p.category, p.price_per_unit
                              ORDER BY abs(c.mean_price - p.price_per_unit), c.item) AS rn
    FROM c_probe p JOIN c_catalog c
      ON c.category = p.category
     AND abs(c.mean_price - p.price_per_unit) <= p.price_per_unit * CAST(0.15 AS DOUBLE)
  ) WHERE rn = 1
),
c9 AS (
  SELECT c7.* REPLACE (coalesce(c7.item, m.item) AS item),
         (c7.item IS NULL AND m.item IS NOT NULL) AS f_inferred
  FROM c7 LEFT JOIN c_match m
    ON c7.item IS NULL AND c7.category = m.category AND c7.price_per_unit = m.price_per_unit
),
c10 AS (SELECT * FROM c9 WHERE item IS NOT NULL),
c11 AS (SELECT * REPLACE (TRY_CAST(transaction_date AS DATE) AS transaction_date) FROM c10),
c12 AS (
  SELECT * REPLACE (CASE WHEN rw THEN round_even(price_per_unit * quantity * 100, 0) / 100
                         ELSE total_spent END AS total_spent)
  FROM (SELECT *, (price_per_unit IS NOT NULL AND quantity IS NOT NULL AND
                   (total_spent IS NULL OR
                    abs(total_spent - round_even(price_per_unit * quantity * 100, 0) / 100)
                      > CAST(0.01 AS DOUBLE))) AS rw
        FROM c11)
),
sales_clean AS (
  SELECT transaction_id, customer_id, category, item, price_per_unit, quantity, total_spent,
         payment_method, location, transaction_date, discount_applied
  FROM c12
)"""


def with_ctes(*parts: str, body: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n" + body


def raw(body: str) -> str:
    return with_ctes(RAW_SALES, body=body)


def cleaned(body: str) -> str:
    return with_ctes(RAW_SALES, CLEAN, body=body)

# ------------------------------------------------------------------ star from the clean table
STAR = """
n_cat AS (
  SELECT CAST(row_number() OVER (ORDER BY category_name) AS INTEGER) AS category_id, category_name
  FROM (SELECT DISTINCT category AS category_name FROM sales_clean WHERE category IS NOT NULL)
),
n_pm AS (
  SELECT CAST(row_number() OVER (ORDER BY payment_method_name) AS INTEGER) AS payment_method_id, payment_method_name
  FROM (SELECT DISTINCT payment_method AS payment_method_name FROM sales_clean WHERE payment_method IS NOT NULL)
),
n_loc AS (
  SELECT CAST(row_number() OVER (ORDER BY location_name) AS INTEGER) AS location_id, location_name
  FROM (SELECT DISTINCT location AS location_name FROM sales_clean WHERE location IS NOT NULL)
),
n_cust AS (
  SELECT customer_id,
         CASE WHEN strpos(customer_id, '_') > 0 THEN 'Customer_' || split_part(customer_id, '_', 2) END AS customer_name
  FROM (SELECT DISTINCT customer_id FROM sales_clean WHERE customer_id IS NOT NULL)
),
n_items AS (
  SELECT CAST(row_number() OVER (ORDER BY d.item_name, d.category_name NULLS FIRST, d.price_per_unit NULLS FIRST) AS INTEGER) AS item_id,
         d.item_name, d.price_per_unit, c.category_id
  FROM (SELECT DISTINCT item AS item_name, category AS category_name, price_per_unit FROM sales_clean
        WHERE item IS NOT NULL) d
  LEFT JOIN n_cat c ON d.category_name = c.category_name
),
n_fact AS (
  SELECT s.transaction_id, s.customer_id, i.item_id, p.payment_method_id, l.location_id, s.quantity,
         s.total_spent AS total_price, s.transaction_date, s.discount_applied
  FROM sales_clean s
  LEFT JOIN n_cat c ON s.category = c.category_name
  LEFT JOIN (SELECT item_name, category_id, max(item_id) AS item_id FROM n_items GROUP BY item_name, category_id) i
         ON s.item = i.item_name AND c.category_id = i.category_id
  LEFT JOIN n_pm p ON s.payment_method = p.payment_method_name
  LEFT JOIN n_loc l ON s.location = l.location_name
)"""


def starred(body: str) -> str:
    return with_ctes(RAW_SALES, CLEAN, STAR, body=body)


# ------------------------------------------------------------------ damaged star
_TID = ("concat_ws('_', 'TXN', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), "
        "CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR))")

DAMAGED = f"""
ds_cat AS (
  SELECT CAST(row_number() OVER (ORDER BY category_name) AS INTEGER) AS category_id, category_name
  FROM (SELECT DISTINCT p_type AS category_name FROM part)
),
ds_base AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_discount, o_custkey, o_orderstatus,
         o_orderdate, o_orderpriority, p_type, c.category_id,
         (l_orderkey*13 + l_linenumber*7 + l_partkey*3 + l_suppkey) % 1000 AS j,
         p_partkey % 25 AS g,
         CAST(5.0 AS DOUBLE) + CAST(1.5 AS DOUBLE) * CAST(p_partkey % 25 AS DOUBLE) AS price
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  JOIN ds_cat c ON p_type = c.category_name
),
ds_rows AS (SELECT * FROM ds_base UNION ALL SELECT * FROM ds_base WHERE j = 2),
ds_fact_j AS (
  SELECT
    CASE WHEN j = 0 THEN NULL WHEN j = 1 THEN {_TID} || '_' || repeat('x', 40) ELSE {_TID} END AS transaction_id,
    CASE WHEN j = 3 THEN 'CUST_missing' WHEN j = 4 THEN NULL ELSE 'CUST_' || CAST(o_custkey AS VARCHAR) END AS customer_id,
    CAST(CASE WHEN j = 5 THEN -1 ELSE (category_id - 1) * 25 + g + 1 END AS INTEGER) AS item_id,
    CAST(CASE WHEN j = 6 THEN 99 ELSE CAST(substr(o_orderpriority, 1, 1) AS INTEGER) END AS INTEGER) AS payment_method_id,
    CAST(CASE WHEN j = 7 THEN 99 WHEN o_orderstatus = 'F' THEN 1 WHEN o_orderstatus = 'O' THEN 2
              WHEN o_orderstatus = 'P' THEN 3 END AS INTEGER) AS location_id,
    CASE WHEN j = 8 THEN CAST(0.0 AS DOUBLE) WHEN j = 9 THEN CAST(-1.0 AS DOUBLE)
         WHEN j = 10 THEN CAST(5000.0 AS DOUBLE) ELSE l_quantity END AS quantity,
    CASE WHEN j = 11 THEN price * l_quantity + CAST(1.0 AS DOUBLE) WHEN j = 12 THEN CAST(100000001.0 AS DOUBLE)
         WHEN j = 13 THEN CAST(10.005 AS DOUBLE) WHEN j = 8 THEN CAST(0.0 AS DOUBLE) WHEN j = 9 THEN -price
         WHEN j = 10 THEN CAST(5000.0 AS DOUBLE) * price ELSE price * l_quantity END AS total_price,
    CASE WHEN j = 14 THEN DATE '2030-01-01' ELSE CAST(o_orderdate AS DATE) END AS transaction_date,
    l_discount > 0.05 AS discount_applied,
    j
  FROM ds_rows
),
ds_fact AS (SELECT * EXCLUDE (j) FROM ds_fact_j),
ds_items AS (
  SELECT CAST((c.category_id - 1) * 25 + g + 1 AS INTEGER) AS item_id,
         'Item_' || CAST(g + 1 AS VARCHAR) || '_' || p_type AS item_name,
         CAST(5.0 AS DOUBLE) + CAST(1.5 AS DOUBLE) * CAST(g AS DOUBLE) AS price_per_unit,
         CAST(c.category_id AS INTEGER) AS category_id
  FROM (SELECT DISTINCT p_type, p_partkey % 25 AS g FROM part) q JOIN ds_cat c ON q.p_type = c.category_name
  UNION ALL SELECT 1000000, 'Item_lost', CAST(9.5 AS DOUBLE), 9999
),
ds_customers AS (
  SELECT 'CUST_' || CAST(c_custkey AS VARCHAR) AS customer_id FROM customer
  UNION ALL SELECT 'CUST_' || CAST(c_custkey AS VARCHAR) FROM customer WHERE c_custkey < 5
  UNION ALL SELECT 'CUST_' || repeat('L', 35)
),
ds_pm AS (
  SELECT CAST(substr(payment_method_name, 1, 1) AS INTEGER) AS payment_method_id, payment_method_name
  FROM (SELECT DISTINCT o_orderpriority AS payment_method_name FROM orders)
),
ds_loc AS (
  SELECT CAST(CASE WHEN location_name = 'F' THEN 1 WHEN location_name = 'O' THEN 2
                   WHEN location_name = 'P' THEN 3 END AS INTEGER) AS location_id, location_name
  FROM (SELECT DISTINCT o_orderstatus AS location_name FROM orders)
),
ds_docs AS (
  SELECT transaction_id AS _id, customer_id, item_id, payment_method_id, location_id,
         CASE WHEN j = 21 THEN quantity + 1 ELSE quantity END AS quantity,
         CASE WHEN j = 22 THEN total_price + CAST(0.02 AS DOUBLE) ELSE total_price END AS total_price,
         CAST(CASE WHEN j = 23 THEN transaction_date + 1 ELSE transaction_date END AS TIMESTAMP) AS transaction_date,
         coalesce(discount_applied, FALSE) AS discount_applied
  FROM ds_fact_j WHERE j <> 20
)"""


def damaged(body: str) -> str:
    return with_ctes(DAMAGED, body=body)
