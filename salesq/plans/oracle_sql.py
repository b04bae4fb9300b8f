"""name -> DuckDB SQL for the registered queries."""

from __future__ import annotations

from salesq.plans.oracle import cleaned, with_ctes, RAW_SALES, CLEAN

ORACLE: dict[str, str] = {}

_C1 = """c1 AS (SELECT *, (transaction_id IS NULL OR customer_id IS NULL) AS gone FROM raw_sales)"""

ORACLE["clean_drop_critical"] = with_ctes(RAW_SALES, _C1, body="""
SELECT count(*) AS rows_in, CAST(count_if(gone) AS BIGINT) AS rows_dropped,
       CAST(count_if(NOT gone) AS BIGINT) AS rows_out FROM c1""")

ORACLE["clean_drop_unrecoverable"] = with_ctes(RAW_SALES, _C1, body="""
SELECT count(*) AS rows_in, CAST(count_if(quantity IS NULL AND total_spent IS NULL) AS BIGINT) AS rows_dropped,
       CAST(count_if(NOT (quantity IS NULL AND total_spent IS NULL)) AS BIGINT) AS rows_out
FROM c1 WHERE NOT gone""")

ORACLE["clean_quarantine"] = cleaned("""
SELECT transaction_id, customer_id, category, item, price_per_unit, quantity, total_spent,
       payment_method, location, transaction_date, discount_applied, drop_reason,
       CASE WHEN drop_reason = 'unrecoverable' THEN price_per_unit IS NOT NULL END AS has_price,
       CASE WHEN drop_reason = 'unrecoverable' THEN item IS NOT NULL END AS has_item,
       CASE WHEN drop_reason = 'unrecoverable' THEN category IS NOT NULL END AS has_category
FROM c_mark WHERE drop_reason IS NOT NULL""")

ORACLE["clean_discount"] = cleaned("SELECT transaction_id, discount_applied, f_disc AS imputed FROM c4")
ORACLE["clean_recover_price"] = cleaned("SELECT transaction_id, price_per_unit FROM c7 WHERE rec_p")
ORACLE["clean_recover_quantity"] = cleaned("SELECT transaction_id, quantity FROM c7 WHERE rec_q")
ORACLE["clean_recover_total"] = cleaned("SELECT transaction_id, total_spent FROM c7 WHERE rec_t")
ORACLE["item_catalog"] = cleaned("SELECT category, item, round(mean_price, 6) AS mean_price FROM c_catalog")
ORACLE["clean_infer_item"] = cleaned(
    "SELECT transaction_id, category, price_per_unit, item FROM c9 WHERE f_inferred")
ORACLE["clean_drop_unmatched"] = cleaned("""
SELECT count(*) AS rows_in, CAST(count_if(item IS NULL) AS BIGINT) AS rows_dropped,
       CAST(count_if(item IS NOT NULL) AS BIGINT) AS rows_out FROM c9""")
ORACLE["clean_dates"] = cleaned("SELECT transaction_id, transaction_date FROM sales_clean")
ORACLE["clean_consistency"] = cleaned("SELECT transaction_id, total_spent FROM c12 WHERE rw")
ORACLE["clean_completeness"] = cleaned("""
SELECT column_name, missing_count FROM (
  SELECT 'transaction_id' AS column_name, CAST(count_if(transaction_id IS NULL) AS BIGINT) AS missing_count, 1 AS o FROM sales_clean
  UNION ALL SELECT 'category', CAST(count_if(category IS NULL) AS BIGINT), 2 FROM sales_clean
  UNION ALL SELECT 'item', CAST(count_if(item IS NULL) AS BIGINT), 3 FROM sales_clean
  UNION ALL SELECT 'price_per_unit', CAST(count_if(price_per_unit IS NULL) AS BIGINT), 4 FROM sales_clean
  UNION ALL SELECT 'quantity', CAST(count_if(quantity IS NULL) AS BIGINT), 5 FROM sales_clean
  UNION ALL SELECT 'total_spent', CAST(count_if(total_spent IS NULL) AS BIGINT), 6 FROM sales_clean)""")

_NULLS = lambda p: " + ".join(
    f"CAST({p}{c} IS NULL AS INTEGER)" for c in [
        "transaction_id", "customer_id", "category", "item", "price_per_unit", "quantity",
        "total_spent", "payment_method", "location", "transaction_date", "discount_applied"])

ORACLE["cleaning_report"] = cleaned(f"""
SELECT r.initial_rows, r.dropped_missing_key, r.dropped_unrecoverable,
       CAST(u.n AS BIGINT) AS dropped_unmatched_item,
       CAST(r.dropped_missing_key + r.dropped_unrecoverable + u.n AS BIGINT) AS rows_dropped,
       CAST(f.final_rows AS BIGINT) AS final_rows,
       CAST(l.prices AS BIGINT) AS prices_recovered, CAST(l.qtys AS BIGINT) AS quantities_recovered,
       CAST(l.totals AS BIGINT) AS totals_recovered, CAST(i.items AS BIGINT) AS items_recovered,
       CAST(l.discs AS BIGINT) AS discounts_imputed, CAST(f.rewritten AS BIGINT) AS totals_rewritten,
       CAST(r.nulls_before AS BIGINT) AS nulls_before, CAST(f.nulls_after AS BIGINT) AS nulls_after,
       round_even(f.final_rows * CAST(100.0 AS DOUBLE) / r.initial_rows * 10, 0) / 10 AS retention_pct
FROM (SELECT count(*) AS initial_rows,
             CAST(count_if(drop_reason = 'missing_key') AS BIGINT) AS dropped_missing_key,
             CAST(count_if(drop_reason = 'unrecoverable') AS BIGINT) AS dropped_unrecoverable,
             sum({_NULLS('')}) AS nulls_before FROM c_mark) r,
     (SELECT count_if(rec_p) AS prices, count_if(rec_q) AS qtys, count_if(rec_t) AS totals,
             count_if(f_disc) AS discs FROM c7) l,
     (SELECT count_if(f_inferred) AS items, count_if(item IS NULL) AS n FROM c9) i,
     (SELECT count_if(item IS NULL) AS n FROM c9) u,
     (SELECT count(*) AS final_rows, count_if(rw) AS rewritten, coalesce(sum({_NULLS('')}), 0) AS nulls_after
      FROM c12) f""")

ORACLE["sales_clean"] = cleaned("SELECT * FROM sales_clean")

ORACLE["stats_clean_business"] = cleaned("""
SELECT count(*) AS rows, CAST(sum(CAST(total_spent AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total_revenue,
       sum(quantity) AS total_quantity, count(DISTINCT customer_id) AS distinct_customers
FROM sales_clean""")

# ------------------------------------------------------------------ star, documents, stats
from salesq.plans.oracle import damaged, starred, with_ctes as _w, DAMAGED, STAR  # noqa: E402

ORACLE["dim_categories"] = starred("SELECT * FROM n_cat")
ORACLE["dim_customers"] = starred("SELECT * FROM n_cust")
ORACLE["dim_payment_methods"] = starred("SELECT * FROM n_pm")
ORACLE["dim_locations"] = starred("SELECT * FROM n_loc")
ORACLE["dim_items"] = starred("SELECT * FROM n_items")
ORACLE["fact_transactions"] = starred("SELECT * FROM n_fact")
ORACLE["denorm_flat"] = starred("""
SELECT t.transaction_id, cu.customer_name, c.category_name, i.item_name, i.price_per_unit, t.quantity,
       t.total_price, p.payment_method_name, l.location_name, t.transaction_date, t.discount_applied
FROM n_fact t
LEFT JOIN n_cust cu ON t.customer_id = cu.customer_id
LEFT JOIN n_items i ON t.item_id = i.item_id
LEFT JOIN n_cat c ON i.category_id = c.category_id
LEFT JOIN n_pm p ON t.payment_method_id = p.payment_method_id
LEFT JOIN n_loc l ON t.location_id = l.location_id""")

ORACLE["docs_categories"] = starred("SELECT category_id AS _id, category_name FROM n_cat")
ORACLE["docs_locations"] = starred("SELECT location_id AS _id, location_name FROM n_loc")
ORACLE["docs_payment_methods"] = starred("SELECT payment_method_id AS _id, payment_method_name FROM n_pm")
ORACLE["docs_customers"] = starred("SELECT customer_id AS _id FROM n_cust")
ORACLE["docs_items"] = starred("""
SELECT i.item_id AS _id, i.item_name, CAST(i.price_per_unit AS DOUBLE) AS price_per_unit, i.category_id, c.category_name
FROM n_items i JOIN n_cat c ON i.category_id = c.category_id""")
_DOC_T = """SELECT transaction_id AS _id, customer_id, item_id, payment_method_id, location_id, quantity,
       CAST(total_price AS DOUBLE) AS total_price, CAST(transaction_date AS TIMESTAMP) AS transaction_date,
       coalesce(discount_applied, FALSE) AS discount_applied FROM n_fact"""
ORACLE["docs_transactions"] = starred(_DOC_T)
_EMB = """
SELECT t.transaction_id AS _id, t.customer_id, t.quantity, CAST(t.total_price AS DOUBLE) AS total_price,
       CAST(t.transaction_date AS TIMESTAMP) AS transaction_date, coalesce(t.discount_applied, FALSE) AS discount_applied,
       i.item_id AS item_item_id, i.item_name AS item_item_name, CAST(i.price_per_unit AS DOUBLE) AS item_price_per_unit,
       c.category_id AS category_category_id, c.category_name AS category_category_name,
       p.payment_method_id AS payment_method_payment_method_id, p.payment_method_name AS payment_method_payment_method_name,
       l.location_id AS location_location_id, l.location_name AS location_location_name
FROM n_fact t JOIN n_items i ON t.item_id = i.item_id JOIN n_cat c ON i.category_id = c.category_id
JOIN n_pm p ON t.payment_method_id = p.payment_method_id JOIN n_loc l ON t.location_id = l.location_id"""
ORACLE["docs_embedded"] = starred(_EMB)

ORACLE["stats_row_counts"] = starred("""
SELECT 'categories' AS table_name, count(*) AS row_count FROM n_cat
UNION ALL SELECT 'locations', count(*) FROM n_loc
UNION ALL SELECT 'payment_methods', count(*) FROM n_pm
UNION ALL SELECT 'customers', count(*) FROM n_cust
UNION ALL SELECT 'items', count(*) FROM n_items
UNION ALL SELECT 'transactions', count(*) FROM n_fact""")
ORACLE["stats_dates"] = starred("SELECT min(transaction_date) AS min_date, max(transaction_date) AS max_date FROM n_fact")
ORACLE["stats_distinct"] = starred("""
SELECT (SELECT count(DISTINCT customer_id) FROM n_fact) AS distinct_customers,
       (SELECT count(DISTINCT item_id) FROM n_fact) AS distinct_items,
       (SELECT count(DISTINCT category_id) FROM n_items) AS distinct_categories""")


def _biz(table: str, scale: int) -> str:
    return f"""
SELECT CAST(coalesce(sum(CAST(total_price AS DECIMAL(18,{scale}))), 0) AS DECIMAL(18,{scale})) AS total_revenue,
       coalesce(round_even(CAST(sum(CAST(round_even(total_price * 100, 0) AS BIGINT)) AS DOUBLE)
                           / CAST(count(total_price) AS DOUBLE), 0) / 100, 0.0) AS avg_order_value,
       round_even(CAST(coalesce(sum(quantity), 0) AS DOUBLE) * 10, 0) / 10 AS total_quantity
FROM {table}"""


ORACLE["stats_business"] = starred(_biz("n_fact", 2))
ORACLE["doc_stats"] = starred(f"""
SELECT (SELECT CAST(min(transaction_date) AS DATE) FROM docs) AS min_date,
       (SELECT CAST(max(transaction_date) AS DATE) FROM docs) AS max_date, b.*
FROM ({_biz('docs', 2)}) b""".replace("FROM docs", "FROM (" + _DOC_T + ") d"))
ORACLE["doc_counts"] = ORACLE["stats_row_counts"]
ORACLE["doc_distinct_nested"] = starred(f"""
SELECT count(DISTINCT customer_id) AS distinct_customers, count(DISTINCT item_item_id) AS distinct_items,
       count(DISTINCT category_category_id) AS distinct_categories FROM ({_EMB}) e""")

# ------------------------------------------------------------------ checks on the damaged star
_CHECK_META = {
    6: ("orphan_customers", "foreign_key"), 7: ("orphan_items", "foreign_key"),
    8: ("orphan_payment_methods", "foreign_key"), 9: ("orphan_locations", "foreign_key"),
    10: ("price_calculation_errors", "business_rule"), 11: ("non_positive_quantity", "business_rule"),
    12: ("non_positive_total", "business_rule"), 13: ("future_dates", "business_rule"),
    14: ("extreme_quantity", "business_rule"), 15: ("extreme_total", "business_rule"),
    16: ("null_customer_ids", "type_range"), 17: ("null_transaction_ids", "type_range"),
    18: ("long_customer_ids", "type_range"), 19: ("long_transaction_ids", "type_range"),
    20: ("precision_violations", "type_range"), 21: ("duplicate_transactions", "duplicate"),
    22: ("duplicate_customers", "duplicate"),
}
_CHECK_SQL = {
    6: "SELECT count(*) FROM ds_fact t LEFT JOIN (SELECT DISTINCT customer_id FROM ds_customers) c "
       "ON t.customer_id = c.customer_id WHERE c.customer_id IS NULL",
    7: "SELECT count(*) FROM ds_fact t LEFT JOIN (SELECT DISTINCT item_id FROM ds_items) i "
       "ON t.item_id = i.item_id WHERE i.item_id IS NULL",
    8: "SELECT count(*) FROM ds_fact t LEFT JOIN (SELECT DISTINCT payment_method_id FROM ds_pm) p "
       "ON t.payment_method_id = p.payment_method_id WHERE p.payment_method_id IS NULL",
    9: "SELECT count(*) FROM ds_fact t LEFT JOIN (SELECT DISTINCT location_id FROM ds_loc) l "
       "ON t.location_id = l.location_id WHERE l.location_id IS NULL",
    10: "SELECT count(*) FROM ds_fact t JOIN ds_items i ON t.item_id = i.item_id "
        "WHERE abs(t.total_price - i.price_per_unit * t.quantity) > CAST(0.01 AS DOUBLE)",
    11: "SELECT count(*) FROM ds_fact WHERE quantity <= 0",
    12: "SELECT count(*) FROM ds_fact WHERE total_price <= 0",
    13: "SELECT count(*) FROM ds_fact WHERE transaction_date > DATE '2002-01-01' + 1",
    14: "SELECT count(*) FROM ds_fact WHERE quantity > 1000",
    15: "SELECT count(*) FROM ds_fact WHERE total_price > 10000",
    16: "SELECT count(*) FROM ds_fact WHERE customer_id IS NULL",
    17: "SELECT count(*) FROM ds_fact WHERE transaction_id IS NULL",
    18: "SELECT count(*) FROM ds_customers WHERE octet_length(encode(customer_id)) > 32",
    19: "SELECT count(*) FROM ds_fact WHERE octet_length(encode(transaction_id)) > 32",
    20: "SELECT count(*) FROM ds_fact WHERE total_price >= CAST(1e8 AS DOUBLE) "
        "OR round_even(total_price * 100, 0) / 100 <> total_price",
    21: "SELECT count(*) - count(DISTINCT transaction_id) FROM ds_fact",
    22: "SELECT count(*) - count(DISTINCT customer_id) FROM ds_customers",
}


def _checks_sql(ids) -> str:
    parts = [f"SELECT {i} AS check_id, '{_CHECK_META[i][0]}' AS check_name, '{_CHECK_META[i][1]}' AS check_group, "
             f"CAST(({_CHECK_SQL[i]}) AS BIGINT) AS issues" for i in ids]
    return "\nUNION ALL ".join(parts)


_ALL_CHECKS = "all_checks AS (" + _checks_sql(range(6, 23)) + ")"

ORACLE["check_orphan_item_category"] = damaged("""
SELECT 5 AS check_id, 'orphan_item_categories' AS check_name, 'foreign_key' AS check_group,
       count(*) AS issues
FROM ds_items i LEFT JOIN ds_cat c ON i.category_id = c.category_id WHERE c.category_id IS NULL""")
ORACLE["check_orphans"] = damaged(_checks_sql([6, 7, 8, 9]))
ORACLE["check_price_calc"] = damaged(_checks_sql([10]))
ORACLE["check_business_rules"] = damaged(_checks_sql([11, 12, 13, 14, 15]))
ORACLE["check_types_ranges"] = damaged(_checks_sql([16, 17, 18, 19, 20]))
ORACLE["check_duplicates"] = damaged(_checks_sql([21, 22]))
ORACLE["validation_summary"] = _w(DAMAGED, _ALL_CHECKS, body="""
SELECT count(*) AS checks, CAST(sum(issues) AS BIGINT) AS total_issues,
       CAST(count_if(issues > 0) AS BIGINT) AS failed_checks, sum(issues) = 0 AS passed FROM all_checks""")
ORACLE["sample_ids"] = damaged("""
SELECT transaction_id FROM ds_fact WHERE transaction_id IS NOT NULL
ORDER BY md5(transaction_id), transaction_id LIMIT 5""")

# ------------------------------------------------------------------ cross-store comparison (damaged)
_DS_COUNTS = """
ds_rel_counts AS (
  SELECT 'categories' AS table_name, count(*) AS row_count FROM ds_cat
  UNION ALL SELECT 'locations', count(*) FROM ds_loc
  UNION ALL SELECT 'payment_methods', count(*) FROM ds_pm
  UNION ALL SELECT 'customers', count(*) FROM ds_customers
  UNION ALL SELECT 'items', count(*) FROM ds_items
  UNION ALL SELECT 'transactions', count(*) FROM ds_fact),
ds_doc_counts AS (
  SELECT 'categories' AS table_name, count(*) AS row_count FROM ds_cat
  UNION ALL SELECT 'locations', count(*) FROM ds_loc
  UNION ALL SELECT 'payment_methods', count(*) FROM ds_pm
  UNION ALL SELECT 'customers', count(*) FROM ds_customers
  UNION ALL SELECT 'items', count(*) FROM ds_items i JOIN ds_cat c ON i.category_id = c.category_id
  UNION ALL SELECT 'transactions', count(*) FROM ds_docs),
ds_cmp_counts AS (
  SELECT coalesce(r.table_name, d.table_name) AS table_name, r.row_count AS relational_count,
         d.row_count AS document_count, coalesce(r.row_count = d.row_count, FALSE) AS match
  FROM ds_rel_counts r FULL JOIN ds_doc_counts d ON r.table_name = d.table_name),
ds_rel_stats AS (""" + _biz("ds_fact", 3) + """),
ds_doc_stats AS (""" + _biz("ds_docs", 3) + """),
ds_cmp_metrics AS (
  SELECT r.total_revenue AS relational_revenue, r.total_quantity AS relational_quantity,
         d.total_revenue AS document_revenue, d.total_quantity AS document_quantity,
         abs(r.total_revenue - d.total_revenue) < 0.01 AS revenue_match,
         r.total_quantity = d.total_quantity AS quantity_match
  FROM ds_rel_stats r, ds_doc_stats d),
ds_cmp_dates AS (
  SELECT r.mn AS relational_min, r.mx AS relational_max, d.mn AS document_min, d.mx AS document_max,
         coalesce(r.mn = d.mn, FALSE) AS min_match, coalesce(r.mx = d.mx, FALSE) AS max_match
  FROM (SELECT min(transaction_date) AS mn, max(transaction_date) AS mx FROM ds_fact) r,
       (SELECT CAST(min(transaction_date) AS DATE) AS mn, CAST(max(transaction_date) AS DATE) AS mx FROM ds_docs) d),
ds_rel_rows AS (
  SELECT t.transaction_id, t.quantity, t.total_price, t.transaction_date
  FROM ds_fact t JOIN ds_items i ON t.item_id = i.item_id JOIN ds_cat c ON i.category_id = c.category_id
  JOIN ds_pm p ON t.payment_method_id = p.payment_method_id JOIN ds_loc l ON t.location_id = l.location_id),
ds_sample AS (
  SELECT transaction_id FROM ds_rel_rows WHERE transaction_id IS NOT NULL
  ORDER BY md5(transaction_id), transaction_id LIMIT 5)"""


def _row_cmp(rel: str, docs: str = "ds_docs") -> str:
    return f"""
SELECT CAST(count_if(transaction_id IS NOT NULL) AS BIGINT) AS checked,
       CAST(count_if(transaction_id IS NULL) AS BIGINT) AS null_ids,
       CAST(count_if(missing) AS BIGINT) AS missing_count,
       CAST(count_if(qd OR td OR dd) AS BIGINT) AS mismatch_count,
       CAST(count_if(qd) AS BIGINT) AS quantity_mismatches, CAST(count_if(td) AS BIGINT) AS total_mismatches,
       CAST(count_if(dd) AS BIGINT) AS date_mismatches,
       CAST(count_if((qd OR td OR dd) AND NOT dd) AS BIGINT) AS non_date_mismatches
FROM (
  SELECT r.transaction_id, d._id IS NULL AND r.transaction_id IS NOT NULL AS missing,
         d._id IS NOT NULL AND r.quantity IS DISTINCT FROM d.quantity AS qd,
         d._id IS NOT NULL AND coalesce(abs(r.total_price - d.total_price) > CAST(0.01 AS DOUBLE),
                                        (r.total_price IS NULL) <> (d.total_price IS NULL)) AS td,
         d._id IS NOT NULL AND r.transaction_date IS DISTINCT FROM CAST(d.transaction_date AS DATE) AS dd
  FROM ({rel}) r LEFT JOIN (
    SELECT _id, quantity, total_price, CAST(transaction_date AS DATE) AS transaction_date FROM {docs}
    WHERE _id IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY _id ORDER BY quantity DESC NULLS LAST, total_price DESC NULLS LAST,
                                                     CAST(transaction_date AS DATE) DESC NULLS LAST) = 1
  ) d ON r.transaction_id = d._id
)"""


_FULL_ROWS = "SELECT * FROM ds_rel_rows"
_SAMPLE_ROWS = "SELECT * FROM ds_rel_rows WHERE transaction_id IN (SELECT transaction_id FROM ds_sample)"

ORACLE["compare_counts"] = _w(DAMAGED, _DS_COUNTS, body="SELECT * FROM ds_cmp_counts")
ORACLE["compare_metrics"] = _w(DAMAGED, _DS_COUNTS, body="SELECT * FROM ds_cmp_metrics")
ORACLE["compare_dates"] = _w(DAMAGED, _DS_COUNTS, body="SELECT * FROM ds_cmp_dates")
ORACLE["spot_check"] = _w(DAMAGED, _DS_COUNTS, body=_row_cmp(_SAMPLE_ROWS))
ORACLE["reconcile_rows_full"] = _w(DAMAGED, _DS_COUNTS, body=_row_cmp(_FULL_ROWS))

_STATUS = """
ds_spot AS (""" + _row_cmp(_FULL_ROWS) + """),
ds_checks AS (""" + _checks_sql(range(6, 23)) + """),
ds_status AS (
  SELECT c.cm AS record_count_match, m.revenue_match AND m.quantity_match AS business_match,
         dt.min_match AND dt.max_match AS dates_match,
         CAST((CASE WHEN c.cm THEN 0 ELSE 1 END) + (CASE WHEN m.revenue_match AND m.quantity_match THEN 0 ELSE 1 END)
              AS INTEGER) AS critical_issues,
         s.missing_count, s.mismatch_count, s.non_date_mismatches,
         c.rt AS relational_total, c.dt AS document_total,
         round_even(c.dt * CAST(100.0 AS DOUBLE) / c.rt * 100, 0) / 100 AS success_rate_pct,
         k.fk AS fk_issues, k.rv AS rule_violations
  FROM (SELECT coalesce(min(CAST(match AS INTEGER)) = 1, FALSE) AS cm,
               CAST(coalesce(sum(relational_count), 0) AS BIGINT) AS rt,
               CAST(coalesce(sum(document_count), 0) AS BIGINT) AS dt FROM ds_cmp_counts) c,
       ds_cmp_metrics m, ds_cmp_dates dt, ds_spot s,
       (SELECT CAST(coalesce(sum(issues) FILTER (WHERE check_id BETWEEN 6 AND 9), 0) AS BIGINT) AS fk,
               CAST(coalesce(sum(issues) FILTER (WHERE check_id IN (11, 12)), 0) AS BIGINT) AS rv
        FROM ds_checks) k)"""

_STATUS_FINAL = """
SELECT record_count_match, business_match, dates_match, critical_issues, missing_count, mismatch_count,
       CASE WHEN critical_issues = 0 AND missing_count = 0 AND mismatch_count = 0 THEN 'PASSED - EXCELLENT'
            WHEN critical_issues = 0 AND missing_count = 0 AND mismatch_count > 0 THEN 'PASSED - minor differences'
            ELSE 'FAILED' END AS status_compat,
       CASE WHEN critical_issues = 0 AND missing_count = 0 AND non_date_mismatches = 0 AND mismatch_count = 0
                 THEN 'PASSED - EXCELLENT'
            WHEN critical_issues = 0 AND missing_count = 0 AND non_date_mismatches = 0 THEN 'PASSED - minor differences'
            ELSE 'FAILED' END AS status_strict,
       relational_total, document_total, success_rate_pct, fk_issues, rule_violations
FROM ds_status"""
ORACLE["validation_status"] = _w(DAMAGED, _DS_COUNTS, _STATUS, body=_STATUS_FINAL)


def _stack(section: str, cte: str, cols: list[str], doubles=()) -> str:
    def text(c):
        if c in doubles:
            return f"CAST(CAST({c} AS DECIMAL(38,6)) AS VARCHAR)"
        return f"CAST({c} AS VARCHAR)"
    return "\nUNION ALL ".join(f"SELECT '{section}' AS section, '{c}' AS metric, {text(c)} AS value FROM {cte}"
                               for c in cols)


_BIZ_COLS = ["total_revenue", "avg_order_value", "total_quantity"]
_REPORT_PARTS = [
    "SELECT 'relational_counts' AS section, table_name AS metric, CAST(row_count AS VARCHAR) AS value FROM ds_rel_counts",
    "SELECT 'document_counts', table_name, CAST(row_count AS VARCHAR) FROM ds_doc_counts",
    "SELECT 'checks' AS section, check_name AS metric, CAST(issues AS VARCHAR) AS value FROM ds_checks",
    "SELECT 'counts', table_name, concat_ws('/', CAST(relational_count AS VARCHAR), "
    "CAST(document_count AS VARCHAR)) FROM ds_cmp_counts",
    _stack("relational_dates", "ds_rel_dates", ["min_date", "max_date"]),
    _stack("relational_distinct", "ds_rel_distinct", ["distinct_customers", "distinct_items", "distinct_categories"]),
    _stack("relational_business", "ds_rel_stats", _BIZ_COLS, doubles=_BIZ_COLS[1:]),
    _stack("document_statistics", "ds_doc_dates", ["min_date", "max_date"]),
    _stack("document_statistics", "ds_doc_stats", _BIZ_COLS, doubles=_BIZ_COLS[1:]),
    _stack("orphan_item_categories", "ds_orphan_items", ["issues"]),
    _stack("summary", "ds_summary", ["checks", "total_issues", "failed_checks", "passed"]),
    _stack("metrics", "ds_cmp_metrics", ["relational_revenue", "relational_quantity", "document_revenue",
                                          "document_quantity", "revenue_match", "quantity_match"],
           doubles=("relational_quantity", "document_quantity")),
    _stack("dates", "ds_cmp_dates", ["relational_min", "relational_max", "document_min", "document_max",
                                     "min_match", "max_match"]),
    _stack("rows", "ds_spot", ["checked", "null_ids", "missing_count", "mismatch_count", "quantity_mismatches",
                               "total_mismatches", "date_mismatches", "non_date_mismatches"]),
    _stack("status", "ds_status_final", ["record_count_match", "business_match", "dates_match", "critical_issues",
                                         "missing_count", "mismatch_count", "status_compat", "status_strict",
                                         "relational_total", "document_total", "success_rate_pct", "fk_issues",
                                         "rule_violations"], doubles=("success_rate_pct",)),
]
ORACLE["validation_report"] = _w(
    DAMAGED, _DS_COUNTS, _STATUS,
    "ds_summary AS (SELECT count(*) AS checks, CAST(sum(issues) AS BIGINT) AS total_issues, "
    "CAST(count_if(issues > 0) AS BIGINT) AS failed_checks, sum(issues) = 0 AS passed FROM ds_checks)",
    "ds_rel_dates AS (SELECT min(transaction_date) AS min_date, max(transaction_date) AS max_date FROM ds_fact)",
    "ds_doc_dates AS (SELECT CAST(min(transaction_date) AS DATE) AS min_date, "
    "CAST(max(transaction_date) AS DATE) AS max_date FROM ds_docs)",
    "ds_rel_distinct AS (SELECT (SELECT count(DISTINCT customer_id) FROM ds_fact) AS distinct_customers, "
    "(SELECT count(DISTINCT item_id) FROM ds_fact) AS distinct_items, "
    "(SELECT count(DISTINCT category_id) FROM ds_items) AS distinct_categories)",
    "ds_orphan_items AS (SELECT count(*) AS issues FROM ds_items i LEFT JOIN ds_cat c "
    "ON i.category_id = c.category_id WHERE c.category_id IS NULL)",
    "ds_status_final AS (" + _STATUS_FINAL + ")",
    body="\nUNION ALL ".join(_REPORT_PARTS))


def _undamaged(text: str) -> str:
    """The comparison CTEs over the undamaged star and its own documents."""
    import re
    for a, b in (("ds_fact", "n_fact"), ("ds_items", "n_items"), ("ds_cat", "n_cat"), ("ds_pm", "n_pm"),
                 ("ds_loc", "n_loc"), ("ds_customers", "n_cust")):
        text = re.sub(rf"\b{a}\b", b, text)
    return text


ORACLE["validation_status_undamaged"] = _w(
    RAW_SALES, CLEAN, STAR, "ds_docs AS (" + _DOC_T + ")", _undamaged(_DS_COUNTS), _undamaged(_STATUS), body=_STATUS_FINAL)

# ------------------------------------------------------------------ the embedded document mode
ORACLE["doc_counts_embedded"] = starred(f"""
SELECT 'customers' AS table_name, count(*) AS row_count FROM n_cust
UNION ALL SELECT 'transactions', count(*) FROM ({_EMB}) e""")
ORACLE["compare_counts_embedded"] = starred(f"""
SELECT 'transactions' AS table_name, r.n AS relational_count, d.n AS document_count, r.n = d.n AS match
FROM (SELECT count(*) AS n FROM n_fact) r, (SELECT count(*) AS n FROM ({_EMB}) e) d""")
ORACLE["reconcile_rows_embedded"] = _w(RAW_SALES, CLEAN, STAR, "e_docs AS (" + _EMB + ")", body=_row_cmp("""
  SELECT t.transaction_id, t.quantity, t.total_price, t.transaction_date
  FROM n_fact t JOIN n_items i ON t.item_id = i.item_id JOIN n_cat c ON i.category_id = c.category_id
  JOIN n_pm p ON t.payment_method_id = p.payment_method_id JOIN n_loc l ON t.location_id = l.location_id""", "e_docs"))

ORACLE["dim_items_ordinal"] = starred("""
SELECT CAST(row_number() OVER (ORDER BY d.first, d.item_name, d.category_name NULLS FIRST, d.price_per_unit NULLS FIRST)
            AS INTEGER) AS item_id, d.item_name, d.price_per_unit, c.category_id
FROM (SELECT item AS item_name, category AS category_name, price_per_unit,
             min(CAST(split_part(transaction_id, '_', 2) AS BIGINT) * 8
                 + CAST(split_part(transaction_id, '_', 3) AS BIGINT)) AS first
      FROM sales_clean WHERE item IS NOT NULL GROUP BY ALL) d
LEFT JOIN n_cat c ON d.category_name = c.category_name""")
ORACLE["dim_items_file_order"] = starred("""
SELECT CAST(row_number() OVER (ORDER BY d.first) AS INTEGER) AS item_id, d.item_name, d.price_per_unit, c.category_id
FROM (SELECT item AS item_name, category AS category_name, price_per_unit, min(place) AS first
      FROM (SELECT *, row_number() OVER (ORDER BY CAST(split_part(transaction_id, '_', 2) AS BIGINT),
                                                  CAST(split_part(transaction_id, '_', 3) AS BIGINT), transaction_id) AS place
            FROM sales_clean) WHERE item IS NOT NULL GROUP BY ALL) d
LEFT JOIN n_cat c ON d.category_name = c.category_name""")
ORACLE["dim_id_ranges"] = starred("\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count, count(DISTINCT {k}) AS distinct_ids, min({k}) AS least_id, "
    f"max({k}) AS largest_id FROM {n}"
    for t, k, n in (("categories", "category_id", "n_cat"), ("payment_methods", "payment_method_id", "n_pm"),
                    ("locations", "location_id", "n_loc"), ("items", "item_id", "n_items"))))

# ------------------------------------------------------------------ profiling
from salesq.plans.oracle import raw as _raw  # noqa: E402

_RAW_COLS = ["transaction_id", "customer_id", "category", "item", "price_per_unit", "quantity",
             "total_spent", "payment_method", "location", "transaction_date", "discount_applied"]
_RAW_TYPES = {c: ("double" if c in ("price_per_unit", "quantity", "total_spent") else "string") for c in _RAW_COLS}

ORACLE["raw_scan"] = _raw("SELECT * FROM raw_sales")
ORACLE["profile_shape"] = _raw("SELECT count(*) AS rows, 11 AS columns FROM raw_sales")
ORACLE["profile_non_null"] = _raw("\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{_RAW_TYPES[c]}' AS dtype, count({c}) AS non_null FROM raw_sales"
    for c in _RAW_COLS))
ORACLE["profile_missing"] = _raw("\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(count_if({c} IS NULL) AS BIGINT) AS missing_count FROM raw_sales"
    for c in _RAW_COLS))
ORACLE["profile_duplicates"] = _raw(
    "SELECT CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw_sales)) AS BIGINT) AS duplicate_rows "
    "FROM raw_sales")
ORACLE["profile_values"] = _raw("\nUNION ".join(
    f"SELECT DISTINCT '{c}' AS column_name, coalesce(CAST({c} AS VARCHAR), 'nan') AS value FROM raw_sales"
    for c in ["payment_method", "location", "discount_applied"]))


def _r6(e: str) -> str:
    return f"round_even(({e}) * 1000000, 0) / 1000000"


ORACLE["profile_numeric"] = _raw("\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS count, {_r6(f'avg({c})')} AS mean, "
    f"{_r6(f'stddev_samp({c})')} AS std, {_r6(f'min({c})')} AS min, "
    f"{_r6(f'quantile_cont({c}, 0.25)')} AS p25, {_r6(f'quantile_cont({c}, 0.5)')} AS p50, "
    f"{_r6(f'quantile_cont({c}, 0.75)')} AS p75, {_r6(f'max({c})')} AS max FROM raw_sales"
    for c in ["price_per_unit", "quantity", "total_spent"]))

# ------------------------------------------------------------------ load
_TS1, _TS2 = "TIMESTAMP '2024-01-01 00:00:00'", "TIMESTAMP '2024-01-02 00:00:00'"
_B1 = "transaction_date < DATE '1997-01-01'"

_UPSERT_DIM = f"""
t1 AS (
  SELECT CAST(row_number() OVER (ORDER BY payment_method_name) AS INTEGER) AS payment_method_id, payment_method_name,
         {_TS1} AS created_at, {_TS1} AS updated_at
  FROM (SELECT DISTINCT payment_method AS payment_method_name FROM sales_clean WHERE {_B1} AND payment_method IS NOT NULL)
),
src AS (SELECT DISTINCT payment_method AS payment_method_name FROM sales_clean WHERE payment_method IS NOT NULL)"""
ORACLE["upsert_dimension"] = _w(RAW_SALES, CLEAN, _UPSERT_DIM, body=f"""
SELECT t.payment_method_id, t.payment_method_name, t.created_at,
       CASE WHEN s.payment_method_name IS NOT NULL THEN {_TS2} ELSE t.updated_at END AS updated_at
FROM t1 t LEFT JOIN src s ON t.payment_method_name = s.payment_method_name
UNION ALL
SELECT CAST((SELECT coalesce(max(payment_method_id), 0) FROM t1) + row_number() OVER (ORDER BY payment_method_name)
            AS INTEGER), payment_method_name, {_TS2}, {_TS2}
FROM src WHERE payment_method_name NOT IN (SELECT payment_method_name FROM t1)""")

_UPSERT_CUST = f"""
t1 AS (SELECT DISTINCT customer_id, {_TS1} AS created_at, {_TS1} AS updated_at FROM sales_clean
       WHERE {_B1} AND customer_id IS NOT NULL),
src AS (SELECT DISTINCT customer_id FROM sales_clean WHERE customer_id IS NOT NULL)"""
ORACLE["upsert_customers"] = _w(RAW_SALES, CLEAN, _UPSERT_CUST, body=f"""
SELECT coalesce(t.customer_id, s.customer_id) AS customer_id, coalesce(t.created_at, {_TS2}) AS created_at,
       CASE WHEN s.customer_id IS NOT NULL THEN {_TS2} ELSE t.updated_at END AS updated_at
FROM t1 t FULL JOIN src s ON t.customer_id = s.customer_id""")

_UPSERT_ITEMS = f"""
items1 AS (
  SELECT row_number() OVER (ORDER BY d.item_name, d.category_name NULLS FIRST, d.price_per_unit NULLS FIRST) AS item_id,
         d.item_name, d.price_per_unit, c.category_id
  FROM (SELECT DISTINCT item AS item_name, category AS category_name, price_per_unit FROM sales_clean
        WHERE item IS NOT NULL AND {_B1}) d
  LEFT JOIN n_cat c ON d.category_name = c.category_name
),
src1 AS (SELECT item_name, category_id, CAST(arg_max(price_per_unit, item_id) AS DECIMAL(10,2)) AS price
         FROM items1 GROUP BY item_name, category_id),
t1 AS (SELECT CAST(row_number() OVER (ORDER BY item_name, category_id NULLS FIRST) AS INTEGER) AS item_id,
              item_name, category_id, price AS price_per_unit, {_TS1} AS created_at, {_TS1} AS updated_at FROM src1),
src2 AS (SELECT item_name, category_id, CAST(arg_max(price_per_unit, item_id) AS DECIMAL(10,2)) AS price
         FROM n_items GROUP BY item_name, category_id)"""
ORACLE["upsert_items"] = _w(RAW_SALES, CLEAN, STAR, _UPSERT_ITEMS, body=f"""
SELECT t.item_id, t.item_name, CAST(coalesce(s.price, t.price_per_unit) AS DECIMAL(10,2)) AS price_per_unit,
       t.category_id, t.created_at, CASE WHEN s.price IS NOT NULL THEN {_TS2} ELSE t.updated_at END AS updated_at
FROM t1 t LEFT JOIN src2 s ON t.item_name = s.item_name AND t.category_id = s.category_id
UNION ALL
SELECT CAST((SELECT coalesce(max(item_id), 0) FROM t1)
            + row_number() OVER (ORDER BY s.item_name, s.category_id NULLS FIRST) AS INTEGER),
       s.item_name, s.price, s.category_id, {_TS2}, {_TS2}
FROM src2 s WHERE NOT EXISTS (SELECT 1 FROM t1 WHERE t1.item_name = s.item_name AND t1.category_id = s.category_id)""")

_FV = ["customer_id", "item_id", "payment_method_id", "location_id", "quantity", "total_price",
       "transaction_date", "discount_applied"]
_DEDUP = ("QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY "
          + ", ".join(f"{c} DESC NULLS LAST" for c in _FV) + ") = 1")
_UPSERT_T = f"""
t1 AS (SELECT *, {_TS1} AS created_at, {_TS1} AS updated_at FROM n_fact
       WHERE {_B1} AND transaction_id IS NOT NULL {_DEDUP}),
src AS (SELECT * FROM n_fact WHERE transaction_id IS NOT NULL {_DEDUP})"""
_CHANGED = " OR ".join(f"t.{c} IS DISTINCT FROM s.{c}" for c in _FV)
ORACLE["upsert_transactions"] = _w(RAW_SALES, CLEAN, STAR, _UPSERT_T, body=f"""
SELECT coalesce(t.transaction_id, s.transaction_id) AS transaction_id,
       {", ".join(f"CASE WHEN s.transaction_id IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}" for c in _FV)},
       coalesce(t.created_at, {_TS2}) AS created_at,
       CASE WHEN s.transaction_id IS NOT NULL AND (t.created_at IS NULL OR {_CHANGED}) THEN {_TS2}
            ELSE t.updated_at END AS updated_at
FROM t1 t FULL JOIN src s ON t.transaction_id = s.transaction_id""")

ORACLE["load_fill_defaults"] = _raw("""
SELECT transaction_id, coalesce(quantity, CAST(0.0 AS DOUBLE)) AS quantity,
       coalesce(total_spent, CAST(0.0 AS DOUBLE)) AS total_price,
       coalesce(CASE WHEN discount_applied IS NULL THEN NULL ELSE discount_applied = 'True' END, FALSE) AS discount_applied
FROM raw_sales""")

_REASONS = """
ds_reasons AS (
  SELECT f.*, array_to_string(list_filter([
      CASE WHEN total_price IS NOT NULL AND TRY_CAST(total_price AS DECIMAL(10,2)) IS NULL THEN 'bad_type:total_price' END,
      CASE WHEN quantity IS NOT NULL AND TRY_CAST(round_even(quantity, 0) AS INTEGER) IS NULL THEN 'bad_type:quantity' END,
      CASE WHEN transaction_id IS NULL THEN 'null:transaction_id' END,
      CASE WHEN customer_id IS NULL THEN 'null:customer_id' END,
      CASE WHEN item_id IS NULL THEN 'null:item_id' END,
      CASE WHEN payment_method_id IS NULL THEN 'null:payment_method_id' END,
      CASE WHEN location_id IS NULL THEN 'null:location_id' END,
      CASE WHEN quantity IS NULL THEN 'null:quantity' END,
      CASE WHEN total_price IS NULL THEN 'null:total_price' END,
      CASE WHEN transaction_date IS NULL THEN 'null:transaction_date' END,
      CASE WHEN octet_length(encode(transaction_id)) > 32 THEN 'too_long:transaction_id' END,
      CASE WHEN octet_length(encode(customer_id)) > 32 THEN 'too_long:customer_id' END,
      CASE WHEN customer_id IS NOT NULL AND customer_id NOT IN (SELECT customer_id FROM ds_customers) THEN 'missing_parent:customer_id' END,
      CASE WHEN item_id IS NOT NULL AND item_id NOT IN (SELECT item_id FROM ds_items) THEN 'missing_parent:item_id' END,
      CASE WHEN payment_method_id IS NOT NULL AND payment_method_id NOT IN (SELECT payment_method_id FROM ds_pm) THEN 'missing_parent:payment_method_id' END,
      CASE WHEN location_id IS NOT NULL AND location_id NOT IN (SELECT location_id FROM ds_loc) THEN 'missing_parent:location_id' END
    ], lambda x: x IS NOT NULL), ',') AS reasons
  FROM ds_fact f)"""
ORACLE["load_rejects"] = _w(DAMAGED, _REASONS, body="SELECT * FROM ds_reasons WHERE reasons <> ''")
ORACLE["conform_transactions"] = _w(DAMAGED, _REASONS, body="""
SELECT transaction_id, customer_id, item_id, payment_method_id, location_id,
       TRY_CAST(round_even(quantity, 0) AS INTEGER) AS quantity, TRY_CAST(total_price AS DECIMAL(10,2)) AS total_price,
       transaction_date, discount_applied
FROM ds_reasons WHERE reasons = ''""")

ORACLE["reconcile_counts"] = starred("""
SELECT e.table_name, e.row_count AS expected, a.row_count AS actual, a.row_count >= e.row_count AS passed
FROM (SELECT 'categories' AS table_name, count(*) AS row_count FROM n_cat
      UNION ALL SELECT 'locations', count(*) FROM n_loc
      UNION ALL SELECT 'payment_methods', count(*) FROM n_pm
      UNION ALL SELECT 'customers', count(*) FROM n_cust
      UNION ALL SELECT 'items', count(*) FROM n_items
      UNION ALL SELECT 'transactions', count(*) FROM n_fact) e
JOIN (SELECT 'categories' AS table_name, count(*) AS row_count FROM n_cat
      UNION ALL SELECT 'locations', count(*) FROM n_loc
      UNION ALL SELECT 'payment_methods', count(*) FROM n_pm
      UNION ALL SELECT 'customers', count(*) FROM n_cust WHERE octet_length(encode(customer_id)) <= 32
      UNION ALL SELECT 'items', count(*) FROM n_items WHERE item_name IS NOT NULL AND price_per_unit IS NOT NULL
                 AND category_id IS NOT NULL AND octet_length(encode(item_name)) <= 64
                 AND TRY_CAST(price_per_unit AS DECIMAL(10,2)) IS NOT NULL
      UNION ALL SELECT 'transactions', count(*) FROM n_fact WHERE transaction_id IS NOT NULL AND customer_id IS NOT NULL
                 AND item_id IS NOT NULL AND payment_method_id IS NOT NULL AND location_id IS NOT NULL
                 AND quantity IS NOT NULL AND total_price IS NOT NULL AND transaction_date IS NOT NULL
                 AND octet_length(encode(transaction_id)) <= 32 AND octet_length(encode(customer_id)) <= 32
                 AND TRY_CAST(total_price AS DECIMAL(10,2)) IS NOT NULL
                 AND customer_id IN (SELECT customer_id FROM n_cust) AND item_id IN (SELECT item_id FROM n_items)
                 AND payment_method_id IN (SELECT payment_method_id FROM n_pm)
                 AND location_id IN (SELECT location_id FROM n_loc)) a
ON e.table_name = a.table_name""")

ORACLE["migration_summary"] = _w(DAMAGED, _DS_COUNTS, """
refused AS (
  SELECT 'categories' AS table_name, count(*) - count(DISTINCT category_id) AS errors FROM ds_cat
  UNION ALL SELECT 'locations', count(*) - count(DISTINCT location_id) FROM ds_loc
  UNION ALL SELECT 'payment_methods', count(*) - count(DISTINCT payment_method_id) FROM ds_pm
  UNION ALL SELECT 'customers', count(*) - count(DISTINCT customer_id) FROM ds_customers
  UNION ALL SELECT 'items', count(*) - count(DISTINCT i.item_id) FROM ds_items i JOIN ds_cat c ON i.category_id = c.category_id
  UNION ALL SELECT 'transactions', count(*) - count(DISTINCT _id) FROM ds_docs),
j AS (SELECT r.table_name, r.row_count AS rows_read, d.row_count AS rows_written,
             r.row_count - d.row_count AS rows_lost, e.errors
      FROM ds_rel_counts r JOIN ds_doc_counts d ON r.table_name = d.table_name JOIN refused e ON r.table_name = e.table_name)""", body="""
SELECT * FROM j UNION ALL
SELECT '__total__', CAST(sum(rows_read) AS BIGINT), CAST(sum(rows_written) AS BIGINT),
       CAST(sum(rows_lost) AS BIGINT), CAST(sum(errors) AS BIGINT) FROM j""")

ORACLE["source_counts"] = starred("""
SELECT * FROM (SELECT 'categories' AS table_name, count(*) AS row_count FROM n_cat
UNION ALL SELECT 'locations', count(*) FROM n_loc
UNION ALL SELECT 'payment_methods', count(*) FROM n_pm
UNION ALL SELECT 'customers', count(*) FROM n_cust
UNION ALL SELECT 'items', count(*) FROM n_items
UNION ALL SELECT 'transactions', count(*) FROM n_fact)
UNION ALL SELECT '__total__', (SELECT count(*) FROM n_cat) + (SELECT count(*) FROM n_loc) + (SELECT count(*) FROM n_pm)
   + (SELECT count(*) FROM n_cust) + (SELECT count(*) FROM n_items) + (SELECT count(*) FROM n_fact)""")
_SCAN_COLS = {
    ("categories", "n_cat"): {"category_id": "category_id", "category_name": None},
    ("locations", "n_loc"): {"location_id": "location_id", "location_name": None},
    ("payment_methods", "n_pm"): {"payment_method_id": "payment_method_id", "payment_method_name": None},
    ("customers", "n_cust"): {"customer_id": None, "customer_name": None},
    ("items", "n_items"): {"item_id": "item_id", "item_name": None, "price_per_unit": "price_per_unit",
                           "category_id": "category_id"},
    ("transactions", "n_fact"): {"transaction_id": None, "customer_id": None, "item_id": "item_id",
                                 "payment_method_id": "payment_method_id", "location_id": "location_id",
                                 "quantity": "round_even(quantity, 0)", "total_price": "total_price",
                                 "transaction_date": None, "discount_applied": None},
}
ORACLE["star_scan_counts"] = starred("\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS row_count, CAST(count_if({c} IS NULL) AS BIGINT) AS nulls, "
    + (f"CAST(sum(CAST({e} AS DECIMAL(18,2))) AS DECIMAL(18,2))" if e else "CAST(NULL AS DECIMAL(18,2))") + f" AS total FROM {n}"
    for (t, n), cols in _SCAN_COLS.items() for c, e in cols.items()))

_CONTRACT_KEYS = (("categories", "ds_cat", "category_id"), ("categories", "ds_cat", "category_name"),
                  ("locations", "ds_loc", "location_id"), ("locations", "ds_loc", "location_name"),
                  ("payment_methods", "ds_pm", "payment_method_id"), ("payment_methods", "ds_pm", "payment_method_name"),
                  ("customers", "ds_customers", "customer_id"), ("items", "ds_items", "item_id"),
                  ("items", "ds_items", "item_name,category_id"), ("transactions", "ds_fact", "transaction_id"))
ORACLE["contract_duplicates"] = damaged("\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{k}' AS key_columns, "
    f"CAST(coalesce(sum(n - 1) FILTER (WHERE {' AND '.join(c + ' IS NOT NULL' for c in k.split(','))}), 0) AS BIGINT) AS duplicates, "
    f"CAST(coalesce(sum(n) FILTER (WHERE {' OR '.join(c + ' IS NULL' for c in k.split(','))}), 0) AS BIGINT) AS null_keys "
    f"FROM (SELECT {k}, count(*) AS n FROM {n} GROUP BY {k})" for t, n, k in _CONTRACT_KEYS))
ORACLE["upsert_partitioned_fact"] = ORACLE["upsert_transactions"].replace(
    "ELSE t.updated_at END AS updated_at", "ELSE t.updated_at END AS updated_at,\n       strftime(CASE WHEN s.transaction_id "
    "IS NOT NULL THEN s.transaction_date ELSE t.transaction_date END, '%Y-%m') AS year_month")

ORACLE["reconcile_rows_digests"] = ORACLE["reconcile_rows_full"]
ORACLE["upsert_versioned_fact"] = ORACLE["upsert_partitioned_fact"]
ORACLE["versioned_fact_before"] = _w(RAW_SALES, CLEAN, STAR, _UPSERT_T, body="""
SELECT *, strftime(transaction_date, '%Y-%m') AS year_month FROM t1""")
_FACT_VALUES = ("customer_id, item_id, payment_method_id, location_id, quantity, total_price, transaction_date, discount_applied")
_REPEATS = f"""
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY {", ".join(
      c.strip() + " DESC NULLS LAST" for c in _FACT_VALUES.split(","))}) AS place FROM ds_fact)"""
ORACLE["load_superseded"] = with_ctes(DAMAGED, _REPEATS, body="""
SELECT 'customers' AS table_name, customer_id AS key, 'superseded:customer_id' AS reason, count(*) - 1 AS copies,
       CAST(NULL AS DOUBLE) AS total_price
FROM ds_customers WHERE customer_id IS NOT NULL GROUP BY customer_id HAVING count(*) > 1
UNION ALL
SELECT 'transactions', transaction_id, 'superseded:transaction_id', count(*), total_price
FROM ranked WHERE transaction_id IS NOT NULL AND place > 1
GROUP BY transaction_id, customer_id, item_id, payment_method_id, location_id, quantity, total_price, transaction_date, discount_applied""")
ORACLE["load_winners"] = with_ctes(DAMAGED, _REPEATS, body=f"SELECT transaction_id, {_FACT_VALUES} FROM ranked WHERE place = 1 OR transaction_id IS NULL")

# ------------------------------------------------------------------ written stages read back
ORACLE["clean_snapshot_resume"] = ORACLE["sales_clean"]
ORACLE["quarantine_snapshot"] = ORACLE["clean_quarantine"]
ORACLE["star_scan_parquet"] = ORACLE["fact_transactions"]
ORACLE["flat_snapshot"] = ORACLE["denorm_flat"]
ORACLE["docs_round_trip"] = ORACLE["docs_transactions"]
ORACLE["profile_snapshot"] = ORACLE["profile_missing"]
