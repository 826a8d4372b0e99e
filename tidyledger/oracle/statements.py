"""One statement per registered query."""

from __future__ import annotations

from tidyledger.oracle import tables as t
from tidyledger.oracle.tables import query

_COLUMNS = {
    "lineitem": "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, "
    "l_returnflag, l_linestatus, l_shipdate",
}
_PERCENT = "CAST(round(100.0 * {} / nullif({}, 0), 2) AS DOUBLE)"
_AMOUNT = "CAST(round(sum(gross_order_amount), 2) AS DECIMAL(22,2))"


def _rule(rule_id: str) -> str:
    dataset, severity = {r[0]: (r[1], r[3]) for r in t.RULES}[rule_id]
    sql = f"""SELECT '{rule_id}' AS rule_id, '{dataset}' AS dataset, record_key, '{severity}' AS severity,
  issue_description, {t.q(t.ACTIONS[rule_id])} AS suggested_action FROM ({t.RULE_SQL[rule_id]})"""
    reads = {
        "DQ004": ("fx_orders",), "DQ005": ("fx_orders", "fx_customers"), "DQ006": ("fx_orders", "fx_products"),
        "DQ007": ("fx_orders",), "DQ008": ("fx_orders", "prices"), "DQ009": ("fx_payments", "fx_orders"),
        "DQ010": ("fx_payments", "fx_orders"), "DQ011": ("fx_tickets",), "DQ012": ("fx_tickets", "fx_customers"),
    }.get(rule_id, ("fx_customers",))
    return query(sql, *reads)


def _counts(names: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{label}' AS table_name, count(*) AS row_count FROM {name}" for label, name in names.items()
    )


_Q1 = f"""SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, {_AMOUNT} AS completed_revenue,
  count(*) AS completed_orders
FROM fact_order WHERE order_status = 'completed' AND order_date IS NOT NULL GROUP BY 1"""

_Q2 = f"""SELECT c.customer_key, c.full_name, c.standard_state, {_AMOUNT} AS completed_value, count(*) AS completed_orders
FROM fact_order o JOIN dim_customer c ON o.customer_key = c.customer_key
WHERE o.order_status = 'completed' GROUP BY 1, 2, 3
ORDER BY completed_value DESC NULLS LAST, c.customer_key LIMIT 10"""

_ALL_EX = """SELECT record_key AS order_key, rule_id, issue_description FROM exceptions WHERE dataset = 'orders'
UNION ALL
SELECT fp.order_key, e.rule_id, e.issue_description FROM exceptions e JOIN fact_payment fp ON e.record_key = fp.payment_key
WHERE e.dataset = 'payments' AND fp.order_key IS NOT NULL"""

_LINE = (
    "o.order_key, o.customer_key, o.product_key, o.order_status, o.quantity, o.gross_order_amount, "
    "o.calculated_order_amount, o.order_amount_variance"
)

_ISSUES = f"SELECT DISTINCT * FROM ({_ALL_EX}) WHERE order_key IN (SELECT order_key FROM fact_order)"
_Q3 = f"""SELECT {_LINE}, list(DISTINCT e.rule_id ORDER BY e.rule_id) AS rule_list, count(DISTINCT (e.rule_id, e.issue_description)) AS issue_count
FROM fact_order o JOIN ({_ALL_EX}) e ON o.order_key = e.order_key GROUP BY ALL"""
_Q3_READS = ("fact_order", "fact_payment", "exceptions")
_Q3_FLAT = f"SELECT * EXCLUDE (rule_list), array_to_string(rule_list, '; ') AS triggered_rules FROM ({_Q3})"

_Q4 = f"""SELECT shipping_state AS state, {_AMOUNT} AS completed_revenue, count(*) AS completed_orders
FROM fact_order WHERE order_status = 'completed' AND shipping_state IS NOT NULL GROUP BY 1"""

_DETAIL = f"""SELECT c.customer_key,
  CASE WHEN c.customer_key IN (SELECT customer_key FROM fact_customer_issue WHERE lower(sentiment) = 'negative')
       THEN 'has_negative_ticket' ELSE 'no_negative_ticket' END AS cohort,
  coalesce(total, 0) AS total_orders, CAST(coalesce(bad, 0) AS BIGINT) AS orders_with_exception,
  {_PERCENT.format("coalesce(bad, 0)", "coalesce(total, 0)")} AS pct_orders_with_exception
FROM dim_customer c LEFT JOIN (
  SELECT customer_key, count(*) AS total,
    sum(CASE WHEN order_key IN (SELECT order_key FROM ({_ALL_EX})) THEN 1 ELSE 0 END) AS bad
  FROM fact_order GROUP BY customer_key) p ON p.customer_key = c.customer_key"""
_Q5_READS = (*_Q3_READS, "dim_customer", "fact_customer_issue")

_Q5 = f"""SELECT cohort, count(DISTINCT customer_key) AS customer_count, CAST(sum(total_orders) AS BIGINT) AS total_orders,
  CAST(sum(orders_with_exception) AS BIGINT) AS orders_with_exception,
  {_PERCENT.format("sum(orders_with_exception)", "sum(total_orders)")} AS pct_orders_with_exception
FROM ({_DETAIL}) GROUP BY cohort"""

# Columns and types of the profiled tables.
_PROFILED = {
    "dim_product": (
        ("product_key", "string"), ("product_name", "string"), ("category", "string"), ("unit_price", "decimal(12,2)"),
        ("active_flag", "boolean"),
    ),
    "fact_payment": (
        ("payment_key", "string"), ("order_key", "string"), ("payment_date", "date"), ("payment_method", "string"),
        ("payment_status", "string"), ("payment_amount", "decimal(12,2)"),
    ),
}


def _held(table: str, dataset: str, key: str, column: str) -> str:
    """Amounts that a type does not hold."""
    problem = (
        f"CASE WHEN {t.too_wide(column)} THEN 'too large to be checked' WHEN {t.number(column, 'DECIMAL(12,2)')} IS NULL "
        "THEN 'too large for the curated table' END"
    )
    return f"""SELECT '{dataset}' AS dataset, {key} AS record_key, '{column}' AS column_name, {column} AS raw, {problem} AS problem
FROM {table} WHERE {t.is_number(column)}"""


def _computed(column: str, n: str) -> str:
    return f"""SELECT 'orders', order_id, '{column}', {t.written(n, '9')} || '000000000',
    CASE WHEN {n} IS NOT NULL AND {t.cents(n)} IS NULL THEN 'too large for the curated table' END
  FROM (SELECT o.order_id, {t.large_whole('o.quantity')} * p.price AS calculated, {t.nano('o.order_total')} AS total
    FROM fx_orders o JOIN prices p ON p.product_id = o.product_id)"""


_NOT_HELD = f"""SELECT * FROM (
  SELECT 'orders' AS dataset, order_id AS record_key, 'quantity' AS column_name, quantity AS raw,
    CASE WHEN {t.is_number('quantity')} AND {t.large_whole('quantity')} IS NOT NULL AND {t.integer('quantity')} IS NULL
      THEN 'too large for the curated table' END AS problem
  FROM fx_orders
  UNION ALL {_held('fx_orders', 'orders', 'order_id', 'order_total')}
  UNION ALL {_held('fx_products', 'products', 'product_id', 'unit_price')}
  UNION ALL {_held('fx_payments', 'payments', 'payment_id', 'amount')}
  UNION ALL {_computed('calculated_order_amount', 'calculated')}
  UNION ALL {_computed('order_amount_variance', '(total - calculated)')}) WHERE problem IS NOT NULL"""

_CURATED = ("dim_customer", "dim_product", "fact_order", "fact_payment", "fact_customer_issue")
_CELL = "replace(issue_description, '|', '\\|')"
_MONEY = "'$' || format('{{:,.2f}}', CAST({} AS DOUBLE))"


def statements() -> dict[str, str]:
    out: dict[str, str] = {
        "ingest_row_counts": query(
            _counts(
                {
                    "customers": "fx_customers", "products": "fx_products", "orders": "fx_orders",
                    "payments": "fx_payments", "support_tickets": "fx_tickets",
                }
            ),
            "fx_customers", "fx_products", "fx_orders", "fx_payments", "fx_tickets",
        ),
        "customer_id_drift": query(
            """SELECT customer_id, 'only on the left' AS problem FROM (SELECT customer_id FROM fx_customers EXCEPT SELECT customer_id FROM fx_tickets)
WHERE customer_id IS NOT NULL
UNION ALL SELECT customer_id, 'only on the right' FROM (SELECT customer_id FROM fx_tickets EXCEPT SELECT customer_id FROM fx_customers)
WHERE customer_id IS NOT NULL""",
            "fx_customers", "fx_tickets",
        ),
        "stg_customers_duplicates": query(
            "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY source_row) AS rn "
            "FROM fx_customers) WHERE rn > 1",
            "fx_customers",
        ),
        "stg_orders_duplicates": query(
            f"""SELECT * EXCLUDE (same, nth) FROM (SELECT *, row_number() OVER (PARTITION BY {t._KEPT} ORDER BY source_row) AS same,
  row_number() OVER (PARTITION BY order_id ORDER BY source_row) AS nth FROM fx_orders) WHERE same > 1 OR nth > 1""",
            "fx_orders",
        ),
        "parse_timestamp_formats": query(
            f"""SELECT source, source_row, raw, {t.timestamp('raw')} AS parsed, {t.timestamp('raw')} IS NOT NULL AS valid FROM (
  SELECT 'orders' AS source, source_row, order_ts AS raw FROM fx_orders
  UNION ALL SELECT 'customers', source_row, signup_date FROM fx_customers
  UNION ALL SELECT 'support_tickets', source_row, created_ts FROM fx_tickets)""",
            "fx_orders", "fx_customers", "fx_tickets",
        ),
        "coerce_decimal": query(
            f"SELECT source_row, order_total AS raw, {t.number('order_total')} AS amount FROM fx_orders", "fx_orders"
        ),
        "coerce_integer": query(
            f"SELECT source_row, quantity AS raw, CAST({t.whole('quantity')} AS BIGINT) AS number FROM fx_orders", "fx_orders"
        ),
        "standardize_country": query(
            f"SELECT source_row, country AS raw, {t.country('country')} AS standard FROM fx_customers", "fx_customers"
        ),
        "standardize_state": query(
            f"""SELECT source, source_row, raw, {t.state('raw')} AS standard FROM (
  SELECT 'customers' AS source, source_row, state AS raw FROM fx_customers
  UNION ALL SELECT 'orders', source_row, shipping_state FROM fx_orders)""",
            "fx_customers", "fx_orders",
        ),
        "geo_before_after": query(
            f"""SELECT country_raw, state_raw, country, state, count(*) AS n FROM (
  SELECT country AS country_raw, state AS state_raw, {t.country('country')} AS country, {t.state('state')} AS state FROM fx_customers)
GROUP BY ALL""",
            "fx_customers",
        ),
        "normalize_email": query(
            f"SELECT source_row, email AS raw, {t.email('email')} AS email FROM fx_customers", "fx_customers"
        ),
        "email_syntax_valid": query(
            f"SELECT source_row, email AS raw, {t.email_ok('email')} AS valid FROM fx_customers", "fx_customers"
        ),
        "read_csv_products": query(
            "SELECT product_id, replace(product_name, ' ', chr(10)) AS product_name, category, unit_price, active_flag FROM fx_products",
            "fx_products",
        ),
        "read_jsonl_tickets": query("SELECT * EXCLUDE (source_row) FROM fx_tickets", "fx_tickets"),
        "dedup_exact_kept_from_files": query("SELECT * EXCLUDE (source_row) FROM orders_kept", "orders_kept"),
        "dedup_pk_winners_from_files": query(
            "SELECT * EXCLUDE (source_row) FROM fx_customers QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY source_row) = 1",
            "fx_customers",
        ),
        "exceptions_from_files": query("SELECT * FROM exceptions", "exceptions"),
        "export_csv_exceptions": query("SELECT * FROM exceptions WHERE dataset IN ('orders', 'payments')", "exceptions"),
        "dedup_exact_kept": query("SELECT * FROM orders_kept", "orders_kept"),
        "dedup_exact_dropped": query(
            f"SELECT * EXCLUDE (same) FROM (SELECT *, row_number() OVER (PARTITION BY {t._KEPT} ORDER BY source_row) AS same "
            "FROM fx_orders) WHERE same > 1",
            "fx_orders",
        ),
        "dedup_pk_winners": query(
            "SELECT * FROM fx_customers QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY source_row) = 1",
            "fx_customers",
        ),
        "dedup_pk_losers": query(
            "SELECT * FROM fx_orders QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY source_row) > 1", "fx_orders"
        ),
        "dedup_pk_winners_lineitem": (
            f"SELECT {_COLUMNS['lineitem']} FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber "
            "ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, "
            "l_shipdate) = 1"
        ),
        "soft_duplicate_flag": query(
            """SELECT source_row, first_name, last_name, phone, first_name IS NOT NULL AND last_name IS NOT NULL AND phone IS NOT NULL
  AND row_number() OVER (PARTITION BY first_name, last_name, phone ORDER BY source_row) > 1 AS duplicate_resolution_flag
FROM fx_customers""",
            "fx_customers",
        ),
        "exceptions_ranked": query(
            """SELECT *, CASE severity WHEN 'High' THEN 0 WHEN 'Medium' THEN 1 WHEN 'Low' THEN 2 ELSE 99 END AS severity_rank
FROM exceptions""",
            "exceptions",
        ),
        "exceptions_by_detection": query(
            "SELECT TIMESTAMP '2025-06-01 00:00:00' AS detected_at, dataset, count(*) AS n FROM exceptions GROUP BY dataset", "exceptions"
        ),
        "dq_exceptions_filtered": query(
            "SELECT * FROM exceptions WHERE rule_id IN ('DQ002', 'DQ007', 'DQ009') AND severity IN ('High')", "exceptions"
        ),
        "q1_revenue_by_month": query(_Q1, "fact_order"),
        "q2_top_customers": query(_Q2, "fact_order", "dim_customer"),
        "q3_order_exceptions": query(_Q3_FLAT, *_Q3_READS),
        "q3_order_issues": query(_ISSUES, *_Q3_READS),
        "q3_filtered_by_rule": query(
            f"SELECT * FROM ({_Q3_FLAT}) WHERE triggered_rules LIKE '%DQ006%' OR triggered_rules LIKE '%DQ010%'", *_Q3_READS
        ),
        "q3_distinct_rules": query(
            f"""SELECT (SELECT count(*) FROM ({_Q3})) AS order_lines,
  (SELECT count(DISTINCT r) FROM (SELECT unnest(rule_list) AS r FROM ({_Q3}))) AS distinct_rules""",
            *_Q3_READS,
        ),
        "q3_summary": query(
            """SELECT rule_id, count(*) AS n FROM exceptions WHERE dataset IN ('orders', 'payments') GROUP BY 1
UNION ALL SELECT 'total', count(*) FROM exceptions WHERE dataset IN ('orders', 'payments')""",
            "exceptions",
        ),
        "q4_revenue_by_state": query(_Q4, "fact_order"),
        "q5_sentiment_link": query(_Q5, *_Q5_READS),
        "q5_per_customer_detail": query(_DETAIL, *_Q5_READS),
        "orders_missing_payment": query(
            """SELECT * FROM fact_order o WHERE order_status = 'completed'
  AND NOT EXISTS (SELECT 1 FROM fact_payment p WHERE p.order_key = o.order_key)""",
            "fact_order", "fact_payment",
        ),
        "dq_summary": query(
            """SELECT count(*) AS total_exceptions, count(DISTINCT rule_id) AS unique_rules,
  count(*) FILTER (severity = 'High') AS high, count(*) FILTER (severity = 'Medium') AS medium FROM exceptions""",
            "exceptions",
        ),
        "dq_by_severity": query("SELECT severity, count(*) AS n FROM exceptions GROUP BY 1", "exceptions"),
        "dq_by_rule": query(
            """SELECT r.rule_id, replace(r.description, '|', '\\|') AS description, r.severity, count(*) AS violations
FROM exceptions e JOIN rules r ON r.rule_id = e.rule_id GROUP BY 1, 2, 3""",
            "exceptions",
        ),
        "dq_by_rule_severity": query(
            "SELECT rule_id, severity, count(*) AS n FROM exceptions GROUP BY 1, 2", "exceptions"
        ),
        "rule_reference": query(
            """SELECT r.*, (SELECT count(*) FROM exceptions e WHERE e.rule_id = r.rule_id) AS violations FROM rules r""",
            "exceptions",
        ),
        "dq_samples_per_rule": query(
            f"""SELECT r.rule_id, sample, record_key, s.severity,
  CASE WHEN length({_CELL}) > 120 THEN substr({_CELL}, 1, 117) || '...' ELSE {_CELL} END AS issue
FROM rules r LEFT JOIN (
  SELECT *, CAST(row_number() OVER (PARTITION BY rule_id ORDER BY record_key NULLS LAST, issue_description) AS INTEGER) AS sample
  FROM exceptions QUALIFY sample <= 5) s ON s.rule_id = r.rule_id""",
            "exceptions",
        ),
        "kpi_metrics": query(
            """SELECT (SELECT count(*) FROM dim_customer) AS total_customers,
  (SELECT CAST(coalesce(round(sum(gross_order_amount), 2), 0) AS DECIMAL(22,2)) FROM fact_order
   WHERE order_status = 'completed') AS completed_revenue,
  (SELECT count(*) FROM exceptions) AS total_exceptions""",
            "dim_customer", "fact_order", "exceptions",
        ),
        "curated_row_counts": query(
            _counts({**{n: n for n in _CURATED}, "dq_exception_report": "exceptions"}), *_CURATED, "exceptions"
        ),
        "reconcile_totals": query(
            f"""SELECT measure, CAST(curated_total AS DECIMAL(22,2)) AS curated_total, CAST(raw_total AS DECIMAL(22,2)) AS raw_total,
  CAST(curated_total - raw_total AS DECIMAL(22,2)) AS difference FROM (
  SELECT 'completed orders' AS measure,
    (SELECT coalesce(sum(gross_order_amount), 0) FROM fact_order WHERE order_status = 'completed') AS curated_total,
    (SELECT coalesce(sum({t.number('order_total')}), 0) FROM (SELECT DISTINCT {t._KEPT} FROM fx_orders)
     WHERE order_status = 'completed') AS raw_total
  UNION ALL SELECT 'settled payments',
    (SELECT coalesce(sum(payment_amount), 0) FROM fact_payment WHERE payment_status = 'settled'),
    (SELECT coalesce(sum({t.number('amount')}), 0) FROM fx_payments WHERE payment_status = 'settled'))""",
            "fact_order", "fx_orders", "fact_payment", "fx_payments",
        ),
        "dq010_disagreeing_totals": query(t.DISAGREEING_TOTALS, "fx_payments", "orders_kept"),
        "numbers_not_held": query(_NOT_HELD, "fx_orders", "fx_products", "fx_payments", "prices"),
        "table_profile": query(
            " UNION ALL ".join(
                f"SELECT '{table}' AS table_name, CAST({i} AS INTEGER) AS position, '{column}' AS column_name, '{kind}' AS data_type, "
                f"(SELECT count(*) FROM {table}) AS row_count, (SELECT count({column}) FROM {table}) AS filled"
                for table, columns in _PROFILED.items()
                for i, (column, kind) in enumerate(columns)
            ),
            *_PROFILED,
        ),
        "rule_samples_dq005": query(
            "SELECT * FROM exceptions WHERE rule_id = 'DQ005' ORDER BY record_key NULLS LAST, issue_description LIMIT 5", "exceptions"
        ),
        "preview_dim_product": query("SELECT * FROM dim_product ORDER BY product_key, unit_price LIMIT 100", "dim_product"),
        "finding_q1": query(
            f"""SELECT CASE WHEN count(*) = 0 THEN 'No completed orders with valid order dates were found.' ELSE
  'Total completed revenue is ' || {_MONEY.format('sum(completed_revenue)')} || ' across ' || CAST(sum(completed_orders) AS VARCHAR)
  || ' orders. Peak month is ' || first(strftime(month, '%Y-%m') ORDER BY completed_revenue DESC, month) || ' with '
  || {_MONEY.format('max(completed_revenue)')} || ' from '
  || CAST(first(completed_orders ORDER BY completed_revenue DESC, month) AS VARCHAR) || ' orders.' END AS finding FROM ({_Q1})""",
            "fact_order",
        ),
        "finding_q2": query(
            f"""SELECT 'Top customer is ' || customer_key || ' (' || full_name || ', ' || coalesce(standard_state, '<missing>')
  || ') with ' || {_MONEY.format('completed_value')} || ' across ' || completed_orders || ' completed orders.' AS finding
FROM ({_Q2}) ORDER BY completed_value DESC NULLS LAST, customer_key LIMIT 1""",
            "fact_order", "dim_customer",
        ),
        "finding_q3": query(
            f"""SELECT CASE WHEN count(*) = 0 THEN 'No orders triggered data-quality or reconciliation exceptions.' ELSE
  count(*) || ' distinct orders triggered at least one exception. Affected order keys are in q3_order_exceptions.' END AS finding
FROM ({_Q3})""",
            *_Q3_READS,
        ),
        "finding_q4": query(
            f"""SELECT 'Top revenue state is ' || state || ' with ' || {_MONEY.format('completed_revenue')} || ' from '
  || completed_orders || ' completed orders.' AS finding
FROM ({_Q4}) ORDER BY completed_revenue DESC NULLS LAST, state LIMIT 1""",
            "fact_order",
        ),
        "finding_q5": query(
            f"""SELECT 'Among ' || coalesce(max(customer_count) FILTER (cohort = 'has_negative_ticket'), 0)
  || ' customers with negative support tickets, '
  || CAST(round(CAST(coalesce(max(pct_orders_with_exception) FILTER (cohort = 'has_negative_ticket'), 0) AS DECIMAL(7,2)), 1)
     AS DECIMAL(7,1)) || '% of their orders triggered exceptions, versus '
  || CAST(round(CAST(coalesce(max(pct_orders_with_exception) FILTER (cohort = 'no_negative_ticket'), 0) AS DECIMAL(7,2)), 1)
     AS DECIMAL(7,1)) || '% for customers without negative tickets.' AS finding FROM ({_Q5})""",
            *_Q5_READS,
        ),
    }
    for name in _CURATED:
        out[name] = query(f"SELECT * FROM {name}", name)
    names = {
        "DQ001": "dq001_customer_unique", "DQ002": "dq002_email", "DQ003": "dq003_geo_standardization",
        "DQ004": "dq004_order_unique", "DQ005": "dq005_order_customer_fk", "DQ006": "dq006_order_product_fk",
        "DQ007": "dq007_order_quantity", "DQ008": "dq008_order_total", "DQ009": "dq009_payment_order_fk",
        "DQ010": "dq010_payment_amount", "DQ011": "dq011_ticket_timestamp", "DQ012": "dq012_ticket_customer_fk",
    }
    for rule_id, name in names.items():
        out[name] = _rule(rule_id)
    out["read_sources_row_counts"] = out["ingest_row_counts"]
    return out
