"""The derived feeds of FIXTURES.md as SQL common table expressions."""

from __future__ import annotations


def pick(n: str, *choices: str | None) -> str:
    whens = " ".join(
        f"WHEN {i} THEN {'NULL' if c is None else repr(c)}" for i, c in enumerate(choices)
    )
    return f"(CASE ({n}) % {len(choices)} {whens} END)"


_PRODUCT = """
SELECT 'P' || p_partkey AS product_id, p_name AS product_name, p_type AS category,
  CASE WHEN p_partkey % 59 = 7 THEN 'n/a' WHEN p_partkey % 401 = 8 THEN '1.5e2'
       WHEN p_partkey % 409 = 9 THEN '99.123456789'
       ELSE CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) END AS unit_price,
  CASE WHEN p_partkey % 10 = 0 THEN 'N' WHEN p_partkey % 10 = 1 THEN ' yes '
       WHEN p_partkey % 31 = 5 THEN NULL ELSE 'Y' END AS active_flag,
  p_partkey * 2 AS source_row
FROM part
"""

PRODUCTS = f"""
{_PRODUCT}
UNION ALL SELECT * REPLACE ('1.00' AS unit_price, source_row + 1 AS source_row) FROM ({_PRODUCT})
WHERE (source_row // 2) % 50 = 3
"""

_CUSTOMER = f"""
SELECT CASE WHEN k % 113 <> 9 THEN 'C' || k END AS customer_id, 'First' || (b % 50) AS first_name, 'Last' || b AS last_name,
  CASE WHEN k % 13 = 5 THEN NULL WHEN k % 13 = 6 THEN '  ' WHEN k % 19 = 4 THEN 'bad..' || k || '@x.com'
       WHEN k % 17 = 2 THEN ' U' || k || '@Example.COM ' ELSE 'u' || k || '@example.com' END AS email,
  CASE WHEN b % 11 = 3 THEN NULL ELSE '555-' || b END AS phone,
  {pick("k", "US", "United States", "u.s.a.", "Canada", "USA ", "USA")} AS country,
  {pick("n", "IL", "Illinois", "ca", "New York", " TX ", "Texas", "Ontario", None, "FL")} AS state,
  {pick("k", "2025-01-04", "01/12/2025", "2025/01/14", "03-06-2025", "2025-13-40")} AS signup_date,
  {pick("k", "Gold", "Silver", "Bronze")} AS loyalty_tier,
  k * 2 AS source_row, k
FROM (SELECT c_custkey AS k, c_nationkey AS n, CASE WHEN c_custkey % 97 = 1 THEN c_custkey - 1 ELSE c_custkey END AS b
      FROM customer)
"""

CUSTOMERS = f"""
SELECT * EXCLUDE (k) FROM ({_CUSTOMER})
UNION ALL
SELECT * EXCLUDE (k) REPLACE ('alt' || k || '@example.com' AS email, 'NY' AS state, source_row + 1 AS source_row)
FROM ({_CUSTOMER}) WHERE k % 50 = 7
"""

_TOTAL = """CASE WHEN o % 103 = 7 THEN 'n/a' WHEN o % 317 = 12 THEN '123456789012345.67'
  WHEN o % 331 = 13 THEN due || '000001' WHEN o % 337 = 14 THEN '1.5e3' WHEN o % 347 = 15 THEN '1_000.00'
  WHEN o % 349 = 17 THEN '1234567890123456.00' WHEN o % 359 = 18 THEN '1234567890123456789012345678901234567.5'
  WHEN o % 367 = 19 THEN CAST(CAST(due + 0.01 AS DECIMAL(12,2)) AS VARCHAR) || '0000001'
  ELSE CAST(CAST(due + CASE WHEN o % 101 = 0 THEN 6 ELSE 0 END AS DECIMAL(12,2)) AS VARCHAR) END"""

ORDER_BASE = """
SELECT o_orderkey AS o, o_custkey AS c, o_orderstatus AS status, substr(CAST(o_orderdate AS VARCHAR), 1, 10) AS d,
  CAST(coalesce(CAST(p_retailprice AS DECIMAL(12,2)), 1.00) * (CASE WHEN o_orderkey % 5 = 0 THEN 2 ELSE o_orderkey % 5 END)
    AS DECIMAL(12,2)) AS due
FROM orders LEFT JOIN part ON p_partkey = o_custkey
"""

_ORDER = f"""
SELECT CASE WHEN o % 499 <> 5 THEN 'O' || o END AS order_id,
  CASE WHEN o % 89 = 0 THEN 'C-1' WHEN o % 97 = 1 THEN NULL ELSE 'C' || c END AS customer_id,
  CASE o % 7 WHEN 0 THEN d || ' 10:15:00'
    WHEN 1 THEN substr(d, 6, 2) || '/' || substr(d, 9, 2) || '/' || substr(d, 1, 4) || ' 14:20'
    WHEN 2 THEN replace(d, '-', '/') || ' 09:00' WHEN 3 THEN d || 'T16:45:00Z' WHEN 4 THEN d || ' 11:30'
    WHEN 5 THEN substr(d, 6, 2) || '-' || substr(d, 9, 2) || '-' || substr(d, 1, 4) || ' 16:30'
    ELSE CASE WHEN o % 301 = 6 THEN 'bad_timestamp' WHEN o % 11 = 3 THEN d || 'T08:30:00+02:00' ELSE d END END AS order_ts,
  CASE WHEN o % 83 = 1 THEN 'P-1' WHEN o % 101 = 2 THEN NULL ELSE 'P' || c END AS product_id,
  CASE WHEN o % 71 = 2 THEN '-1' WHEN o % 73 = 3 THEN NULL WHEN o % 79 = 4 THEN '1.5' WHEN o % 307 = 9 THEN '3000000000'
       WHEN o % 311 = 10 THEN '1e1' WHEN o % 313 = 11 THEN '1_0' WHEN o % 353 = 16 THEN '123456789012345678'
       WHEN o % 5 = 0 THEN '2.0' ELSE CAST(o % 5 AS VARCHAR) END AS quantity,
  CASE WHEN status = 'F' THEN 'completed' WHEN status = 'O' AND o % 10 = 0 THEN ' Completed '
       WHEN status = 'O' THEN 'returned' ELSE 'cancelled' END AS order_status,
  {pick("c", "IL", "Illinois", "ca", "Texas", "WA", None, "Florida")} AS shipping_state,
  {_TOTAL} AS order_total, o * 8 AS source_row, o, c, due
FROM order_base
"""

_BASE_ONLY = "* EXCLUDE (o, c, due)"


def _copy(n: int, condition: str, change: str = "") -> str:
    """One more row of every order that meets the condition."""
    replaced = f"{change}, " if change else ""
    return f"SELECT {_BASE_ONLY} REPLACE ({replaced}source_row + {n} AS source_row) FROM ({_ORDER}) WHERE {condition}"


ORDERS = " UNION ALL ".join(
    [
        f"SELECT {_BASE_ONLY} FROM ({_ORDER})",
        _copy(1, "o % 61 = 0"),
        _copy(2, "o % 67 = 1 AND c % 7 IN (0, 1)", "CASE c % 7 WHEN 0 THEN 'NV' ELSE 'Nevada' END AS shipping_state"),
        _copy(3, "o % 183 = 0"),
        _copy(4, "o % 71 = 7", "CAST(CAST(due + 1 AS DECIMAL(12,2)) AS VARCHAR) AS order_total"),
        _copy(5, "o % 142 = 7", "CAST(CAST(due - 5 AS DECIMAL(12,2)) AS VARCHAR) AS order_total"),
    ]
)

PAYMENTS = f"""
SELECT 'PMT' || o AS payment_id, CASE WHEN o % 211 = 3 THEN 'O-1' WHEN o % 223 = 4 THEN NULL ELSE 'O' || o END AS order_id,
  d || ' 10:16' AS payment_ts, {pick("o", "card", "paypal", "apple_pay")} AS payment_method,
  CASE WHEN status = 'P' THEN 'voided' WHEN status = 'O' AND o % 20 = 0 THEN ' Settled '
       WHEN status = 'O' AND o % 10 <> 0 THEN 'refunded' ELSE 'settled' END AS payment_status,
  CASE WHEN o % 107 = 0 THEN '1.00' WHEN o % 109 = 1 THEN CAST(CAST(due AS DECIMAL(18,8)) + 0.01000001 AS VARCHAR)
       WHEN o % 127 = 3 THEN CAST(CAST(due + 0.01 AS DECIMAL(12,2)) AS VARCHAR) || '0000001'
       WHEN o % 113 = 2 THEN CAST(CAST(due + 0.01 AS DECIMAL(13,2)) AS VARCHAR) ELSE {_TOTAL} END AS amount, o AS source_row
FROM order_base
"""

TICKETS = f"""
SELECT 'T' || event_id AS ticket_id,
  CASE WHEN event_id % 37 = 0 THEN 'C-1' WHEN event_id % 43 = 1 THEN NULL ELSE 'C' || user_id END AS customer_id,
  CASE WHEN event_id % 41 = 0 THEN 'bad_timestamp' WHEN event_id % 47 = 1 THEN ' '
       ELSE replace(substr(CAST(ts AS VARCHAR), 1, 19), ' ', 'T') END AS created_ts,
  {pick("event_id", "email", "chat", "phone")} AS channel, event_type AS category,
  CASE WHEN event_type = 'error' AND user_id % 4 = 0 THEN 'Negative' WHEN event_type = 'signup' THEN 'positive'
       ELSE 'neutral' END AS sentiment,
  props AS description, event_id AS source_row
FROM events
"""
