"""Cleaning rules, curated tables and the exception report as SQL."""

from __future__ import annotations

from tidyledger.oracle import feeds
from tidyledger.rules.registry import ACTIONS, RULES

# Fixed values, stated here once more so that the oracle does not check constants against themselves: timestamp formats,
# spellings of USA, state codes and names, last labels of addresses reserved for special use, words for active.
_FORMATS = (
    "%Y-%m-%dT%H:%M:%S+02:00", "%Y-%m-%dT%H:%M:%SZ", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d %H:%M:%S", "%Y-%m-%d %H:%M", "%Y/%m/%d %H:%M:%S",
    "%Y/%m/%d %H:%M", "%m/%d/%Y %H:%M", "%m-%d-%Y %H:%M", "%Y-%m-%d", "%Y/%m/%d", "%m/%d/%Y", "%m-%d-%Y",
)


_USA = ("united states of america", "united states", "usa", "us", "u.s.a.", "u.s.")
_ACTIVE = ("1", "TRUE", "Y", "YES")
_RESERVED = ("test", "localhost", "local", "invalid", "arpa", "onion")
_STATES = """
AL Alabama, AK Alaska, AZ Arizona, AR Arkansas, CA California, CO Colorado, CT Connecticut, DE Delaware,
DC District of Columbia, FL Florida, GA Georgia, HI Hawaii, ID Idaho, IL Illinois, IN Indiana, IA Iowa, KS Kansas,
KY Kentucky, LA Louisiana, ME Maine, MD Maryland, MA Massachusetts, MI Michigan, MN Minnesota, MS Mississippi,
MO Missouri, MT Montana, NE Nebraska, NV Nevada, NH New Hampshire, NJ New Jersey, NM New Mexico, NY New York,
NC North Carolina, ND North Dakota, OH Ohio, OK Oklahoma, OR Oregon, PA Pennsylvania, RI Rhode Island,
SC South Carolina, SD South Dakota, TN Tennessee, TX Texas, UT Utah, VT Vermont, VA Virginia, WA Washington,
WV West Virginia, WI Wisconsin, WY Wyoming
"""
_STATE_OF = [entry.strip().split(" ", 1) for entry in _STATES.replace("\n", " ").split(",")]


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def q_list(values) -> str:
    return ", ".join(q(v) for v in values)


def strip(c: str) -> str:
    return f"trim({c}, E' \\t\\r\\n')"


def timestamp(c: str) -> str:
    return f"try_strptime({strip(c)}, [{q_list(_FORMATS)}])"


def date(c: str) -> str:
    return f"CAST({timestamp(c)} AS DATE)"


def number(c: str, kind: str = "DECIMAL(23,8)") -> str:
    return f"TRY_CAST(replace({strip(c)}, '_', '') AS {kind})"


def whole(c: str) -> str:
    d = number(c, "DECIMAL(38,18)")
    return f"CASE WHEN {d} = floor({d}) THEN TRY_CAST({d} AS DECIMAL(14,0)) END"


def integer(c: str) -> str:
    return f"TRY_CAST({whole(c)} AS INTEGER)"


def nano(c: str) -> str:
    """The number in units of 10^-9, which holds every digit of the seeds."""
    return f"TRY_CAST(replace(CAST({number(c, 'DECIMAL(38,9)')} AS VARCHAR), '.', '') AS HUGEINT)"


def large_whole(c: str) -> str:
    d = number(c, "DECIMAL(38,18)")
    return f"CASE WHEN {d} = floor({d}) THEN CAST(TRY_CAST({d} AS DECIMAL(18,0)) AS HUGEINT) END"


def written(n: str, decimals: str) -> str:
    """A number in units of 10^-9 as text."""
    return (
        f"(CASE WHEN {n} < 0 THEN '-' ELSE '' END || CAST(abs({n}) // 1000000000 AS VARCHAR) || CASE WHEN ({decimals}) > 0 "
        f"THEN '.' || left(lpad(CAST(abs({n}) % 1000000000 AS VARCHAR), 9, '0'), ({decimals})::INTEGER) ELSE '' END)"
    )


def cents(n: str) -> str:
    return f"TRY_CAST({written(n, '9')} AS DECIMAL(12,2))"


def is_number(c: str) -> str:
    return f"coalesce(regexp_full_match(replace({strip(c)}, '_', ''), '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?'), FALSE)"


def oversized(c: str) -> str:
    d = number(c, "DECIMAL(38,18)")
    return f"({is_number(c)} AND {whole(c)} IS NULL AND coalesce({d} = floor({d}), TRUE))"


def places(c: str) -> str:
    text = f"replace({strip(c)}, '_', '')"
    return f"CASE WHEN regexp_matches({text}, '[eE]') THEN 8 ELSE length(regexp_extract({text}, '[.]([0-9]+)$', 1)) END"


def too_wide(c: str) -> str:
    """More than 36 digits before the point."""
    return f"regexp_full_match(replace({strip(c)}, '_', ''), '[+-]?0*[1-9][0-9]{{36,}}([.].*)?')"


def money(expr: str) -> str:
    return f"TRY_CAST({expr} AS DECIMAL(12,2))"


def country(c: str) -> str:
    return (
        f"CASE WHEN lower({strip(c)}) IN ({q_list(_USA)}) THEN 'USA' ELSE nullif({strip(c)}, '') END"
    )


def state(c: str) -> str:
    names = " ".join(f"WHEN {q(name.lower())} THEN {q(code)}" for code, name in _STATE_OF)
    return (
        f"CASE WHEN upper({strip(c)}) IN ({q_list(code for code, _ in _STATE_OF)}) THEN upper({strip(c)}) "
        f"ELSE CASE lower({strip(c)}) {names} ELSE nullif({strip(c)}, '') END END"
    )


def email(c: str) -> str:
    return f"nullif(lower({strip(c)}), '')"


def email_ok(c: str) -> str:
    """Checked part by part: atoms before the sign, labels after it."""
    s = strip(c)
    local, domain = f"split_part({s}, '@', 1)", f"split_part({s}, '@', 2)"
    atom, letter = "[\\p{L}\\p{M}\\p{N}!#$%&''*+/=?^_`{|}~-]+", "[\\p{L}\\p{M}\\p{N}-]+"
    atoms = f"list_bool_and(list_transform(string_split({local}, '.'), lambda x: regexp_full_match(x, '{atom}')))"
    label = (
        f"regexp_full_match(x, '{letter}') AND length(x) <= 63 AND NOT starts_with(x, '-') AND NOT ends_with(x, '-') "
        "AND regexp_matches(x, '^[\\p{L}\\p{N}]')"
    )
    labels = f"list_bool_and(list_transform(string_split({domain}, '.'), lambda x: {label}))"
    last = f"lower(string_split({domain}, '.')[-1])"
    return (
        f"coalesce(len(string_split({s}, '@')) = 2 AND {atoms} AND {labels} AND len(string_split({domain}, '.')) >= 2 "
        f"AND regexp_matches({s}, '\\p{{L}}$') AND length({s}) <= 254 AND length({local}) <= 64 AND length({domain}) <= 253 "
        f"AND {last} NOT IN ({q_list(_RESERVED)}), FALSE)"
    )


_KEPT = "order_id, customer_id, order_ts, product_id, quantity, order_status, shipping_state, order_total"

DIM_CUSTOMER = f"""
SELECT customer_id AS customer_key, {strip('first_name')} || ' ' || {strip('last_name')} AS full_name,
  {email('email')} AS email, phone, {country('country')} AS standard_country, {state('state')} AS standard_state,
  {date('signup_date')} AS signup_date, loyalty_tier,
  first_name IS NOT NULL AND last_name IS NOT NULL AND phone IS NOT NULL AND row_number() OVER (
    PARTITION BY first_name, last_name, phone ORDER BY source_row) > 1 AS duplicate_resolution_flag
FROM (SELECT * FROM fx_customers QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY source_row) = 1)
"""

DIM_PRODUCT = f"""
SELECT product_id AS product_key, product_name, category, {number('unit_price', 'DECIMAL(12,2)')} AS unit_price,
  coalesce(upper({strip('active_flag')}) IN ({q_list(_ACTIVE)}), FALSE) AS active_flag
FROM fx_products
"""

ORDERS_KEPT = f"SELECT * FROM fx_orders QUALIFY row_number() OVER (PARTITION BY {_KEPT} ORDER BY source_row) = 1"

PRICES = f"""
SELECT product_id, unit_price, {nano('unit_price')} AS price FROM fx_products
QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY source_row) = 1
"""

FACT_ORDER = f"""
SELECT order_id AS order_key, customer_id AS customer_key, o.product_id AS product_key, order_date, quantity,
  order_status, shipping_state, gross AS gross_order_amount,
  {cents('(n * price)')} AS calculated_order_amount, {cents('(total - n * price)')} AS order_amount_variance
FROM (SELECT order_id, customer_id, product_id, {date('order_ts')} AS order_date, {large_whole('quantity')} AS n,
        {integer('quantity')} AS quantity, order_status, {state('shipping_state')} AS shipping_state,
        {number('order_total', 'DECIMAL(12,2)')} AS gross, {nano('order_total')} AS total
      FROM orders_kept) o
LEFT JOIN prices p ON p.product_id = o.product_id
"""

FACT_PAYMENT = f"""
SELECT payment_id AS payment_key, order_id AS order_key, {date('payment_ts')} AS payment_date, payment_method,
  payment_status, {number('amount', 'DECIMAL(12,2)')} AS payment_amount
FROM fx_payments
"""

FACT_CUSTOMER_ISSUE = f"""
SELECT ticket_id, customer_id AS customer_key, {date('created_ts')} AS created_date, channel,
  category AS issue_category, sentiment, description
FROM fx_tickets
"""

RULE_TABLE = "SELECT * FROM (VALUES {}) AS r(rule_id, dataset, description, severity, suggested_action)".format(
    ", ".join("(" + q_list((*rule, ACTIONS[rule[0]])) + ")" for rule in RULES)
)


def _done(c: str, word: str) -> str:
    return f"lower({strip(c)}) = '{word}'"


# Each rule: (record_key, issue_description).
RULE_SQL = {
    "DQ001": """
SELECT customer_id AS record_key, 'Duplicate customer_id=' || coalesce(customer_id, '<missing>') || '; this row (email='
  || coalesce(email, '<missing>') || ') was dropped in favour of the canonical first occurrence.' AS issue_description
FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY source_row) AS rn FROM fx_customers) WHERE rn > 1""",
    "DQ002": f"""
SELECT customer_id AS record_key, CASE WHEN {email('email')} IS NULL THEN 'customer_id=' || coalesce(customer_id, '<missing>') || ': email is missing.'
  ELSE 'customer_id=' || coalesce(customer_id, '<missing>') || ': email ''' || email || ''' failed syntactic validation.' END AS issue_description
FROM fx_customers WHERE NOT {email_ok('email')}""",
    "DQ003": f"""
SELECT customer_id AS record_key, 'customer_id=' || coalesce(customer_id, '<missing>') || ': ' || concat_ws('; ',
    CASE WHEN bad_c THEN 'country ''' || country || ''' standardized to ''' || sc || '''' END,
    CASE WHEN bad_s THEN 'state ''' || state || ''' standardized to ''' || ss || '''' END) || '.' AS issue_description
FROM (SELECT *, coalesce({strip('country')} <> sc, FALSE) AS bad_c, coalesce({strip('state')} <> ss, FALSE) AS bad_s
      FROM (SELECT *, {country('country')} AS sc, {state('state')} AS ss FROM fx_customers))
WHERE bad_c OR bad_s""",
    "DQ004": f"""
SELECT order_id AS record_key, 'Duplicate order_id=' || coalesce(order_id, '<missing>') || CASE WHEN same > 1
  THEN '; identical row was dropped (no information lost).'
  ELSE '; later occurrence with different attributes was dropped in favour of the canonical first row.' END AS issue_description
FROM (SELECT *, row_number() OVER (PARTITION BY {_KEPT} ORDER BY source_row) AS same,
        row_number() OVER (PARTITION BY order_id ORDER BY source_row) AS nth FROM fx_orders) WHERE same > 1 OR nth > 1""",
    "DQ005": """
SELECT order_id AS record_key, 'order_id=' || coalesce(order_id, '<missing>') || CASE WHEN customer_id IS NULL THEN ': customer_id is missing.'
  ELSE ': customer_id ''' || customer_id || ''' not found in customers.' END AS issue_description
FROM fx_orders o WHERE NOT EXISTS (SELECT 1 FROM fx_customers c WHERE c.customer_id = o.customer_id)""",
    "DQ006": """
SELECT order_id AS record_key, 'order_id=' || coalesce(order_id, '<missing>') || CASE WHEN product_id IS NULL THEN ': product_id is missing.'
  ELSE ': product_id ''' || product_id || ''' not found in products.' END AS issue_description
FROM fx_orders o WHERE NOT EXISTS (SELECT 1 FROM fx_products p WHERE p.product_id = o.product_id)""",
    "DQ007": f"""
SELECT order_id AS record_key, 'order_id=' || coalesce(order_id, '<missing>') || ': completed-order quantity ' || CASE
    WHEN quantity IS NULL THEN 'is missing.' WHEN n <= 0 THEN CAST(n AS VARCHAR) || ' is not positive.'
    WHEN large THEN replace({strip('quantity')}, '_', '') || ' is not positive.'
    ELSE '''' || quantity || ''' is not a valid integer.' END AS issue_description
FROM (SELECT order_id, quantity, {whole('quantity')} AS n, {oversized('quantity')} AS large
      FROM fx_orders WHERE {_done('order_status', 'completed')})
WHERE quantity IS NULL OR n <= 0 OR (n IS NULL AND (NOT large OR starts_with({strip('quantity')}, '-')))""",
    "DQ008": f"""
SELECT order_id AS record_key, 'order_id=' || coalesce(order_id, '<missing>') || ': order_total=' || replace({strip('order_total')}, '_', '')
  || ' vs quantity*unit_price=' || {written('calculated', places('unit_price'))} || ' (diff='
  || {written('(total - calculated)', f"greatest({places('order_total')}, {places('unit_price')})")} || ').' AS issue_description
FROM (SELECT o.*, p.unit_price, {nano('order_total')} AS total, {large_whole('quantity')} * p.price AS calculated
      FROM fx_orders o JOIN prices p ON p.product_id = o.product_id) WHERE abs(total - calculated) > 10000000""",
    "DQ009": """
SELECT payment_id AS record_key, CASE WHEN order_id IS NULL THEN 'payment_id=' || payment_id || ': payment order_id is missing.'
  ELSE 'Orphan payment: order_id=' || order_id || ' not found in orders (payment_id=' || payment_id || ').' END AS issue_description
FROM fx_payments p WHERE NOT EXISTS (SELECT 1 FROM fx_orders o WHERE o.order_id = p.order_id)""",
    "DQ010": f"""
SELECT payment_id AS record_key, 'payment_id=' || payment_id || ': settled payment ' || replace({strip('amount')}, '_', '')
  || ' != completed order total ' || replace({strip('order_total')}, '_', '') || ' (diff='
  || {written('(total - paid)', f"greatest({places('amount')}, {places('order_total')})")} || ').' AS issue_description
FROM (SELECT p.payment_id, p.amount, {nano('p.amount')} AS paid, o.order_total, {nano('o.order_total')} AS total
      FROM fx_payments p JOIN fx_orders o ON o.order_id = p.order_id
      WHERE {_done('payment_status', 'settled')} AND {_done('order_status', 'completed')}
        AND {nano('p.amount')} IS NOT NULL AND {nano('o.order_total')} IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY p.source_row ORDER BY abs({nano('o.order_total')} - {nano('p.amount')}) DESC,
        {nano('o.order_total')} DESC, o.order_total) = 1)
WHERE abs(total - paid) > 10000000""",
    "DQ011": f"""
SELECT ticket_id AS record_key, 'ticket_id=' || ticket_id || CASE WHEN coalesce({strip('created_ts')}, '') = ''
  THEN ': created_ts is missing.' ELSE ': created_ts failed to parse: ''' || created_ts || '''.' END AS issue_description
FROM fx_tickets WHERE {timestamp('created_ts')} IS NULL""",
    "DQ012": """
SELECT ticket_id AS record_key, 'ticket_id=' || ticket_id || CASE WHEN customer_id IS NULL THEN ': customer_id is missing.'
  ELSE ': customer_id ''' || customer_id || ''' not found in customers.' END AS issue_description
FROM fx_tickets t WHERE NOT EXISTS (SELECT 1 FROM fx_customers c WHERE c.customer_id = t.customer_id)""",
}

DISAGREEING_TOTALS = f"""
SELECT payment_id, order_id, order_total, 'payment_id=' || payment_id || ': settled payment ' || replace({strip('amount')}, '_', '')
  || ' != completed order total ' || replace({strip('order_total')}, '_', '') || ' (diff='
  || {written('(total - paid)', f"greatest({places('amount')}, {places('order_total')})")} || ').' AS issue_description
FROM (SELECT p.payment_id, p.order_id, p.amount, {nano('p.amount')} AS paid, o.order_total, {nano('o.order_total')} AS total
      FROM fx_payments p JOIN orders_kept o ON o.order_id = p.order_id
      WHERE {_done('payment_status', 'settled')} AND {_done('order_status', 'completed')})
WHERE abs(total - paid) > 10000000"""

EXCEPTIONS = """
SELECT r.rule_id, r.dataset, v.record_key, r.severity, v.issue_description, r.suggested_action
FROM ({}) v JOIN rules r ON r.rule_id = v.rule_id
""".format(" UNION ALL ".join(f"SELECT '{rule}' AS rule_id, * FROM ({sql})" for rule, sql in RULE_SQL.items()))

# name -> (sql, names it reads)
TABLES: dict[str, tuple[str, tuple[str, ...]]] = {
    "fx_products": (feeds.PRODUCTS, ()),
    "fx_customers": (feeds.CUSTOMERS, ()),
    "order_base": (feeds.ORDER_BASE, ()),
    "fx_orders": (feeds.ORDERS, ("order_base",)),
    "fx_payments": (feeds.PAYMENTS, ("order_base",)),
    "fx_tickets": (feeds.TICKETS, ()),
    "orders_kept": (ORDERS_KEPT, ("fx_orders",)),
    "prices": (PRICES, ("fx_products",)),
    "dim_customer": (DIM_CUSTOMER, ("fx_customers",)),
    "dim_product": (DIM_PRODUCT, ("fx_products",)),
    "fact_order": (FACT_ORDER, ("orders_kept", "prices")),
    "fact_payment": (FACT_PAYMENT, ("fx_payments",)),
    "fact_customer_issue": (FACT_CUSTOMER_ISSUE, ("fx_tickets",)),
    "rules": (RULE_TABLE, ()),
    "exceptions": (
        EXCEPTIONS,
        ("rules", "fx_customers", "fx_products", "fx_orders", "orders_kept", "prices", "fx_payments", "fx_tickets"),
    ),
}


def query(sql: str, *reads: str) -> str:
    """The statement with the tables it reads, and theirs, in front."""
    order: list[str] = []

    def need(name: str) -> None:
        for inner in TABLES[name][1]:
            need(inner)
        if name not in order:
            order.append(name)

    for name in reads:
        need(name)
    if not order:
        return sql.strip()
    return "WITH " + ",\n".join(f"{name} AS ({TABLES[name][0].strip()})" for name in order) + "\n" + sql.strip()
