"""Raw-shaped feeds with seeded defects, derived by Spark from the star-schema tables.

Every row of the base table is used once; the copies that seed duplicates are added to it. See FIXTURES.md for
the rules in words; the oracle states them again in DuckDB's SQL.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession

from tidyledger.rules.staging import Staging
from tidyledger.schemas import RAW_COLUMNS, SOURCE_ROW


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _pick(n: str, *choices: str | None) -> str:
    """choices[n % len(choices)]"""
    values = ", ".join("NULL" if c is None else f"'{c}'" for c in choices)
    return f"elt(cast({n} % {len(choices)} as int) + 1, {values})"


def _variants(*conditions: str) -> str:
    """0 for the row itself and i for each condition i that holds."""
    extra = "".join(f", if({c}, array({i}), array())" for i, c in enumerate(conditions, 1))
    return f"explode(concat(array(0){extra})) AS variant"


def _raw(df: DataFrame, table: str, columns: dict[str, str]) -> DataFrame:
    assert (*columns,) == (*RAW_COLUMNS[table], SOURCE_ROW)
    return df.selectExpr(*[f"{expr} AS {name}" for name, expr in columns.items()])


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _raw(
        _read(spark, sf_dir, "part"),
        "products",
        {
            "product_id": "concat('P', p_partkey)",
            "product_name": "p_name",
            "category": "p_type",
            "unit_price": "CASE WHEN p_partkey % 59 = 7 THEN 'n/a' WHEN p_partkey % 401 = 8 THEN '1.5e2' "
            "WHEN p_partkey % 409 = 9 THEN '99.123456789' "
            "ELSE cast(cast(p_retailprice AS decimal(12,2)) AS string) END",
            "active_flag": "CASE WHEN p_partkey % 10 = 0 THEN 'N' WHEN p_partkey % 10 = 1 THEN ' yes ' "
            "WHEN p_partkey % 31 = 5 THEN NULL ELSE 'Y' END",
            "source_row": "p_partkey * 2",
        },
    )
    return base.selectExpr("*", _variants("source_row div 2 % 50 = 3")).selectExpr(
        *[f"if(variant = 1, '1.00', {c}) AS {c}" if c == "unit_price" else c for c in RAW_COLUMNS["products"]],
        "source_row + variant AS source_row",
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS k",
        "c_nationkey AS n",
        "if(c_custkey % 97 = 1, c_custkey - 1, c_custkey) AS person",
    )
    base = _raw(
        rows,
        "customers",
        {
            "customer_id": "if(k % 113 = 9, NULL, concat('C', k))",
            "first_name": "concat('First', person % 50)",
            "last_name": "concat('Last', person)",
            "email": "CASE WHEN k % 13 = 5 THEN NULL "
            "WHEN k % 13 = 6 THEN '  ' WHEN k % 19 = 4 THEN concat('bad..', k, '@x.com') "
            "WHEN k % 17 = 2 THEN concat(' U', k, '@Example.COM ') ELSE concat('u', k, '@example.com') END",
            "phone": "if(person % 11 = 3, NULL, concat('555-', person))",
            "country": _pick("k", "US", "United States", "u.s.a.", "Canada", "USA ", "USA"),
            "state": _pick("n", "IL", "Illinois", "ca", "New York", " TX ", "Texas", "Ontario", None, "FL"),
            "signup_date": _pick("k", "2025-01-04", "01/12/2025", "2025/01/14", "03-06-2025", "2025-13-40"),
            "loyalty_tier": _pick("k", "Gold", "Silver", "Bronze"),
            "source_row": "k * 2",
        },
    )
    k = "source_row div 2"
    changed = {"email": f"if(variant = 1, concat('alt', {k}, '@example.com'), email)", "state": "if(variant = 1, 'NY', state)"}
    return base.selectExpr("*", _variants(f"{k} % 50 = 7")).selectExpr(
        *[f"{changed.get(c, c)} AS {c}" for c in RAW_COLUMNS["customers"]], "source_row + variant AS source_row"
    )


def _order_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with the price of the part that carries the customer's number, 1.00 where there is none."""
    part = _read(spark, sf_dir, "part").selectExpr(
        "p_partkey AS c", "cast(p_retailprice AS decimal(12,2)) AS price"
    )
    orders = _read(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS o", "o_custkey AS c", "o_orderstatus AS status", "left(cast(o_orderdate AS string), 10) AS d"
    )
    priced = orders.join(part, "c", "left")
    return priced.selectExpr(
        "o", "c", "status", "d",
        "cast(coalesce(price, 1.00) * cast(if(o % 5 = 0, 2, o % 5) AS int) AS decimal(12,2)) AS due",
    )


_TOTAL = (
    "CASE WHEN o % 103 = 7 THEN 'n/a' WHEN o % 317 = 12 THEN '123456789012345.67' "
    "WHEN o % 331 = 13 THEN concat(due, '000001') WHEN o % 337 = 14 THEN '1.5e3' WHEN o % 347 = 15 THEN '1_000.00' "
    "WHEN o % 349 = 17 THEN '1234567890123456.00' WHEN o % 359 = 18 THEN '1234567890123456789012345678901234567.5' "
    "WHEN o % 367 = 19 THEN concat(cast(due + 0.01 AS decimal(12,2)), '0000001') "
    "ELSE cast(cast(due + if(o % 101 = 0, 6, 0) AS decimal(12,2)) AS string) END"
)


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order, and further rows of some: identical ones (1, 3), another state (2), another total (4, 5)."""
    us_date = "substr(d, 6, 2), '{0}', right(d, 2), '{0}', left(d, 4)"
    state = _pick("c", "IL", "Illinois", "ca", "Texas", "WA", None, "Florida")
    collides = "o % 67 = 1 AND c % 7 IN (0, 1)"
    rows = _order_base(spark, sf_dir).selectExpr(
        "*", _variants("o % 61 = 0", collides, "o % 183 = 0", "o % 71 = 7", "o % 142 = 7")
    )
    return _raw(
        rows,
        "orders",
        {
            "order_id": "if(o % 499 = 5, NULL, concat('O', o))",
            "customer_id": "CASE WHEN o % 89 = 0 THEN 'C-1' WHEN o % 97 = 1 THEN NULL ELSE concat('C', c) END",
            "order_ts": "CASE o % 7 WHEN 0 THEN concat(d, ' 10:15:00') "
            f"WHEN 1 THEN concat({us_date.format('/')}, ' 14:20') WHEN 2 THEN concat(replace(d, '-', '/'), ' 09:00') "
            "WHEN 3 THEN concat(d, 'T16:45:00Z') WHEN 4 THEN concat(d, ' 11:30') "
            f"WHEN 5 THEN concat({us_date.format('-')}, ' 16:30') ELSE CASE WHEN o % 301 = 6 THEN 'bad_timestamp' "
            "WHEN o % 11 = 3 THEN concat(d, 'T08:30:00+02:00') ELSE d END END",
            "product_id": "CASE WHEN o % 83 = 1 THEN 'P-1' WHEN o % 101 = 2 THEN NULL ELSE concat('P', c) END",
            "quantity": "CASE WHEN o % 71 = 2 THEN '-1' WHEN o % 73 = 3 THEN NULL WHEN o % 79 = 4 THEN '1.5' "
            "WHEN o % 307 = 9 THEN '3000000000' WHEN o % 311 = 10 THEN '1e1' WHEN o % 313 = 11 THEN '1_0' "
            "WHEN o % 353 = 16 THEN '123456789012345678' "
            "WHEN o % 5 = 0 THEN '2.0' ELSE cast(o % 5 AS string) END",
            "order_status": "CASE WHEN status = 'F' THEN 'completed' WHEN status = 'O' AND o % 10 = 0 THEN ' Completed ' "
            "WHEN status = 'O' THEN 'returned' ELSE 'cancelled' END",
            "shipping_state": f"if(variant = 2, if(c % 7 = 0, 'NV', 'Nevada'), {state})",
            "order_total": "CASE variant WHEN 4 THEN cast(cast(due + 1 AS decimal(12,2)) AS string) "
            f"WHEN 5 THEN cast(cast(due - 5 AS decimal(12,2)) AS string) ELSE {_TOTAL} END",
            "source_row": "o * 8 + variant",
        },
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payment per order. A payment whose reference is lost or wrong leaves its order unpaid."""
    return _raw(
        _order_base(spark, sf_dir),
        "payments",
        {
            "payment_id": "concat('PMT', o)",
            "order_id": "CASE WHEN o % 211 = 3 THEN 'O-1' WHEN o % 223 = 4 THEN NULL ELSE concat('O', o) END",
            "payment_ts": "concat(d, ' 10:16')",
            "payment_method": _pick("o", "card", "paypal", "apple_pay"),
            "payment_status": "CASE WHEN status = 'P' THEN 'voided' WHEN status = 'O' AND o % 20 = 0 THEN ' Settled ' "
            "WHEN status = 'O' AND o % 10 <> 0 THEN 'refunded' ELSE 'settled' END",
            "amount": "CASE WHEN o % 107 = 0 THEN '1.00' WHEN o % 109 = 1 THEN cast(due + 0.01000001 AS string) "
            "WHEN o % 127 = 3 THEN concat(cast(due + 0.01 AS decimal(12,2)), '0000001') "
            f"WHEN o % 113 = 2 THEN cast(due + 0.01 AS string) ELSE {_TOTAL} END",
            "source_row": "o",
        },
    )


def support_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(
        _read(spark, sf_dir, "events"),
        "support_tickets",
        {
            "ticket_id": "concat('T', event_id)",
            "customer_id": "CASE WHEN event_id % 37 = 0 THEN 'C-1' WHEN event_id % 43 = 1 THEN NULL "
            "ELSE concat('C', user_id) END",
            "created_ts": "CASE WHEN event_id % 41 = 0 THEN 'bad_timestamp' WHEN event_id % 47 = 1 THEN ' ' "
            "ELSE replace(left(cast(ts AS string), 19), ' ', 'T') END",
            "channel": _pick("event_id", "email", "chat", "phone"),
            "category": "event_type",
            "sentiment": "CASE WHEN event_type = 'error' AND user_id % 4 = 0 THEN 'Negative' "
            "WHEN event_type = 'signup' THEN 'positive' ELSE 'neutral' END",
            "description": "props",
            "source_row": "event_id",
        },
    )


def staging(spark: SparkSession, sf_dir: str) -> Staging:
    """Feeds are set up when a rule or builder first asks for them."""
    feeds = {f.__name__: f for f in (customers, products, orders, payments, support_tickets)}
    return Staging({name: partial(feed, spark, sf_dir) for name, feed in feeds.items()})
