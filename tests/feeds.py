"""Small hand-made feeds for rule tests."""

from __future__ import annotations

from tidyledger.rules.staging import Staging
from tidyledger.schemas import RAW_COLUMNS

_DEFAULTS = {
    "customers": dict(customer_id="C1", first_name="Ann", last_name="Lee", email="a@x.com", phone="1", country="USA",
                      state="IL", signup_date="2025-01-01", loyalty_tier="Gold"),
    "products": dict(product_id="P1", product_name="pen", category="office", unit_price="10.00", active_flag="Y"),
    "orders": dict(order_id="O1", customer_id="C1", order_ts="2025-03-01 10:00", product_id="P1", quantity="2",
                   order_status="completed", shipping_state="IL", order_total="20.00"),
    "payments": dict(payment_id="PMT1", order_id="O1", payment_ts="2025-03-01 10:01", payment_method="card",
                     payment_status="settled", amount="20.00"),
    "support_tickets": dict(ticket_id="T1", customer_id="C1", created_ts="2025-03-02T11:00:00", channel="email",
                            category="late", sentiment="neutral", description="d"),
}


def staging(spark, parts: int = 1, **tables) -> Staging:
    """Each table is a list of overrides of one good row; a table left out has exactly that row."""
    out = {}
    for name, columns in RAW_COLUMNS.items():
        rows = [{**_DEFAULTS[name], **change} for change in tables.get(name, [{}])]
        ddl = ", ".join(f"{c} string" for c in columns) + ", source_row bigint"
        data = [tuple(r[c] for c in columns) + (i,) for i, r in enumerate(rows)]
        df = spark.createDataFrame(data, ddl)
        out[name] = df.repartition(parts) if parts > 1 else df
    return Staging(out)
