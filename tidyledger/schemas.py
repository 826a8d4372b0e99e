"""Declared schemas: raw landing tables, curated star schema, exception report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Column every raw table carries besides its source columns: a unique, increasing position that
#: gives "first occurrence wins" a meaning in a distributed table.
SOURCE_ROW = "source_row"

# Source column names per raw table, in file order.
RAW_COLUMNS: dict[str, tuple[str, ...]] = {
    "customers": (
        "customer_id", "first_name", "last_name", "email", "phone", "country", "state", "signup_date", "loyalty_tier",
    ),
    "products": ("product_id", "product_name", "category", "unit_price", "active_flag"),
    "orders": (
        "order_id", "customer_id", "order_ts", "product_id", "quantity", "order_status", "shipping_state",
        "order_total",
    ),
    "payments": ("payment_id", "order_id", "payment_ts", "payment_method", "payment_status", "amount"),
    "support_tickets": (
        "ticket_id", "customer_id", "created_ts", "channel", "category", "sentiment", "description",
    ),
}

# Curated columns and types.
CURATED: dict[str, str] = {
    "dim_customer": (
        "customer_key string, full_name string, email string, phone string, standard_country string, "
        "standard_state string, signup_date date, loyalty_tier string, duplicate_resolution_flag boolean"
    ),
    "dim_product": (
        "product_key string, product_name string, category string, unit_price decimal(12,2), active_flag boolean"
    ),
    "fact_order": (
        "order_key string, customer_key string, product_key string, order_date date, quantity int, "
        "order_status string, shipping_state string, gross_order_amount decimal(12,2), "
        "calculated_order_amount decimal(12,2), order_amount_variance decimal(12,2)"
    ),
    "fact_payment": (
        "payment_key string, order_key string, payment_date date, payment_method string, payment_status string, "
        "payment_amount decimal(12,2)"
    ),
    "fact_customer_issue": (
        "ticket_id string, customer_key string, created_date date, channel string, issue_category string, "
        "sentiment string, description string"
    ),
}

EXCEPTION_TABLE = "dq_exception_report"
EXCEPTIONS = (
    "rule_id string, dataset string, record_key string, severity string, issue_description string, "
    "suggested_action string, detected_at timestamp_ntz"
)


def struct_of(ddl: str) -> T.StructType:
    """DDL text to StructType without needing a session."""
    names = {
        "string": T.StringType(),
        "int": T.IntegerType(),
        "date": T.DateType(),
        "boolean": T.BooleanType(),
        "timestamp_ntz": T.TimestampNTZType(),
        "decimal(12,2)": T.DecimalType(12, 2),
    }
    fields = [part.split(" ") for part in ddl.split(", ")]
    return T.StructType([T.StructField(name, names[kind]) for name, kind in fields])


def raw_struct(table: str) -> T.StructType:
    """All-text schema of one raw table, as the readers need it."""
    return T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS[table]])


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """Select a declared schema by name; the types must already be right."""
    schema = struct_of(ddl)
    out = df.select(*schema.names)
    got = [f.dataType for f in out.schema.fields]
    want = [f.dataType for f in schema.fields]
    if got != want:
        raise TypeError(f"columns do not have the declared types: got {got}, declared {want}")
    return out
