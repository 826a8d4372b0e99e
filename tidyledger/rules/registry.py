"""Rule identities: dataset, description, severity and suggested action."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidyledger.functions.text import sql_text, strip
from tidyledger.schemas import SOURCE_ROW
from tidyledger.sources.raw import read_csv

# Id, dataset, description, severity of every rule.
RULES = (
    ("DQ001", "customers", "customer_id must be unique after duplicate resolution", "High"),
    ("DQ002", "customers", "email should be present and syntactically valid when available", "Medium"),
    ("DQ003", "customers", "country and state must be standardized", "Medium"),
    ("DQ004", "orders", "order_id must be unique", "High"),
    ("DQ005", "orders", "customer_id must exist in customers", "High"),
    ("DQ006", "orders", "product_id must exist in products", "High"),
    ("DQ007", "orders", "completed orders must have positive quantity", "High"),
    ("DQ008", "orders", "order_total should equal quantity times product unit_price", "High"),
    ("DQ009", "payments", "payment order_id must exist in orders", "High"),
    ("DQ010", "payments", "settled payment amount should equal completed order total", "High"),
    ("DQ011", "support_tickets", "created_ts must parse to a valid timestamp", "Medium"),
    ("DQ012", "support_tickets", "customer_id should exist in customers", "Medium"),
)

# Suggested action of every rule.
ACTIONS = {
    "DQ001": "Merge or quarantine duplicate customer profiles before downstream join.",
    "DQ002": "Backfill missing email or flag the customer for outbound contact.",
    "DQ003": "Standardize country to USA and state to USPS code; review with the data steward.",
    "DQ004": "Drop the byte-identical duplicate order row; keep the first occurrence.",
    "DQ005": "Quarantine the order until the customer master is updated with the missing id.",
    "DQ006": "Quarantine the order until the product master is updated with the missing id.",
    "DQ007": "Investigate the source system; correct quantity sign or reverse the order.",
    "DQ008": "Reconcile order_total vs quantity * unit_price with the merchandising team.",
    "DQ009": "Hold the payment for AR review; do not post to GL until the order id is resolved.",
    "DQ010": "Reconcile payment shortfall/overage with the billing team before settlement close.",
    "DQ011": "Backfill created_ts from the source system audit log; flag for ingestion review.",
    "DQ012": "Flag the ticket for CRM review; create a stub customer record if confirmed.",
}

# Report order of severities; anything else sorts last.
SEVERITY_RANK = {"High": 0, "Medium": 1, "Low": 2}
UNKNOWN_SEVERITY_RANK = 99

RULE_IDS = tuple(rule[0] for rule in RULES)
RULE_COLUMNS = ("rule_id", "dataset", "description", "severity")
_FILE_COLUMNS = ("rule_id", "dataset", "rule_description", "severity")


def _values(spark: SparkSession, rows: list[tuple[str, ...]], names: tuple[str, ...]) -> DataFrame:
    """Literal rows as a local relation, so joins with them need no job of their own."""
    quoted = ", ".join("(" + ", ".join(map(sql_text, row)) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {quoted} AS rules({', '.join(names)})")


def actions(spark: SparkSession) -> DataFrame:
    return _values(spark, list(ACTIONS.items()), ("rule_id", "suggested_action"))


def registry(spark: SparkSession) -> DataFrame:
    """The built-in rules with their actions."""
    rows = [(*rule, ACTIONS[rule[0]]) for rule in RULES]
    return _values(spark, rows, (*RULE_COLUMNS, "suggested_action"))


def load_registry(spark: SparkSession, path: str) -> DataFrame:
    """Rules from a CSV (rule_id, dataset, rule_description, severity), each with its action. A later line replaces an
    earlier one of the same rule.

    Raises ValueError when the file and the actions do not name the same rules, or a rule names a dataset its
    check does not read.
    """
    raw = read_csv(spark, path, T.StructType([T.StructField(c, T.StringType()) for c in _FILE_COLUMNS]))
    lines = raw.select(*[strip(F.col(c)).alias(n) for c, n in zip(_FILE_COLUMNS, RULE_COLUMNS)], SOURCE_ROW)
    rules = lines.groupBy("rule_id").agg(*[F.max_by(c, SOURCE_ROW).alias(c) for c in RULE_COLUMNS[1:]])
    problems = drift(rules, actions(spark)).groupBy("problem").agg(F.count(F.lit(1)).alias("n"), F.min("rule_id").alias("first"))
    told = [f"{r.first} {r.problem}" + (f" and {r.n - 1} more" if r.n > 1 else "") for r in problems.orderBy("problem").collect()]
    if told:
        raise ValueError("rules and actions differ: " + ", ".join(told))
    # From here on there is one row per check.
    moved = rules.join(registry(spark).select("rule_id", "dataset"), ["rule_id", "dataset"], "left_anti").collect()
    if moved:
        raise ValueError("rules on another dataset than their check: " + ", ".join(r.rule_id for r in moved))
    return rules.join(F.broadcast(actions(spark)), "rule_id")


def drift(left: DataFrame, right: DataFrame, key: str = "rule_id") -> DataFrame:
    """Non-NULL ids present on one side only."""
    a, b = (df.filter(F.col(key).isNotNull()).select(key).distinct() for df in (left, right))
    return (
        a.join(b, key, "left_anti")
        .withColumn("problem", F.lit("only on the left"))
        .unionByName(b.join(a, key, "left_anti").withColumn("problem", F.lit("only on the right")))
    )
