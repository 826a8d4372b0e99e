"""Report tables over the exception report and the curated tables."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidyledger.functions import numbers, wide
from tidyledger.functions.numbers import to_decimal
from tidyledger.functions.text import table_cell
from tidyledger.operators.rows import first_per_group
from tidyledger.plans.answers import AMOUNT, side_by_side
from tidyledger.rules.run import with_severity_rank
from tidyledger.rules.staging import Staging
from tidyledger.rules.violations import prices
from tidyledger.schemas import RAW_COLUMNS

SAMPLES = 5


def _rows() -> Column:
    return F.count(F.lit(1))


def exception_counts(exceptions: DataFrame) -> DataFrame:
    """The report counted once, by dataset, rule and severity: what every count of it is a sum of.

    At most a few rows a rule. A job that writes this table reads the report once for all of its count tables.
    """
    return exceptions.groupBy("dataset", "rule_id", "severity").agg(_rows().alias("n"), F.max("detected_at").alias("detected_at"))


def _n() -> Column:
    return F.coalesce(F.sum("n"), F.lit(0))


def dq_summary(counts: DataFrame) -> DataFrame:
    of = lambda severity: F.coalesce(F.sum(F.when(F.col("severity") == severity, F.col("n"))), F.lit(0))
    return counts.agg(
        _n().alias("total_exceptions"), F.count_distinct("rule_id").alias("unique_rules"), of("High").alias("high"), of("Medium").alias("medium")
    )


def dq_by_severity(counts: DataFrame) -> DataFrame:
    return counts.groupBy("severity").agg(_n().alias("n")).orderBy("severity")


def dq_by_rule_severity(counts: DataFrame) -> DataFrame:
    return counts.groupBy("rule_id", "severity").agg(_n().alias("n")).orderBy("rule_id", "severity")


def dq_by_rule(counts: DataFrame, rules: DataFrame) -> DataFrame:
    """Violations of each triggered rule with its description."""
    per_rule = counts.groupBy("rule_id").agg(_n().alias("violations"))
    described = rules.select("rule_id", "description", "severity")
    return (
        described.join(per_rule, "rule_id")
        .select("rule_id", F.replace("description", F.lit("|"), F.lit("\\|")).alias("description"), "severity", "violations")
        .orderBy("rule_id")
    )


def rule_reference(counts: DataFrame, rules: DataFrame) -> DataFrame:
    """Every rule with how often it fired, also when it never did."""
    per_rule = counts.groupBy("rule_id").agg(_n().alias("violations"))
    return (
        rules.join(per_rule, "rule_id", "left")
        .select("rule_id", "dataset", "description", "severity", "suggested_action", F.coalesce("violations", F.lit(0)).alias("violations"))
        .orderBy("rule_id")
    )


def dq_samples_per_rule(exceptions: DataFrame, rules: DataFrame, n: int = SAMPLES) -> DataFrame:
    """Up to ``n`` rows of every rule, newest first; a rule without violations has one row of NULLs.

    Only what the order needs goes through the sort; the severity, which belongs to the rule, comes from ``rules``.
    """
    order = [F.desc("detected_at"), F.asc_nulls_last("record_key"), F.asc("issue_description")]
    found = first_per_group(
        exceptions.select("rule_id", "detected_at", "record_key", "issue_description"), "rule_id", order, n, "sample"
    )
    return rules.select("rule_id", "severity").join(found, "rule_id", "left").select(
        "rule_id", "sample", "record_key", F.when(F.col("sample").isNotNull(), F.col("severity")).alias("severity"),
        table_cell(F.col("issue_description")).alias("issue"),
    )


def rule_samples(exceptions: DataFrame, rule_id: str, n: int = SAMPLES) -> DataFrame:
    """The same for a single rule, as a filter and a top-n."""
    return (
        exceptions.filter(F.col("rule_id") == rule_id)
        .orderBy(F.desc("detected_at"), F.asc_nulls_last("record_key"), "issue_description")
        .limit(n)
    )


def filter_exceptions(
    exceptions: DataFrame, rules: Collection[str] = (), severities: Collection[str] = ()
) -> DataFrame:
    """Rows of any chosen rule and any chosen severity; an empty choice does not filter."""
    if rules:
        exceptions = exceptions.filter(F.col("rule_id").isin(*rules))
    if severities:
        exceptions = exceptions.filter(F.col("severity").isin(*severities))
    return exceptions


def listing(exceptions: DataFrame) -> DataFrame:
    """All exceptions in report order, for reading a filtered part; the stored table stays unsorted."""
    return with_severity_rank(exceptions).orderBy(
        "severity_rank", "rule_id", "dataset", F.asc_nulls_last("record_key"), "issue_description"
    )


def preview(df: DataFrame, n: int = 100) -> DataFrame:
    return df.limit(n)


def kpi_metrics(dim_customer: DataFrame, fact_order: DataFrame, counts: DataFrame) -> DataFrame:
    revenue = F.coalesce(F.round(F.sum("gross_order_amount"), 2), F.lit(0)).cast(AMOUNT)
    return side_by_side(
        dim_customer.agg(_rows().alias("total_customers")),
        fact_order.filter(F.col("order_status") == "completed").agg(revenue.alias("completed_revenue")),
        counts.agg(_n().alias("total_exceptions"), F.max("detected_at").alias("last_run")),
    )


def table_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every column of every table: position, type, and how many rows of how many have a value. One pass per table."""
    profiles = []
    for name, df in tables.items():
        filled = [F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(df.schema.fields)]
        counts = df.agg(_rows().alias("n"), *filled)
        columns = F.array(
            *[
                F.struct(
                    F.lit(i).alias("position"), F.lit(f.name).alias("column_name"),
                    F.lit(f.dataType.simpleString()).alias("data_type"), F.col(f"c{i}").alias("filled"),
                )
                for i, f in enumerate(df.schema.fields)
            ]
        )
        profiles.append(counts.select(F.lit(name).alias("table_name"), "n", F.inline(columns)))
    out = profiles[0]
    for profile in profiles[1:]:
        out = out.unionByName(profile)
    return out.select("table_name", "position", "column_name", "data_type", F.col("n").alias("row_count"), "filled")


def numbers_not_held(stg: Staging) -> DataFrame:
    """Numbers of the feeds that the rules or the curated tables cannot hold as they are, with the reason.

    Such a value is NULL (or rounded) there and no violation of a rule; here it is a row, so nothing is lost unseen.
    """

    def found(df: DataFrame, dataset: str, key: str, cells: dict[str, tuple[Column, Column]]) -> DataFrame:
        """One pass over a table: its columns with their text and problem."""
        told = F.array(
            *[F.struct(F.lit(n).alias("column_name"), raw.alias("raw"), problem.alias("problem")) for n, (raw, problem) in cells.items()]
        )
        rows = df.select(F.lit(dataset).alias("dataset"), F.col(key).alias("record_key"), F.inline(told))
        return rows.filter(F.col("problem").isNotNull())

    def amount(name: str) -> tuple[Column, Column]:
        return F.col(name), numbers.amount_problem(F.col(name))

    def computed(limbs: Column) -> tuple[Column, Column]:
        large = limbs.isNotNull() & wide.cents(limbs, numbers.MONEY).isNull()
        return wide.text(limbs, F.lit(wide.DECIMALS)), F.when(large, F.lit("too large for the curated table"))

    quantity = F.col("quantity")
    priced = stg.orders.select("order_id", "product_id", "quantity", "order_total").join(
        prices(stg.products).select("product_id", "unit_price"), "product_id", "left"
    )
    product = wide.times(F.coalesce(numbers.to_whole(quantity), numbers.large_whole(quantity)), numbers.limbs(F.col("unit_price")))
    variance = wide.minus(numbers.limbs(F.col("order_total")), F.col("product"))
    orders = priced.withColumn("product", product).withColumn("variance", variance)
    return (
        found(orders, "orders", "order_id", {
            "quantity": (quantity, numbers.quantity_problem(quantity)),
            "order_total": amount("order_total"),
            "calculated_order_amount": computed(F.col("product")),
            "order_amount_variance": computed(F.col("variance")),
        })
        .unionByName(found(stg.products, "products", "product_id", {"unit_price": amount("unit_price")}))
        .unionByName(found(stg.payments, "payments", "payment_id", {"amount": amount("amount")}))
    )


def reconcile_totals(stg: Staging, fact_order: DataFrame, fact_payment: DataFrame) -> DataFrame:
    """Completed and settled money in the curated tables against sums taken straight from the raw text."""
    contents = stg.orders.select(*RAW_COLUMNS["orders"]).distinct()

    def total(df: DataFrame, measure: str, status: str, kind: str, amount: Column, side: str) -> DataFrame:
        summed = df.filter(F.col(status) == kind).agg(F.coalesce(F.sum(amount), F.lit(0)).cast(AMOUNT).alias(side))
        return summed.select(F.lit(measure).alias("measure"), side)

    raw_order, raw_payment = to_decimal(F.col("order_total")), to_decimal(F.col("amount"))
    sides = [
        total(fact_order, "completed orders", "order_status", "completed", F.col("gross_order_amount"), "curated_total"),
        total(contents, "completed orders", "order_status", "completed", raw_order, "raw_total"),
        total(fact_payment, "settled payments", "payment_status", "settled", F.col("payment_amount"), "curated_total"),
        total(stg.payments, "settled payments", "payment_status", "settled", raw_payment, "raw_total"),
    ]
    both = sides[0]
    for side in sides[1:]:
        both = both.unionByName(side, allowMissingColumns=True)
    return (
        both.groupBy("measure")
        .agg(F.max("curated_total").alias("curated_total"), F.max("raw_total").alias("raw_total"))
        .withColumn("difference", (F.col("curated_total") - F.col("raw_total")).cast(AMOUNT))
    )
