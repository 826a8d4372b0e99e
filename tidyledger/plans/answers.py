"""The five business questions over the curated tables and the exception report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidyledger.functions.text import dollars, message, month_label
from tidyledger.operators.lookups import known_keys, lookup, own_exchange

AMOUNT = "decimal(22,2)"

ORDER_LINE = (
    "order_key", "customer_key", "product_key", "order_status", "quantity", "gross_order_amount",
    "calculated_order_amount", "order_amount_variance",
)


def _completed(fact_order: DataFrame) -> DataFrame:
    """Exact status match, as opposed to the rules' forgiving one."""
    return fact_order.filter(F.col("order_status") == "completed")


def _revenue(name: str) -> Column:
    return F.round(F.sum("gross_order_amount"), 2).cast(AMOUNT).alias(name)


def _orders() -> Column:
    return F.count(F.lit(1)).alias("completed_orders")


def q1_revenue_by_month(fact_order: DataFrame) -> DataFrame:
    """Completed revenue by calendar month."""
    return (
        _completed(fact_order)
        .filter(F.col("order_date").isNotNull())
        .groupBy(F.trunc("order_date", "MM").alias("month"))
        .agg(_revenue("completed_revenue"), _orders())
        .orderBy("month")
    )


def q2_top_customers(fact_order: DataFrame, dim_customer: DataFrame, n: int = 10) -> DataFrame:
    """Top customers by completed value; orders of unknown customers drop out, ties go to the lower key.

    Orders are summed per customer before the join, so both sides have one row per key.
    """
    spent = _completed(fact_order).groupBy("customer_key").agg(_revenue("completed_value"), _orders())
    names = dim_customer.select("customer_key", "full_name", "standard_state")
    return (
        spent.join(names, "customer_key")
        .select("customer_key", "full_name", "standard_state", "completed_value", "completed_orders")
        .orderBy(F.desc_nulls_last("completed_value"), "customer_key")
        .limit(n)
    )


def q3_order_issues(fact_order: DataFrame, exceptions: DataFrame, fact_payment: DataFrame) -> DataFrame:
    """Every different issue of every order: one row per (order_key, rule_id, issue_description).

    Issues come from the order's rows and from its payments' rows. Keys that are not in ``fact_order`` drop out before
    anything is grouped.
    """
    issue = ("rule_id", "issue_description")
    of_orders = exceptions.filter(F.col("dataset") == "orders").select(F.col("record_key").alias("order_key"), *issue)
    of_payments = exceptions.filter(F.col("dataset") == "payments").select(
        F.col("record_key").alias("payment_key"), *issue
    )
    paid = fact_payment.filter(F.col("order_key").isNotNull()).select("payment_key", "order_key").distinct()
    through_payment = paid.join(of_payments.distinct(), "payment_key").select("order_key", *issue)
    merged = of_orders.unionByName(through_payment)
    # Distinct keys alone, so that Spark drops every lookup that fact_order is built with. An inner join, as a semi join
    # would be pushed into every branch of the union and bring the plan of the orders with it.
    keys = fact_order.select("order_key").distinct().select(own_exchange("order_key"))
    return merged.join(keys, "order_key").distinct()


def q3_order_exceptions(fact_order: DataFrame, issues: DataFrame) -> DataFrame:
    """Distinct order lines with at least one exception, their rules (one entry per rule) and the number of issues.

    ``issues`` is the table of ``q3_order_issues``. The result has no row order; sort what is read.
    """
    per_rule = issues.groupBy("order_key", "rule_id").agg(F.count(F.lit(1)).alias("issues"))
    per_order = lookup(
        per_rule,
        "order_key",
        F.array_sort(F.collect_list("rule_id")).alias("triggered_rules"),
        F.sum("issues").alias("issue_count"),
    )
    lines = fact_order.select(*ORDER_LINE).distinct()
    return lines.join(per_order, "order_key").select(*ORDER_LINE, "triggered_rules", "issue_count")


def q3_filtered_by_rule(q3: DataFrame, rules: list[str]) -> DataFrame:
    """Order lines that triggered any of the rules; no choice means no filter."""
    if not rules:
        return q3
    return q3.filter(F.arrays_overlap("triggered_rules", F.array(*[F.lit(r) for r in rules])))


def q3_distinct_rules(q3: DataFrame) -> DataFrame:
    """Order lines with exceptions and the number of different rules among them."""
    rules = q3.select(F.explode("triggered_rules").alias("rule")).agg(F.count_distinct("rule").alias("distinct_rules"))
    lines = q3.agg(F.count(F.lit(1)).alias("order_lines"))
    return side_by_side(lines, rules)


def q3_summary(counts: DataFrame) -> DataFrame:
    """Exceptions per rule on orders and payments, with a ``total`` row, from ``report.exception_counts``."""
    per_rule = counts.filter(F.col("dataset").isin("orders", "payments"))
    return per_rule.rollup("rule_id").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).select(
        F.coalesce("rule_id", F.lit("total")).alias("rule_id"), "n"
    )


def q4_revenue_by_state(fact_order: DataFrame) -> DataFrame:
    """Completed revenue by shipping state, highest first."""
    return (
        _completed(fact_order)
        .filter(F.col("shipping_state").isNotNull())
        .groupBy(F.col("shipping_state").alias("state"))
        .agg(_revenue("completed_revenue"), _orders())
        .orderBy(F.desc_nulls_last("completed_revenue"), "state")
    )


def _flagged_order_keys(exceptions: DataFrame, fact_payment: DataFrame) -> DataFrame:
    """Keys of orders with an exception of their own or of a payment."""
    own = exceptions.filter(F.col("dataset") == "orders").select(F.col("record_key").alias("order_key"))
    bad_payments = exceptions.filter(F.col("dataset") == "payments").select(F.col("record_key").alias("payment_key"))
    through_payment = (
        fact_payment.filter(F.col("order_key").isNotNull())
        .join(known_keys(bad_payments, "payment_key", "_bad"), "payment_key", "left_semi")
        .select("order_key")
    )
    return known_keys(own.unionByName(through_payment), "order_key", "flagged")


def q5_per_customer_detail(
    dim_customer: DataFrame,
    fact_order: DataFrame,
    fact_payment: DataFrame,
    fact_customer_issue: DataFrame,
    exceptions: DataFrame,
) -> DataFrame:
    """Orders and orders with exceptions per customer, with the customer's ticket cohort."""
    negative = known_keys(
        fact_customer_issue.filter(F.lower("sentiment") == "negative"), "customer_key", "negative"
    )
    per_customer = (
        fact_order.select("customer_key", "order_key")
        .join(_flagged_order_keys(exceptions, fact_payment), "order_key", "left")
        .groupBy("customer_key")
        .agg(F.count(F.lit(1)).alias("total"), F.count("flagged").alias("flagged"))
    )
    total = F.coalesce("total", F.lit(0))
    flagged = F.coalesce("flagged", F.lit(0))
    return (
        dim_customer.select("customer_key")
        .join(negative, "customer_key", "left")
        .join(per_customer, "customer_key", "left")
        .select(
            "customer_key",
            F.when(F.col("negative").isNotNull(), "has_negative_ticket").otherwise("no_negative_ticket").alias("cohort"),
            total.alias("total_orders"),
            flagged.alias("orders_with_exception"),
            _percent(flagged, total).alias("pct_orders_with_exception"),
        )
    )


def _percent(part: Column, whole: Column) -> Column:
    """Percentage with two places, NULL when there is nothing to divide by."""
    return F.round(F.lit(100) * part / F.nullif(whole, F.lit(0)), 2).cast("double")


def q5_sentiment_link(detail: DataFrame) -> DataFrame:
    """The per-customer detail summed by cohort."""
    return (
        detail.groupBy("cohort")
        .agg(
            F.count("customer_key").alias("customer_count"),  # one row per customer
            F.sum("total_orders").alias("total_orders"),
            F.sum("orders_with_exception").alias("orders_with_exception"),
        )
        .withColumn(
            "pct_orders_with_exception", _percent(F.col("orders_with_exception"), F.col("total_orders"))
        )
        .orderBy("cohort")
    )


def orders_missing_payment(fact_order: DataFrame, fact_payment: DataFrame) -> DataFrame:
    """Completed order lines no payment refers to. Asked by the business, answered by no rule."""
    paid = known_keys(fact_payment, "order_key", "_paid").select("order_key")
    return _completed(fact_order).join(paid, "order_key", "left_anti").select(*fact_order.columns)


def side_by_side(*single_rows: DataFrame) -> DataFrame:
    """One row with the columns of several one-row frames."""
    out = single_rows[0]
    for df in single_rows[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out.agg(*[F.first(c, ignorenulls=True).alias(c) for c in out.columns])


# The sentences below.

# --- findings: one sentence per question -----------------------------------------------------------------


def _sentence(df: DataFrame, empty: str, text: Column) -> DataFrame:
    return df.select(F.when(F.col("n") == 0, F.lit(empty)).otherwise(text).alias("finding"))


def _best(df: DataFrame, value: str, *ties: str) -> Column:
    """The row with the highest value; ties go to the lowest of the tie columns."""
    order = F.when(F.col(value).isNotNull(), F.struct((-F.col(value)).alias("_"), *ties))
    return F.min_by(F.struct(*df.columns), order).alias("best")


def finding_q1(q1: DataFrame) -> DataFrame:
    facts = q1.agg(
        F.count(F.lit(1)).alias("n"),
        dollars(F.coalesce(F.sum("completed_revenue"), F.lit(0))).alias("revenue"),
        F.sum("completed_orders").alias("orders"),
        _best(q1, "completed_revenue", "month"),
    ).withColumns({"month": month_label(F.col("best.month")), "peak": dollars(F.col("best.completed_revenue"))})
    text = message(
        "Total completed revenue is {revenue} across {orders} orders. Peak month is {month} with {peak} "
        "from {peak_orders} orders.",
        revenue="revenue", orders="orders", month="month", peak="peak", peak_orders="best.completed_orders",
    )
    return _sentence(facts, "No completed orders with valid order dates were found.", text)


def finding_q2(q2: DataFrame) -> DataFrame:
    facts = q2.agg(F.count(F.lit(1)).alias("n"), _best(q2, "completed_value", "customer_key"))
    text = message(
        "Top customer is {key} ({name}, {state}) with {value} across {orders} completed orders.",
        key="best.customer_key", name="best.full_name", state="best.standard_state", value="value",
        orders="best.completed_orders",
    )
    facts = facts.withColumn("value", dollars(F.col("best.completed_value")))
    return _sentence(facts, "No completed orders linked to valid customers were found.", text)


def finding_q3(q3: DataFrame) -> DataFrame:
    """Counts order lines. Their keys are rows of the table, at every size."""
    text = message(
        "{n} distinct orders triggered at least one exception. Affected order keys are in q3_order_exceptions.", n="n"
    )
    empty = "No orders triggered data-quality or reconciliation exceptions."
    return _sentence(q3.agg(F.count(F.lit(1)).alias("n")), empty, text)


def finding_q4(q4: DataFrame) -> DataFrame:
    facts = q4.agg(F.count(F.lit(1)).alias("n"), _best(q4, "completed_revenue", "state"))
    text = message(
        "Top revenue state is {state} with {value} from {orders} completed orders.",
        state="best.state", value="value", orders="best.completed_orders",
    )
    facts = facts.withColumn("value", dollars(F.col("best.completed_revenue")))
    return _sentence(facts, "No completed orders with a standardized shipping state were found.", text)


def finding_q5(q5: DataFrame) -> DataFrame:
    def of(cohort: str, column: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("cohort") == cohort, F.col(column))), F.lit(0))

    facts = q5.agg(
        F.count(F.lit(1)).alias("n"),
        of("has_negative_ticket", "customer_count").alias("customers"),
        of("has_negative_ticket", "pct_orders_with_exception").cast("decimal(7,2)").alias("negative"),
        of("no_negative_ticket", "pct_orders_with_exception").cast("decimal(7,2)").alias("other"),
    )
    text = message(
        "Among {customers} customers with negative support tickets, {negative}% of their orders triggered "
        "exceptions, versus {other}% for customers without negative tickets.",
        customers="customers", negative="round(negative, 1)", other="round(other, 1)",
    )
    return _sentence(facts, "No customer cohort comparison could be computed.", text)
