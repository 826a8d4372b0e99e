"""A hot key is split between tasks, and plans keep their shape when nothing may be broadcast."""

from __future__ import annotations

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from tidyledger.operators.lookups import known_keys
from tidyledger.plans import answers, curate
from tidyledger.rules.run import find_violations, run_rules
from tidyledger.rules.staging import Staging
from tidyledger.schemas import RAW_COLUMNS

N = 20_000


@contextmanager
def conf(spark, **settings):
    before = {}
    for key, value in settings.items():
        key = "spark.sql." + key.replace("__", ".")
        before[key] = spark.conf.get(key, None)
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


@pytest.fixture
def big_cluster(spark):
    """Small tables stand for large ones: no broadcast by size, and partitions of 20 kB count as skewed."""
    with conf(
        spark,
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="20000",
        adaptive__skewJoin__skewedPartitionFactor="2",
        adaptive__advisoryPartitionSizeInBytes="20000",
        adaptive__coalescePartitions__enabled="false",
    ):
        yield


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """One third of the orders shares an order_id, another an unknown customer, the last a product; written, as in a
    batch run. Ids are hashes, so shuffled sizes mean something."""
    out = str(tmp_path_factory.mktemp("hot"))
    i = F.col("id")
    third, second, last = i % 3 == 0, i % 3 == 1, i % 3 == 2

    def text(prefix, n):
        return F.concat(F.lit(prefix), F.hex(F.xxhash64(n)))

    ids = spark.range(0, N, 1, 16)
    frames = {
        "customers": spark.range(0, 5000, 1, 4).select(
            text("C", i).alias("customer_id"), F.lit("A").alias("first_name"), F.lit("B").alias("last_name"),
            F.lit("a@x.com").alias("email"), text("5", i).alias("phone"), F.lit("USA").alias("country"),
            F.lit("IL").alias("state"), F.lit("2025-01-01").alias("signup_date"), F.lit("Gold").alias("loyalty_tier"),
            i.alias("source_row"),
        ),
        "products": spark.range(0, 5000, 1, 4).select(
            text("P", i).alias("product_id"), F.lit("pen").alias("product_name"), F.lit("office").alias("category"),
            F.lit("2.00").alias("unit_price"), F.lit("Y").alias("active_flag"), i.alias("source_row"),
        ),
        "orders": ids.select(
            F.when(third, "O-hot").otherwise(text("O", i)).alias("order_id"),
            F.when(second, "C-hot").otherwise(text("C", i % 5000)).alias("customer_id"),
            F.lit("2025-03-01 10:00").alias("order_ts"),
            F.when(last, text("P", F.lit(7).cast("bigint"))).otherwise(text("P", i % 5000)).alias("product_id"),
            (i % 4 + 1).cast("string").alias("quantity"), F.lit("completed").alias("order_status"),
            F.lit("IL").alias("shipping_state"), F.concat((i % 4 * 2 + 2).cast("string"), F.lit(".00")).alias("order_total"),
            i.alias("source_row"),
        ),
        "payments": ids.select(
            text("PMT", i).alias("payment_id"), F.when(third, "O-none").otherwise(text("O", i)).alias("order_id"),
            F.lit("2025-03-01").alias("payment_ts"), F.lit("card").alias("payment_method"), F.lit("settled").alias("payment_status"),
            F.concat((i % 4 * 2 + 2).cast("string"), F.lit(".00")).alias("amount"), i.alias("source_row"),
        ),
        "support_tickets": ids.select(
            text("T", i).alias("ticket_id"), F.when(third, "C-hot").otherwise(text("C", i % 5000)).alias("customer_id"),
            F.lit("2025-03-01").alias("created_ts"), F.lit("chat").alias("channel"), F.lit("late").alias("category"),
            F.lit("negative").alias("sentiment"), F.lit("d").alias("description"), i.alias("source_row"),
        ),
    }
    for name, df in frames.items():
        df.select(*RAW_COLUMNS[name], "source_row").write.parquet(f"{out}/{name}")
    return Staging({name: spark.read.parquet(f"{out}/{name}") for name in frames})


def run_plan(df):
    """Rows and the final physical plan."""
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_reference_checks_split_a_hot_key(spark, big_cluster, hot):
    for rule, count in (("DQ005", (N + 1) // 3), ("DQ009", (N + 2) // 3), ("DQ012", (N + 2) // 3)):
        rows, plan = run_plan(find_violations(hot, [rule]))
        assert len(rows) == count, rule
        assert "skew=true" in plan, plan


def test_price_lookup_splits_a_hot_product(spark, big_cluster, hot):
    rows, plan = run_plan(curate.fact_order(hot))
    assert "skew=true" in plan, plan
    assert all(r.calculated_order_amount == 2 * r.quantity for r in rows)
    # Rows 15,000 apart repeat each other when both carry the shared order_id.
    assert len(rows) == N - len(range(15_000, N, 3))


def test_unpaid_orders_split_a_hot_order(spark, big_cluster, hot):
    order = hot.orders.select(
        F.col("order_id").alias("order_key"), F.lit("completed").alias("order_status"), F.col("customer_id").alias("customer_key")
    )
    payment = hot.payments.select(F.col("order_id").alias("order_key"))
    rows, plan = run_plan(answers.orders_missing_payment(order, payment))
    assert len(rows) == (N + 2) // 3 and "skew=true" in plan, plan


def test_duplicates_of_a_hot_key_are_split_between_tasks(spark, big_cluster, hot):
    rows, plan = run_plan(hot.orders_duplicates)
    assert len(rows) == (N + 2) // 3 - 1
    assert "skew=true" in plan, plan


def test_few_repeats_leave_the_rows_where_they_are(spark, hot):
    """With few repeated keys their side is broadcast and no row of the table is shuffled whole."""
    _, plan = run_plan(hot.customers_duplicates)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan, plan


def test_no_window_and_no_cross_join_in_rules_and_curated_tables(spark, big_cluster, hot):
    frames = [run_rules(hot), *curate.curated(hot).values()]
    for df in frames:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_samples_limit_each_group_before_the_shuffle(spark, hot):
    from tidyledger.plans.report import dq_samples_per_rule
    from tidyledger.rules.registry import registry

    df = dq_samples_per_rule(run_rules(hot, ["DQ009"]), registry(spark))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_curated_scan_pushes_filters_and_prunes_columns(spark, tmp_path):
    spark.createDataFrame(
        [("O1", "C1", None, None, 1, "completed", "IL", None, None, None)],
        "order_key string, customer_key string, product_key string, order_date date, quantity int, order_status string, "
        "shipping_state string, gross_order_amount decimal(12,2), calculated_order_amount decimal(12,2), "
        "order_amount_variance decimal(12,2)",
    ).write.parquet(str(tmp_path / "fact_order"))
    df = answers.q1_revenue_by_month(spark.read.parquet(str(tmp_path / "fact_order")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(order_status,completed)" in plan and "IsNotNull(order_date)" in plan
    assert "ReadSchema: struct<order_date:date,order_status:string,gross_order_amount:decimal(12,2)>" in plan


def test_every_issue_of_a_hot_order_is_a_row(spark):
    ddl = "rule_id string, dataset string, record_key string, issue_description string"
    rows = [("DQ005", "orders", "O1", f"issue {i}") for i in range(5000)]
    rows += [("DQ005", "orders", "O2", "one")] * 3 + [("DQ004", "orders", "O2", "dup")] * 9 + [("DQ004", "orders", "O9", "not an order")]
    rows += [("DQ010", "payments", "PMT1", f"pay {i}") for i in range(40)] + [("DQ009", "payments", "PMT2", "orphan")]
    exceptions = spark.createDataFrame(rows, ddl)
    payments = spark.createDataFrame(
        [("PMT1", "O3"), ("PMT1", "O4"), ("PMT1", "O3"), ("PMT2", "O1"), ("PMT2", None), ("PMT2", "O-1")], "payment_key string, order_key string"
    )
    line = ", ".join(f"{c} string" for c in answers.ORDER_LINE)
    orders = spark.createDataFrame([(f"O{i}", *["x"] * 7) for i in (1, 2, 2, 3, 4, 5)], line)
    issues = answers.q3_order_issues(orders, exceptions, payments)
    per_key = {r.order_key: r["count"] for r in issues.groupBy("order_key").count().collect()}
    assert per_key == {"O1": 5001, "O2": 2, "O3": 40, "O4": 40}
    got = {r.order_key: (r.triggered_rules, r.issue_count) for r in answers.q3_order_exceptions(orders, issues).collect()}
    assert got == {"O1": (["DQ005", "DQ009"], 5001), "O2": (["DQ004", "DQ005"], 2), "O3": (["DQ010"], 40), "O4": (["DQ010"], 40)}


def test_question_3_plans_the_rules_once(spark, big_cluster, hot):
    exceptions = run_rules(hot, ["DQ004", "DQ005", "DQ006", "DQ007", "DQ008", "DQ009", "DQ010"])
    order, payment = curate.fact_order(hot), curate.fact_payment(hot)
    q3 = answers.q3_order_exceptions(order, answers.q3_order_issues(order, exceptions, payment))
    plan = q3._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 45 and "rangepartitioning" not in plan


def test_known_keys_leave_the_join_its_own_exchange(spark, big_cluster):
    left = spark.range(100).select(F.col("id").cast("string").alias("k"))
    plan = left.join(known_keys(left, "k", "known"), "k", "left")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(k") == 3
