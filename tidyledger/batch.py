"""The whole job: raw extracts to exception report, curated tables, answers and report tables.

    spark-submit run_batch.py <input_dir> <output_dir> [rules.csv]

Each step writes its tables and the next one reads them, so a lost executor costs at most the step it was
in, and no step repeats the work of an earlier one.

A run writes to a folder of its own, <output_dir>/runs/<run>, and appears at once, when its manifest is put beside the others as the
last thing it does (``tidyledger.runs``). A run that fails leaves the tables of the run before it as they are.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidyledger import runs
from tidyledger.plans import answers, report
from tidyledger.plans.curate import curated
from tidyledger.rules.registry import load_registry, registry
from tidyledger.rules.run import run_rules
from tidyledger.rules.staging import Staging
from tidyledger.rules.violations import disagreeing_totals
from tidyledger.schemas import EXCEPTION_TABLE
from tidyledger.sinks import export_csv, write_table
from tidyledger.sources.raw import read_sources, row_counts


def land(tables: Mapping[str, DataFrame], out: str) -> Staging:
    """Write the raw tables and the orders without identical repeats."""
    stg = Staging({name: write_table(df, f"{out}/raw/{name}") for name, df in tables.items()})
    return stg.with_orders_distinct(write_table(stg.kept_orders, f"{out}/staged/orders_distinct"))


def answer_tables(
    tables: Mapping[str, DataFrame], exceptions: DataFrame, counts: DataFrame, rules: DataFrame
) -> dict[str, DataFrame]:
    """Answers and report tables over written inputs; ``counts`` is the written ``report.exception_counts``."""
    order, payment, customer = tables["fact_order"], tables["fact_payment"], tables["dim_customer"]
    return {
        "q3_order_issues": answers.q3_order_issues(order, exceptions, payment),
        "q1_revenue_by_month": answers.q1_revenue_by_month(order),
        "q2_top_customers": answers.q2_top_customers(order, customer),
        "q3_summary": answers.q3_summary(counts),
        "q4_revenue_by_state": answers.q4_revenue_by_state(order),
        "q5_per_customer_detail": answers.q5_per_customer_detail(
            customer, order, payment, tables["fact_customer_issue"], exceptions
        ),
        "orders_missing_payment": answers.orders_missing_payment(order, payment),
        "dq_summary": report.dq_summary(counts),
        "dq_by_severity": report.dq_by_severity(counts),
        "dq_by_rule": report.dq_by_rule(counts, rules),
        "dq_by_rule_severity": report.dq_by_rule_severity(counts),
        "rule_reference": report.rule_reference(counts, rules),
        "dq_samples_per_rule": report.dq_samples_per_rule(exceptions, rules),
        "kpi_metrics": report.kpi_metrics(customer, order, counts),
    }


def findings(written: Mapping[str, DataFrame]) -> DataFrame:
    """One row per question."""
    q5 = answers.q5_sentiment_link(written["q5_per_customer_detail"])
    sentences = {
        "q1": answers.finding_q1(written["q1_revenue_by_month"]),
        "q2": answers.finding_q2(written["q2_top_customers"]),
        "q3": answers.finding_q3(written["q3_order_exceptions"]),
        "q4": answers.finding_q4(written["q4_revenue_by_state"]),
        "q5": answers.finding_q5(q5),
    }
    rows = [df.select(F.lit(q).alias("question"), "finding") for q, df in sentences.items()]
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row)
    return out


def run(
    spark: SparkSession,
    input_dir: str,
    output_dir: str,
    rules_csv: str | None = None,
    detected_at: datetime | None = None,
    multi_line: bool | None = None,
    keep: int = 2,
) -> dict[str, DataFrame]:
    """Rebuild every table and return them by name. ``runs.open_tables(spark, output_dir)`` reads them later.

    ``multi_line`` as in ``read_csv``; of the finished runs under ``output_dir`` the last ``keep`` stay.
    """
    folder = runs.new_run(spark, output_dir)
    out = folder.path
    rules = load_registry(spark, rules_csv) if rules_csv else registry(spark)
    stg = land(read_sources(spark, input_dir, multi_line=multi_line), out)

    exceptions = write_table(run_rules(stg, rules=rules, detected_at=detected_at), f"{out}/{EXCEPTION_TABLE}")
    export_csv(exceptions, f"{out}/exceptions_csv")
    counts = write_table(report.exception_counts(exceptions), f"{out}/answers/exception_counts")

    tables = {name: write_table(df, f"{out}/curated/{name}") for name, df in curated(stg).items()}
    written = {
        name: write_table(df, f"{out}/answers/{name}")
        for name, df in answer_tables(tables, exceptions, counts, rules).items()
    }
    q3 = answers.q3_order_exceptions(tables["fact_order"], written["q3_order_issues"])
    written["q3_order_exceptions"] = write_table(q3, f"{out}/answers/q3_order_exceptions")
    over_written = {
        "q3_distinct_rules": answers.q3_distinct_rules(written["q3_order_exceptions"]),
        "dq010_disagreeing_totals": disagreeing_totals(stg),
        "reconcile_totals": report.reconcile_totals(stg, tables["fact_order"], tables["fact_payment"]),
        "numbers_not_held": report.numbers_not_held(stg),
        "table_profile": report.table_profile({**tables, EXCEPTION_TABLE: exceptions}),
    }
    written |= {name: write_table(df, f"{out}/answers/{name}") for name, df in over_written.items()}
    written["q5_sentiment_link"] = write_table(
        answers.q5_sentiment_link(written["q5_per_customer_detail"]), f"{out}/answers/q5_sentiment_link"
    )
    written["findings"] = write_table(findings(written), f"{out}/answers/findings")
    raw = {name: getattr(stg, name) for name in ("customers", "products", "orders", "payments", "support_tickets")}
    written["ingest_row_counts"] = write_table(row_counts(raw), f"{out}/answers/ingest_row_counts")
    written["curated_row_counts"] = write_table(
        row_counts({**tables, EXCEPTION_TABLE: exceptions}), f"{out}/answers/curated_row_counts"
    )
    written["exception_counts"] = counts
    paths = {
        EXCEPTION_TABLE: EXCEPTION_TABLE, **{n: f"curated/{n}" for n in tables}, **{n: f"answers/{n}" for n in written},
    }
    runs.publish(spark, folder, paths)
    runs.drop_old(spark, output_dir, keep)
    return {**tables, EXCEPTION_TABLE: exceptions, **written}
