"""

Every query reads the driver's Parquet tables whole. The raw feeds with their seeded defects are derived from
them by Spark (``tidyledger.fixtures``, FIXTURES.md); from there each query runs the library unchanged.
"""

from __future__ import annotations

import os
import sys
import tempfile
import uuid
from collections.abc import Callable
from datetime import datetime
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Column, DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql.types import StructType  # noqa: E402

from tidyledger import fixtures  # noqa: E402
from tidyledger.batch import land  # noqa: E402
from tidyledger.functions import contact, geography, numbers, timestamps  # noqa: E402
from tidyledger.operators import dedup  # noqa: E402
from tidyledger.oracle.statements import statements  # noqa: E402
from tidyledger.plans import answers, curate, report  # noqa: E402
from tidyledger.rules.registry import RULES, drift, registry  # noqa: E402
from tidyledger.rules.run import run_rules, with_severity_rank  # noqa: E402
from tidyledger.rules.staging import Staging  # noqa: E402
from tidyledger.rules.violations import disagreeing_totals  # noqa: E402
from tidyledger.schemas import EXCEPTION_TABLE, RAW_COLUMNS, SOURCE_ROW  # noqa: E402
from tidyledger.sinks import export_csv  # noqa: E402
from tidyledger.sources.raw import SOURCE_FILES, read_csv, read_sources, row_counts  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]

try:
    import corpus_pipeline
    from tidyledger.llm import queries as training_data
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "tidyledger.llm"):
        raise
    corpus_pipeline = training_data = None

SMALL = "/root/testdata/sf0.001"

#: The detection time is a run parameter and is left out of every compared result.
DETECTED_AT = datetime(2025, 6, 1)


def entry(spark: SparkSession) -> DataFrame:
    """Completed revenue by month, from raw text to answer."""
    return queries()["q1_revenue_by_month"](spark, SMALL)


def _on_staging(fn: Callable[[Staging], DataFrame]) -> Query:
    return lambda spark, sf_dir: fn(fixtures.staging(spark, sf_dir))


def _exceptions(stg: Staging, *datasets: str) -> DataFrame:
    """The exception report, or the part of it on some datasets."""
    wanted = [r[0] for r in RULES if not datasets or r[1] in datasets]
    return run_rules(stg, wanted, detected_at=DETECTED_AT)


def _on_exceptions(fn: Callable[[DataFrame, DataFrame], DataFrame], *datasets: str) -> Query:
    """fn(exceptions, rules)"""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(_exceptions(fixtures.staging(spark, sf_dir), *datasets), registry(spark))

    return query


def _on_counts(fn: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    """fn(counts of the exceptions, rules)"""
    return _on_exceptions(lambda ex, rules: fn(report.exception_counts(ex), rules))


def _rule(rule_id: str) -> Query:
    return _on_staging(lambda stg: run_rules(stg, [rule_id], detected_at=DETECTED_AT).drop("detected_at"))


def _union(dfs: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, dfs)


def _column(df: DataFrame, raw: str, name: str, fn: Callable[[Column], Column], source: str | None = None) -> DataFrame:
    """source_row, the raw value and the cleaned one, labelled by table when several are stacked."""
    label = [] if source is None else [F.lit(source).alias("source")]
    return df.select(*label, SOURCE_ROW, F.col(raw).alias("raw"), fn(F.col(raw)).alias(name))


def _timestamps(stg: Staging) -> DataFrame:
    parts = [
        _column(stg.orders, "order_ts", "parsed", timestamps.parse_timestamp, "orders"),
        _column(stg.customers, "signup_date", "parsed", timestamps.parse_timestamp, "customers"),
        _column(stg.support_tickets, "created_ts", "parsed", timestamps.parse_timestamp, "support_tickets"),
    ]
    return _union(parts).withColumn("valid", F.col("parsed").isNotNull())


def _states(stg: Staging) -> DataFrame:
    return _union(
        [
            _column(stg.customers, "state", "standard", geography.standardize_state, "customers"),
            _column(stg.orders, "shipping_state", "standard", geography.standardize_state, "orders"),
        ]
    )


def _geo_before_after(stg: Staging) -> DataFrame:
    both = geography.standardize_geo_columns(stg.customers, "country", "state")
    return both.groupBy("country_raw", "state_raw", "country", "state").agg(F.count(F.lit(1)).alias("n"))


def _soft_duplicates(stg: Staging) -> DataFrame:
    keys = ["first_name", "last_name", "phone"]
    return dedup.mark_soft_duplicates(stg.customers.select(SOURCE_ROW, *keys), keys)


def _lineitem_winners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line per (order, line number): the table has no source position, so its columns give the order."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    keys = ["l_orderkey", "l_linenumber"]
    position = F.struct(*[c for c in lines.columns if c not in keys])
    return dedup.key_winners(lines.withColumn("position", position), keys, "position").drop("position")


def _flat(q3: DataFrame) -> DataFrame:
    """The list as text, so both engines hash the same value."""
    return q3.withColumn("triggered_rules", F.array_join("triggered_rules", "; "))


def _issues(stg: Staging) -> DataFrame:
    return answers.q3_order_issues(
        curate.fact_order(stg), _exceptions(stg, "orders", "payments"), curate.fact_payment(stg)
    )


def _q3(stg: Staging) -> DataFrame:
    return answers.q3_order_exceptions(curate.fact_order(stg), _issues(stg))


def _q2(stg: Staging) -> DataFrame:
    return answers.q2_top_customers(curate.fact_order(stg), curate.dim_customer(stg))


def _detail(stg: Staging) -> DataFrame:
    return answers.q5_per_customer_detail(
        curate.dim_customer(stg),
        curate.order_keys(stg),
        curate.fact_payment(stg),
        curate.fact_customer_issue(stg),
        _exceptions(stg, "orders", "payments"),
    )


def _scratch(spark: SparkSession) -> str:
    """A new folder that all executors share; a temporary one where none is named, as in local runs."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="feeds-")
    return f"{shared.rstrip('/')}/feeds-{uuid.uuid4().hex}"


def _as_files(spark: SparkSession, stg: Staging, *names: str) -> str:
    """Feeds as files in source order, CSV and JSON lines, each a folder of parts. Names of products have line breaks."""
    folder = _scratch(spark)
    for name in names or SOURCE_FILES:
        rows = getattr(stg, name).orderBy(SOURCE_ROW).select(*RAW_COLUMNS[name])
        if name == "products":
            rows = rows.withColumn("product_name", F.replace("product_name", F.lit(" "), F.lit("\n")))
        path = f"{folder}/{SOURCE_FILES[name]}"
        rows.write.json(path) if ".json" in path else export_csv(rows, path)
    return folder


def _from_files(*names: str) -> Callable[[Callable[[dict[str, DataFrame]], DataFrame]], Query]:
    """fn(tables read back from files)"""

    def with_tables(fn: Callable[[dict[str, DataFrame]], DataFrame]) -> Query:
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            folder = _as_files(spark, fixtures.staging(spark, sf_dir), *names)
            files = {n: f for n, f in SOURCE_FILES.items() if n in (names or SOURCE_FILES)}
            return fn(read_sources(spark, folder, files))

        return query

    return with_tables


def _exported(exceptions: DataFrame, _: DataFrame) -> DataFrame:
    """The exception report as CSV files and read again."""
    path = f"{_scratch(exceptions.sparkSession)}/exceptions"
    export_csv(exceptions.drop("detected_at"), path)
    columns = [f for f in exceptions.schema if f.name != "detected_at"]
    return read_csv(exceptions.sparkSession, path, StructType(columns)).drop(SOURCE_ROW)


def _landed(tables: dict[str, DataFrame]) -> Staging:
    """The raw tables as the job lands them."""
    spark = next(iter(tables.values())).sparkSession
    return land(tables, _scratch(spark))


def _raw_tables(stg: Staging) -> dict[str, DataFrame]:
    return {n: getattr(stg, n) for n in ("customers", "products", "orders", "payments", "support_tickets")}


def _training_data_queries() -> dict[str, Query]:
    """The operators for training-data pipelines, where that part is installed."""
    return {} if training_data is None else {**training_data.QUERIES, "pipeline": corpus_pipeline.run}


def queries() -> dict[str, Query]:
    return {
        **_training_data_queries(),
        # sources and staging
        "ingest_row_counts": _on_staging(lambda stg: row_counts(_raw_tables(stg))),
        "read_csv_products": _from_files("products")(lambda t: t["products"].drop(SOURCE_ROW)),
        "read_jsonl_tickets": _from_files("support_tickets")(lambda t: t["support_tickets"].drop(SOURCE_ROW)),
        "read_sources_row_counts": _from_files()(row_counts),
        "dedup_exact_kept_from_files": _from_files("orders")(lambda t: dedup.exact_kept(t["orders"]).drop(SOURCE_ROW)),
        "dedup_pk_winners_from_files": _from_files("customers")(
            lambda t: dedup.key_winners(t["customers"], ["customer_id"]).drop(SOURCE_ROW)
        ),
        "exceptions_from_files": _from_files()(lambda t: _exceptions(_landed(t)).drop("detected_at")),
        "export_csv_exceptions": _on_exceptions(_exported, "orders", "payments"),
        "customer_id_drift": _on_staging(lambda stg: drift(stg.customers, stg.support_tickets, "customer_id")),
        "stg_customers_duplicates": _on_staging(lambda stg: stg.customers_duplicates),
        "stg_orders_duplicates": _on_staging(lambda stg: stg.orders_duplicates),
        # column rules
        "parse_timestamp_formats": _on_staging(_timestamps),
        "coerce_decimal": _on_staging(lambda stg: _column(stg.orders, "order_total", "amount", numbers.to_decimal)),
        "coerce_integer": _on_staging(
            lambda stg: _column(stg.orders, "quantity", "number", lambda c: numbers.to_whole(c).cast("bigint"))
        ),
        "standardize_country": _on_staging(
            lambda stg: _column(stg.customers, "country", "standard", geography.standardize_country)
        ),
        "standardize_state": _on_staging(_states),
        "geo_before_after": _on_staging(_geo_before_after),
        "normalize_email": _on_staging(lambda stg: _column(stg.customers, "email", "email", contact.normalize_email)),
        "email_syntax_valid": _on_staging(lambda stg: _column(stg.customers, "email", "valid", contact.is_valid_email)),
        # duplicates
        "dedup_exact_kept": _on_staging(lambda stg: dedup.exact_kept(stg.orders)),
        "dedup_exact_dropped": _on_staging(lambda stg: dedup.exact_dropped(stg.orders)),
        "dedup_pk_winners": _on_staging(lambda stg: dedup.key_winners(stg.customers, ["customer_id"])),
        "dedup_pk_losers": _on_staging(lambda stg: dedup.key_losers(stg.orders, ["order_id"])),
        "dedup_pk_winners_lineitem": _lineitem_winners,
        "soft_duplicate_flag": _on_staging(_soft_duplicates),
        # curated tables
        **{name: _on_staging(build) for name, build in curate.BUILDERS.items()},
        # rules
        "dq001_customer_unique": _rule("DQ001"),
        "dq002_email": _rule("DQ002"),
        "dq003_geo_standardization": _rule("DQ003"),
        "dq004_order_unique": _rule("DQ004"),
        "dq005_order_customer_fk": _rule("DQ005"),
        "dq006_order_product_fk": _rule("DQ006"),
        "dq007_order_quantity": _rule("DQ007"),
        "dq008_order_total": _rule("DQ008"),
        "dq009_payment_order_fk": _rule("DQ009"),
        "dq010_payment_amount": _rule("DQ010"),
        "dq010_disagreeing_totals": _on_staging(disagreeing_totals),
        "dq011_ticket_timestamp": _rule("DQ011"),
        "dq012_ticket_customer_fk": _rule("DQ012"),
        "exceptions_ranked": _on_exceptions(lambda ex, _: with_severity_rank(ex).drop("detected_at")),
        "exceptions_by_detection": _on_exceptions(
            lambda ex, _: ex.groupBy("detected_at", "dataset").agg(F.count(F.lit(1)).alias("n"))
        ),
        "dq_exceptions_filtered": _on_exceptions(
            lambda ex, _: report.filter_exceptions(ex, ["DQ002", "DQ007", "DQ009"], ["High"]).drop("detected_at")
        ),
        # business questions
        "q1_revenue_by_month": _on_staging(lambda stg: answers.q1_revenue_by_month(curate.fact_order(stg))),
        "q2_top_customers": _on_staging(_q2),
        "q3_order_exceptions": _on_staging(lambda stg: _flat(_q3(stg))),
        "q3_order_issues": _on_staging(_issues),
        "q3_filtered_by_rule": _on_staging(
            lambda stg: _flat(answers.q3_filtered_by_rule(_q3(stg), ["DQ006", "DQ010"]))
        ),
        "q3_distinct_rules": _on_staging(lambda stg: answers.q3_distinct_rules(_q3(stg))),
        "q3_summary": _on_counts(lambda n, _: answers.q3_summary(n)),
        "q4_revenue_by_state": _on_staging(lambda stg: answers.q4_revenue_by_state(curate.fact_order(stg))),
        "q5_sentiment_link": _on_staging(lambda stg: answers.q5_sentiment_link(_detail(stg))),
        "q5_per_customer_detail": _on_staging(_detail),
        "orders_missing_payment": _on_staging(
            lambda stg: answers.orders_missing_payment(curate.fact_order(stg), curate.fact_payment(stg))
        ),
        # report tables
        "dq_summary": _on_counts(lambda n, _: report.dq_summary(n)),
        "dq_by_severity": _on_counts(lambda n, _: report.dq_by_severity(n)),
        "dq_by_rule": _on_counts(report.dq_by_rule),
        "dq_by_rule_severity": _on_counts(lambda n, _: report.dq_by_rule_severity(n)),
        "dq_samples_per_rule": _on_exceptions(report.dq_samples_per_rule),
        "rule_reference": _on_counts(report.rule_reference),
        "kpi_metrics": _on_staging(
            lambda stg: report.kpi_metrics(
                curate.dim_customer(stg), curate.fact_order(stg), report.exception_counts(_exceptions(stg))
            ).drop("last_run")
        ),
        "curated_row_counts": _on_staging(
            lambda stg: row_counts({**curate.curated(stg), EXCEPTION_TABLE: _exceptions(stg)})
        ),
        "reconcile_totals": _on_staging(
            lambda stg: report.reconcile_totals(stg, curate.fact_order(stg), curate.fact_payment(stg))
        ),
        "numbers_not_held": _on_staging(report.numbers_not_held),
        "table_profile": _on_staging(
            lambda stg: report.table_profile({"dim_product": curate.dim_product(stg), "fact_payment": curate.fact_payment(stg)})
        ),
        "rule_samples_dq005": _on_exceptions(lambda ex, _: report.rule_samples(ex, "DQ005").drop("detected_at")),
        "preview_dim_product": _on_staging(
            lambda stg: report.preview(curate.dim_product(stg).orderBy("product_key", "unit_price"))
        ),
        "finding_q1": _on_staging(
            lambda stg: answers.finding_q1(answers.q1_revenue_by_month(curate.fact_order(stg)))
        ),
        "finding_q2": _on_staging(lambda stg: answers.finding_q2(_q2(stg))),
        "finding_q3": _on_staging(lambda stg: answers.finding_q3(_q3(stg))),
        "finding_q4": _on_staging(
            lambda stg: answers.finding_q4(answers.q4_revenue_by_state(curate.fact_order(stg)))
        ),
        "finding_q5": _on_staging(lambda stg: answers.finding_q5(answers.q5_sentiment_link(_detail(stg)))),
    }


def oracle_sql() -> dict[str, str]:
    """The same results in DuckDB SQL."""
    return {**statements(), **({} if training_data is None else training_data.ORACLE)}
