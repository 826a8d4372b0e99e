"""Report helpers that read stored tables: listing, filters, samples, previews, profiles."""

from __future__ import annotations

from datetime import datetime

import pytest

from tidyledger.plans import report
from tidyledger.rules.registry import registry
from tidyledger.schemas import EXCEPTIONS


@pytest.fixture
def exceptions(spark):
    def row(rule, key, severity="High", day=1, text="x"):
        return (rule, "orders", key, severity, text, "act", datetime(2025, 6, day))

    data = [row("DQ005", f"O{i}", day=i) for i in range(1, 8)]
    data += [row("DQ011", "T1", "Medium"), row("DQ004", None), row("DQ004", "O2", text="a|b" + "y" * 200), row("DQ999", "Z", "Odd")]
    return spark.createDataFrame(data, EXCEPTIONS)


def test_listing_sorts_by_severity_rule_and_key(exceptions):
    got = [(r.rule_id, r.record_key) for r in report.listing(exceptions).collect()]
    assert got == [("DQ004", "O2"), ("DQ004", None)] + [("DQ005", f"O{i}") for i in range(1, 8)] + [("DQ011", "T1"), ("DQ999", "Z")]


def test_filter_with_and_without_choices(exceptions):
    assert report.filter_exceptions(exceptions).count() == 11
    assert report.filter_exceptions(exceptions, ["DQ005", "DQ011"]).count() == 8
    assert report.filter_exceptions(exceptions, ["DQ005", "DQ011"], ["Medium"]).count() == 1
    assert report.filter_exceptions(exceptions, [], ["High"]).count() == 9


def test_samples_are_the_newest_of_each_rule(spark, exceptions):
    rows = report.dq_samples_per_rule(exceptions, registry(spark)).collect()
    by_rule = {}
    for r in rows:
        by_rule.setdefault(r.rule_id, []).append((r.sample, r.record_key, r.issue))
    assert len(by_rule) == 12
    assert sorted(by_rule["DQ005"]) == [(i, f"O{8 - i}", "x") for i in range(1, 6)]
    assert by_rule["DQ001"] == [(None, None, None)]
    assert sorted(by_rule["DQ004"])[0] == (1, "O2", "a\\|b" + "y" * 113 + "...")
    assert [r.record_key for r in report.rule_samples(exceptions, "DQ005", 2).collect()] == ["O7", "O6"]


def test_summary_counts(exceptions):
    counts = report.exception_counts(exceptions)
    assert tuple(report.dq_summary(counts).first()) == (11, 4, 9, 1)
    assert tuple(report.dq_summary(report.exception_counts(exceptions.limit(0))).first()) == (0, 0, 0, 0)
    assert [tuple(r) for r in report.dq_by_severity(counts).collect()] == [("High", 9), ("Medium", 1), ("Odd", 1)]
    assert [tuple(r) for r in report.dq_by_rule_severity(counts).collect()][:2] == [("DQ004", "High", 2), ("DQ005", "High", 7)]


def test_kpis_on_empty_tables(spark, exceptions):
    customers = spark.createDataFrame([], "customer_key string")
    orders = spark.createDataFrame([], "order_status string, gross_order_amount decimal(12,2)")
    row = report.kpi_metrics(customers, orders, report.exception_counts(exceptions)).first()
    assert (row.total_customers, row.completed_revenue, row.total_exceptions, row.last_run) == (0, 0, 11, datetime(2025, 6, 7))


def test_profile_and_preview(spark, exceptions):
    rows = report.table_profile({"e": exceptions, "none": exceptions.limit(0)}).orderBy("table_name", "position").collect()
    assert [(r.column_name, r.data_type, r.row_count, r.filled) for r in rows][:3] == [
        ("rule_id", "string", 11, 11), ("dataset", "string", 11, 11), ("record_key", "string", 11, 10),
    ]
    assert rows[6].data_type == "timestamp_ntz" and len(rows) == 14 and rows[-1].row_count == rows[-1].filled == 0
    assert report.preview(exceptions, 3).count() == 3
