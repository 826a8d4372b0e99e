"""Every branch of every rule on rows of our own."""

from __future__ import annotations

import random
from datetime import datetime
from decimal import Decimal

import pytest
from feeds import staging

from tidyledger.plans.report import numbers_not_held
from tidyledger.rules import violations
from tidyledger.rules.registry import ACTIONS, RULE_IDS, RULES, drift, load_registry, registry
from tidyledger.rules.run import find_violations, run_rules, with_severity_rank
from tidyledger.schemas import EXCEPTIONS, struct_of


def found(stg, rule):
    return sorted((r.record_key, r.issue_description) for r in find_violations(stg, [rule]).collect())


def test_clean_feeds_have_no_exceptions(spark):
    report = run_rules(staging(spark))
    assert report.schema == struct_of(EXCEPTIONS) or [f.name for f in report.schema] == struct_of(EXCEPTIONS).names
    assert report.collect() == []


def test_dq001(spark):
    rows = [{}, {"customer_id": "C2"}, {"email": "b@x.com"}, {"email": None}]
    text = "Duplicate customer_id=C1; this row (email={}) was dropped in favour of the canonical first occurrence."
    assert found(staging(spark, customers=rows), "DQ001") == [
        ("C1", text.format("<missing>")), ("C1", text.format("b@x.com")),
    ]


def test_dq002(spark):
    rows = [{}, {"customer_id": "C2", "email": None}, {"customer_id": "C3", "email": "  "}, {"customer_id": "C4", "email": "x@"}]
    assert found(staging(spark, customers=rows), "DQ002") == [
        ("C2", "customer_id=C2: email is missing."),
        ("C3", "customer_id=C3: email is missing."),
        ("C4", "customer_id=C4: email 'x@' failed syntactic validation."),
    ]


def test_dq003(spark):
    rows = [
        {"customer_id": "C1", "country": "USA ", "state": " IL"},
        {"customer_id": "C2", "country": "US", "state": "Illinois"},
        {"customer_id": "C3", "country": None, "state": "il"},
        {"customer_id": "C4", "country": " Canada", "state": "Ontario"},
        {"customer_id": "C5", "country": "u.s.a.", "state": None},
        {"customer_id": "C6", "country": " ", "state": ""},
    ]
    assert found(staging(spark, customers=rows), "DQ003") == [
        ("C2", "customer_id=C2: country 'US' standardized to 'USA'; state 'Illinois' standardized to 'IL'."),
        ("C3", "customer_id=C3: state 'il' standardized to 'IL'."),
        ("C5", "customer_id=C5: country 'u.s.a.' standardized to 'USA'."),
    ]


def test_dq004(spark):
    rows = [{}, {}, {"order_total": "1"}, {"order_total": "1"}, {"order_id": "O2"}, {}, {"order_id": None}, {"order_id": None}]
    same = "Duplicate order_id={}; identical row was dropped (no information lost)."
    other = "Duplicate order_id={}; later occurrence with different attributes was dropped in favour of the canonical first row."
    got = find_violations(staging(spark, orders=rows), ["DQ004"]).collect()
    assert sorted((r.record_key or "", r.issue_description) for r in got) == [
        ("", same.format("<missing>")), ("O1", same.format("O1")), ("O1", same.format("O1")), ("O1", same.format("O1")),
        ("O1", other.format("O1")),
    ]


def test_dq005_and_dq006(spark):
    rows = [
        {}, {"order_id": "O2", "customer_id": None, "product_id": None},
        {"order_id": "O3", "customer_id": "C9", "product_id": "P9"},
        {"order_id": "O4", "customer_id": "c1", "product_id": "P1 "},
    ]
    stg = staging(spark, orders=rows, customers=[{}, {"customer_id": None}], products=[{}, {"product_id": None}])
    assert found(stg, "DQ005") == [
        ("O2", "order_id=O2: customer_id is missing."),
        ("O3", "order_id=O3: customer_id 'C9' not found in customers."),
        ("O4", "order_id=O4: customer_id 'c1' not found in customers."),
    ]
    assert found(stg, "DQ006") == [
        ("O2", "order_id=O2: product_id is missing."),
        ("O3", "order_id=O3: product_id 'P9' not found in products."),
        ("O4", "order_id=O4: product_id 'P1 ' not found in products."),
    ]


def test_dq007(spark):
    rows = [
        {"order_id": "O1", "quantity": None}, {"order_id": "O2", "quantity": " "}, {"order_id": "O3", "quantity": "1.5"},
        {"order_id": "O4", "quantity": "0"}, {"order_id": "O5", "quantity": "-2.0", "order_status": " COMPLETED "},
        {"order_id": "O6", "quantity": "-1", "order_status": "returned"}, {"order_id": "O7", "quantity": "1e1"},
        {"order_id": "O8", "quantity": None, "order_status": None},
    ]
    start = "order_id={}: completed-order quantity "
    assert found(staging(spark, orders=rows), "DQ007") == [
        ("O1", start.format("O1") + "is missing."), ("O2", start.format("O2") + "' ' is not a valid integer."),
        ("O3", start.format("O3") + "'1.5' is not a valid integer."), ("O4", start.format("O4") + "0 is not positive."),
        ("O5", start.format("O5") + "-2 is not positive."),
    ]


def test_dq008(spark):
    rows = [
        {"order_id": "O1", "order_total": "20.01"}, {"order_id": "O2", "order_total": "20.011"},
        {"order_id": "O3", "order_total": "14", "order_status": "returned"}, {"order_id": "O4", "order_total": "n/a"},
        {"order_id": "O5", "product_id": "P9", "order_total": "1"}, {"order_id": "O6", "quantity": "x", "order_total": "1"},
        {"order_id": "O7", "product_id": None, "order_total": "1"}, {"order_id": "O8", "product_id": "P2", "order_total": "5"},
    ]
    # A repeated product keeps its first price and does not repeat its orders.
    products = [{}, {"unit_price": "99.00"}, {"product_id": None}, {"product_id": "P2", "unit_price": "bad"}]
    text = "order_id={}: order_total={} vs quantity*unit_price=20.00 (diff={})."
    assert found(staging(spark, orders=rows, products=products), "DQ008") == [
        ("O2", text.format("O2", "20.011", "0.011")), ("O3", text.format("O3", "14", "-6.00")),
    ]


def test_dq009(spark):
    rows = [{}, {"payment_id": "PMT2", "order_id": None}, {"payment_id": "PMT3", "order_id": "O9"}]
    stg = staging(spark, payments=rows, orders=[{}, {}, {"order_id": None}])
    assert found(stg, "DQ009") == [
        ("PMT2", "payment_id=PMT2: payment order_id is missing."),
        ("PMT3", "Orphan payment: order_id=O9 not found in orders (payment_id=PMT3)."),
    ]


def test_dq010(spark):
    orders = [
        {}, {}, {"shipping_state": "NY"}, {"order_id": "O2", "order_status": "returned"},
        {"order_id": "O3", "order_total": "n/a"}, {"order_id": "O4", "order_total": "50", "order_status": " Completed"},
    ]
    payments = [
        {"amount": "14.00"}, {"payment_id": "PMT2", "order_id": "O2", "amount": "1"},
        {"payment_id": "PMT3", "order_id": "O3", "amount": "1"}, {"payment_id": "PMT4", "order_id": "O4", "amount": "44.00", "payment_status": "SETTLED "},
        {"payment_id": "PMT5", "amount": "1", "payment_status": "voided"}, {"payment_id": "PMT6", "amount": "19.99"},
        {"payment_id": "PMT7", "order_id": None, "amount": "1"},
    ]
    stg = staging(spark, orders=orders, payments=payments)
    assert found(stg, "DQ010") == [
        ("PMT1", "payment_id=PMT1: settled payment 14.00 != completed order total 20.00 (diff=6.00)."),
        ("PMT4", "payment_id=PMT4: settled payment 44.00 != completed order total 50 (diff=6.00)."),
    ]
    both = find_violations(stg, ["DQ009", "DQ010"]).collect()
    assert sorted(r.rule_id for r in both) == ["DQ009", "DQ010", "DQ010"]


@pytest.mark.parametrize("copies", [1, 300])
def test_dq010_names_the_total_that_differs_most_however_many_there_are(spark, copies):
    """One definition at every size: each settled payment that disagrees with some total gives one exception."""
    totals = ["10.00", "10.005", "10.01", "10.02", "20", "n/a", "10.00", "9.99", "9.98"] * copies
    orders = [{"order_id": "O1", "order_total": t, "shipping_state": f"s{i}"} for i, t in enumerate(totals)]
    orders += [{"order_id": "O1", "order_total": "700", "order_status": "returned"}, {"order_id": "O2", "order_total": "10.00"}]
    orders += [{"order_id": "O2", "order_total": "10.01"}, {"order_id": "O3", "order_total": "6"}, {"order_id": "O3", "order_total": "4.00"}]
    payments = [("A", "O1", "10.00"), ("A", "O1", "10.00"), ("B", "O1", "20.00"), ("C", "O1", "n/a"), ("D", "O2", "10.00"), ("E", "O3", "5.00")]
    stg = staging(spark, orders=orders, payments=[{"payment_id": p, "order_id": o, "amount": a} for p, o, a in payments])
    text = "payment_id={}: settled payment {} != completed order total {} (diff={})."
    assert found(stg, "DQ010") == [
        ("A", text.format("A", "10.00", "20", "10.00")), ("A", text.format("A", "10.00", "20", "10.00")),
        ("B", text.format("B", "20.00", "9.98", "-10.02")), ("E", text.format("E", "5.00", "6", "1.00")),
    ]


def test_no_job_runs_while_the_plan_is_built(spark):
    stg = staging(spark, payments=[{"amount": "1"}])
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "planning")
    try:
        run_rules(stg)
        assert list(tracker.getJobIdsForGroup("planning")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_large_numbers_are_compared_and_never_called_junk(spark):
    orders = [
        {"order_id": "O1", "order_total": "123456789012345.67"}, {"order_id": "O2", "quantity": "3000000000", "order_total": "30000000000.02"},
        {"order_id": "O3", "order_total": "20.01000001"}, {"order_id": "O4", "quantity": "9" * 20}, {"order_id": "O5", "quantity": "-" + "9" * 20},
        {"order_id": "O6", "order_total": "9" * 20},
    ]
    stg = staging(spark, orders=orders)
    text = "order_id={}: order_total={} vs quantity*unit_price={} (diff={})."
    assert found(stg, "DQ008") == [
        ("O1", text.format("O1", "123456789012345.67", "20.00", "123456789012325.67")),
        ("O2", text.format("O2", "30000000000.02", "30000000000.00", "0.02")),
        ("O3", text.format("O3", "20.01000001", "20.00", "0.01000001")),
        ("O6", text.format("O6", "9" * 20, "20.00", "99999999999999999979.00")),
    ]
    assert found(stg, "DQ007") == [("O5", f"order_id=O5: completed-order quantity -{'9' * 20} is not positive.")]
    held = {(r.record_key, r.column_name, r.problem) for r in numbers_not_held(stg).collect()}
    assert held == {
        ("O1", "order_total", "too large for the curated table"), ("O1", "order_amount_variance", "too large for the curated table"),
        ("O2", "quantity", "too large for the curated table"), ("O2", "order_total", "too large for the curated table"),
        ("O2", "calculated_order_amount", "too large for the curated table"), ("O4", "quantity", "too large to be checked"),
        ("O5", "quantity", "too large to be checked"), ("O6", "order_total", "too large for the curated table"),
        ("O6", "order_amount_variance", "too large for the curated table"),
    }


def test_dq011_and_dq012(spark):
    rows = [
        {}, {"ticket_id": "T2", "created_ts": None, "customer_id": None}, {"ticket_id": "T3", "created_ts": " \t", "customer_id": "C9"},
        {"ticket_id": "T4", "created_ts": "bad"},
    ]
    stg = staging(spark, support_tickets=rows)
    assert found(stg, "DQ011") == [
        ("T2", "ticket_id=T2: created_ts is missing."), ("T3", "ticket_id=T3: created_ts is missing."),
        ("T4", "ticket_id=T4: created_ts failed to parse: 'bad'."),
    ]
    assert found(stg, "DQ012") == [
        ("T2", "ticket_id=T2: customer_id is missing."), ("T3", "ticket_id=T3: customer_id 'C9' not found in customers."),
    ]


def test_report_is_completed_from_the_registry(spark):
    moment = datetime(2025, 6, 1, 12, 30)
    row = run_rules(staging(spark, customers=[{"email": None}]), detected_at=moment).first()
    assert (row.rule_id, row.dataset, row.severity, row.suggested_action, row.detected_at) == (
        "DQ002", "customers", "Medium", ACTIONS["DQ002"], moment,
    )


def test_severity_rank(rows):
    got = with_severity_rank(rows("severity string", "High", "Medium", "Low", "Other", None)).collect()
    assert [r.severity_rank for r in got] == [0, 1, 2, 99, 99]


def test_unknown_rule_names_are_refused(spark):
    with pytest.raises(ValueError):
        find_violations(staging(spark), ["DQ999"])


def test_registry_file(spark, tmp_path):
    def write(name, rules):
        path = tmp_path / name
        path.write_text("rule_id,dataset,rule_description,severity\n" + "\n".join(",".join(f'"{c}"' for c in r) for r in rules))
        return str(path)

    padded = [(f" {r[0]} ", *r[1:]) for r in RULES]
    loaded = load_registry(spark, write("good.csv", padded))
    assert sorted(loaded.select("rule_id", "dataset", "description", "severity", "suggested_action").collect()) == sorted(
        registry(spark).collect()
    )
    with pytest.raises(ValueError, match="DQ012 only on the right"):
        load_registry(spark, write("short.csv", RULES[:-1]))
    with pytest.raises(ValueError, match="DQ013 only on the left"):
        load_registry(spark, write("long.csv", [*RULES, ("DQ013", "orders", "new", "Low")]))
    with pytest.raises(ValueError, match="another dataset"):
        load_registry(spark, write("moved.csv", [("DQ001", "orders", "x", "Low"), *RULES[1:]]))
    with pytest.raises(ValueError, match="DQ013 only on the left and 1 more"):
        load_registry(spark, write("longer.csv", [*RULES, ("DQ013", "orders", "new", "Low"), ("DQ014", "orders", "new", "Low")]))
    assert len(RULE_IDS) == 12
    assert drift(registry(spark), registry(spark)).collect() == []


def test_the_last_line_of_a_rule_counts_and_no_exception_is_doubled(spark, tmp_path):
    path = tmp_path / "twice.csv"
    lines = [*RULES, ("DQ002", "customers", "said again", "Low"), *RULES[3:], ("DQ005", "orders", "third time", "Medium")]
    path.write_text("rule_id,dataset,rule_description,severity\n" + "\n".join(",".join(f'"{c}"' for c in r) for r in lines))
    rules = load_registry(spark, str(path))
    assert rules.count() == 12
    assert {r.rule_id: r.severity for r in rules.collect()}["DQ002"] == "Low"
    stg = staging(spark, customers=[{"email": None}, {"customer_id": "C2", "email": "x"}])
    assert run_rules(stg, rules=rules).filter("rule_id = 'DQ002'").count() == run_rules(stg).filter("rule_id = 'DQ002'").count() == 2
    doubled = registry(spark).union(registry(spark))
    assert run_rules(stg, rules=doubled).count() == run_rules(stg).count()


def test_drift_goes_both_ways(spark):
    left = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    right = spark.createDataFrame([("b",), ("c",), ("c",), (None,)], "k string")
    assert sorted(map(tuple, drift(left, right, "k").collect())) == [("a", "only on the left"), ("c", "only on the right")]


def test_numbers_wider_than_the_working_type_are_compared_exactly(spark):
    large, long = "1234567890123456789012345678901234.00", "0.123456789012345678"
    orders = [
        {"order_id": "O1", "product_id": "P1", "quantity": "2", "order_total": "2469135780246913578024691357802468.00"},
        {"order_id": "O2", "product_id": "P1", "quantity": "2", "order_total": "2469135780246913578024691357802468.02"},
        {"order_id": "O3", "product_id": "P2", "quantity": "1", "order_total": "0.133456789012345679"},
        {"order_id": "O4", "product_id": "P2", "quantity": "1", "order_total": "0.133456789012345678"},
        {"order_id": "O5", "product_id": "P3", "quantity": "123456789012345678", "order_total": "246913578024691356.02"},
        {"order_id": "O6", "product_id": "P3", "quantity": "1", "order_total": "1" + "0" * 36},
        {"order_id": "O7", "product_id": "P3", "quantity": "-123456789012345678", "order_total": "2.00"},
    ]
    products = [{"product_id": f"P{i}", "unit_price": p} for i, p in enumerate([large, long, "2.00"], 1)]
    payments = [
        {"payment_id": "PMT1", "order_id": "O1", "amount": "2469135780246913578024691357802468.010000001"},
        {"payment_id": "PMT2", "order_id": "O1", "amount": "2469135780246913578024691357802468.01"},
        {"payment_id": "PMT3", "order_id": "O3", "amount": "0.123456789012345678"},
        {"payment_id": "PMT4", "order_id": "O6", "amount": "1" + "0" * 36},
    ]
    stg = staging(spark, orders=orders, products=products, payments=payments)
    text = "order_id={}: order_total={} vs quantity*unit_price={} (diff={})."
    assert found(stg, "DQ008") == [
        ("O2", text.format("O2", "2469135780246913578024691357802468.02", "2469135780246913578024691357802468.00", "0.02")),
        ("O3", text.format("O3", "0.133456789012345679", long, "0.010000000000000001")),
        ("O5", text.format("O5", "246913578024691356.02", "246913578024691356.00", "0.02")),
        ("O7", text.format("O7", "2.00", "-246913578024691356.00", "246913578024691358.00")),
    ]
    settled = "payment_id={}: settled payment {} != completed order total {} (diff={})."
    assert found(stg, "DQ010") == [
        ("PMT1", settled.format(
            "PMT1", payments[0]["amount"], "2469135780246913578024691357802468.00", "-0.010000001")),
        ("PMT3", settled.format("PMT3", "0.123456789012345678", "0.133456789012345679", "0.010000000000000001")),
    ]
    assert found(stg, "DQ007") == [("O7", "order_id=O7: completed-order quantity -123456789012345678 is not positive.")]
    listed = {(r.record_key, r.column_name) for r in numbers_not_held(stg).filter("problem = 'too large to be checked'").collect()}
    assert listed == {("O6", "order_total"), ("PMT4", "amount")}


@pytest.mark.parametrize("most", [4096, 3])
def test_every_total_a_payment_disagrees_with(spark, most, monkeypatch):
    """Against all pairs; identical order rows count once, and runs of totals may be short."""
    rng = random.Random(4)
    totals = ["20.00", "20.0", "20.01", "20.02", "19.99", "5", "-1.00", "x", None, "1e2", "123456789012345678.5", "20.005", "20.0100000001"]
    orders = [
        {"order_id": rng.choice(["O1", "O1", "O1", "O2", None]), "order_total": rng.choice(totals), "shipping_state": rng.choice(["IL", "NY"]),
         "order_status": rng.choice(["completed", " Completed", "returned"])}
        for _ in range(120)
    ]
    payments = [
        {"payment_id": f"PMT{i}", "order_id": rng.choice(["O1", "O2", "O3", None]), "amount": rng.choice(totals),
         "payment_status": rng.choice(["settled", "Settled ", "voided"])}
        for i in range(40)
    ]
    stg = staging(spark, orders=orders, payments=payments)
    monkeypatch.setattr(violations.total_runs, "__defaults__", (most,))
    value = lambda t: None if t in ("x", None) else Decimal(t)
    kept = {(o["order_id"], o["order_total"], o["shipping_state"], o["order_status"]) for o in orders}
    want = sorted(
        (p["payment_id"], p["order_id"], total)
        for p in payments for order_id, total, _, status in kept
        if p["order_id"] and p["order_id"] == order_id and status.strip().lower() == "completed"
        and p["payment_status"].strip().lower() == "settled" and value(total) is not None and value(p["amount"]) is not None
        and abs(value(total) - value(p["amount"])) > Decimal("0.01")
    )
    got = violations.disagreeing_totals(stg).collect()
    assert sorted((r.payment_id, r.order_id, r.order_total) for r in got) == want and want
    one = {r.record_key for r in find_violations(stg, ["DQ010"]).collect()}
    assert {r.payment_id for r in got} == one
    named = {(r.record_key, r.issue_description) for r in find_violations(stg, ["DQ010"]).collect()}
    assert named <= {(r.payment_id, r.issue_description) for r in got}
