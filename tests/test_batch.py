"""Readers, writers and the whole job on files: on the derived feeds, and on a small extract with answers by hand."""

from __future__ import annotations

import bz2
import csv
import json
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import SMALL
from feeds import staging
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import __spark_entry__ as driver
from tidyledger import batch, fixtures, runs
from tidyledger.batch import run
from tidyledger.operators import dedup
from tidyledger.plans.curate import BUILDERS
from tidyledger.rules.run import run_rules
from tidyledger.rules.staging import Staging
from tidyledger.schemas import CURATED, RAW_COLUMNS, raw_struct, struct_of
from tidyledger.sinks import export_csv, write_table
from tidyledger.sources.raw import SOURCE_FILES, read_csv, read_jsonl, read_sources, row_counts

FAILED_READ = (PySparkException, Py4JJavaError)
PRODUCTS = raw_struct("products")
HEADER = ",".join(RAW_COLUMNS["products"])


def put(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv_cells(spark, tmp_path):
    path = put(tmp_path / "p.csv", f'{HEADER}\nP1,"a, ""b""",NA,1.00,Y\n\nP2,,"",NULL,N/A\nP3,x\n')
    got = [tuple(r)[:-1] for r in read_csv(spark, path, PRODUCTS).orderBy("source_row").collect()]
    assert got == [("P1", 'a, "b"', "NA", "1.00", "Y"), ("P2", None, None, "NULL", "N/A"), ("P3", "x", None, None, None)]


def test_csv_with_too_many_cells_or_another_header_fails(spark, tmp_path):
    with pytest.raises(FAILED_READ, match="too many cells"):
        read_csv(spark, put(tmp_path / "long.csv", f"{HEADER}\nP1,a,b,1,Y,extra\n"), PRODUCTS).collect()
    with pytest.raises(FAILED_READ):
        read_csv(spark, put(tmp_path / "head.csv", "id,product_name,category,unit_price,active_flag\nP1,a,b,1,Y\n"), PRODUCTS).collect()


BROKEN = f'{HEADER}\nP1,"two\nlines",c,1.00,Y\nP2,d,"e, ""f""\r\n\n",2,N\n'


def test_csv_cells_with_line_breaks(spark, tmp_path):
    path = put(tmp_path / "m.csv", BROKEN)
    for multi_line in (None, True):
        rows = read_csv(spark, path, PRODUCTS, multi_line).orderBy("source_row").collect()
        assert [(r.product_id, r.product_name, r.unit_price) for r in rows] == [("P1", "two\nlines", "1.00"), ("P2", "d", "2")]
    with pytest.raises(ValueError, match="unbalanced quote in .*m.csv"):
        read_csv(spark, path, PRODUCTS, multi_line=False)


def test_only_files_with_line_breaks_are_read_whole(spark, tmp_path):
    folder = tmp_path / "a folder {1,2}"
    folder.mkdir()
    put(folder / "a.csv", HEADER + "\n" + "".join(f"A{i:05d},n,c,1,Y\n" for i in range(3000)))
    put(folder / "b [x] 50%.csv", BROKEN)
    put(folder / "c.csv", HEADER + "\n" + "".join(f'C{i:05d},"n",c,1,Y\n' for i in range(3000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        df = read_csv(spark, str(folder).replace("{", "\\{").replace("}", "\\}").replace(",", "\\,"), PRODUCTS)
        assert df.rdd.getNumPartitions() > 5
        rows = df.orderBy("source_row").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = [f"A{i:05d}" for i in range(3000)] + ["P1", "P2"] + [f"C{i:05d}" for i in range(3000)]
    assert [r.product_id for r in rows] == want and len({r.source_row for r in rows}) == len(want)
    assert rows[3000].product_name == "two\nlines"


def test_sources_with_line_breaks(spark, tmp_path):
    stg = staging(spark)
    for name, columns in RAW_COLUMNS.items():
        row = getattr(stg, name).select(*columns).first().asDict()
        if name == "support_tickets":
            put(tmp_path / SOURCE_FILES[name], json.dumps(row) + "\n")
        else:
            row |= {"product_name": "two\nlines"} if name == "products" else {}
            with open(tmp_path / SOURCE_FILES[name], "w", newline="") as f:
                csv.writer(f).writerows([columns, [row[c] for c in columns]])
    tables = read_sources(spark, str(tmp_path))
    assert [r.product_name for r in tables["products"].collect()] == ["two\nlines"]
    assert {r.table_name: r.row_count for r in row_counts(tables).collect()} == dict.fromkeys(RAW_COLUMNS, 1)
    with pytest.raises(ValueError, match="unbalanced"):
        read_sources(spark, str(tmp_path), multi_line=False)


def test_first_rows_over_csv_need_no_sort_and_shuffle_no_path(spark, tmp_path):
    folder = tmp_path / "orders"
    folder.mkdir()
    line = "O{},C1,2025-03-01 10:00,P1,2,completed,IL,20.00\n"
    for part in range(3):
        put(folder / f"{part}.csv", ",".join(RAW_COLUMNS["orders"]) + "\n" + "".join(line.format(i // 2) for i in range(50)))
    orders = read_csv(spark, str(folder), raw_struct("orders"))
    assert dict(orders.dtypes)["source_row"] == "bigint"
    stg = Staging({"orders": orders})
    for df in (dedup.exact_kept(orders), stg.order_contents, dedup.key_losers(orders, ["order_id"]), dedup.exact_dropped(orders)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "HashAggregate" in plan and "SortAggregate" not in plan, plan  # a sort for a join comes after it
        assert not [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "_path" in x]
    kept = dedup.exact_kept(orders).orderBy("source_row").collect()
    assert [r.order_id for r in kept] == [f"O{i}" for i in range(25)]
    first = orders.orderBy("source_row").select("source_row", "order_id").collect()
    assert [r.source_row for r in kept] == [r.source_row for r in first[:50:2]]


def test_jsonl(spark, tmp_path):
    columns = RAW_COLUMNS["support_tickets"]
    lines = [
        json.dumps({"ticket_id": "T1", "customer_id": 7, "created_ts": None, "other": 1, "description": "a\nb"}),
        "", "   ", json.dumps({"ticket_id": "T2", "sentiment": "neutral"}),
    ]
    got = read_jsonl(spark, put(tmp_path / "t.jsonl", "\n".join(lines) + "\n"), columns).orderBy("source_row").collect()
    assert [(r.ticket_id, r.customer_id, r.created_ts, r.sentiment, r.description) for r in got] == [
        ("T1", "7", None, None, "a\nb"), ("T2", None, None, "neutral", None),
    ]
    with pytest.raises(FAILED_READ):
        read_jsonl(spark, put(tmp_path / "bad.jsonl", '{"ticket_id": "T1"}\n{broken\n'), columns).collect()


def test_source_row_follows_file_and_line_order_over_many_tasks(spark, tmp_path):
    folder = tmp_path / "all parts"
    folder.mkdir()
    want = []
    for part in range(3):
        ids = [f"P{part}-{i:05d}" for i in range(4000 + part * 1000)]
        want += ids
        put(folder / f"part {part}%.csv", HEADER + "\n" + "".join(f"{i},name,cat,1.00,Y\n" for i in ids))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = read_csv(spark, str(folder), PRODUCTS)
        assert df.rdd.getNumPartitions() > 10
        got = [r.product_id for r in df.orderBy("source_row").collect()]
        assert df.select("source_row").distinct().count() == len(want)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == want


def test_source_row_is_unique_in_a_compressed_file_that_is_split(spark, tmp_path):
    path = tmp_path / "p.csv.bz2"
    with bz2.open(path, "wt", compresslevel=1) as f:
        f.write(HEADER + "\n" + "P1,name,cat,1.00,Y\n" * 200_000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    try:
        df = read_csv(spark, str(path), PRODUCTS)
        assert df.rdd.getNumPartitions() > 1
        assert df.count() == df.select("source_row").distinct().count() == 200_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_csv_export_keeps_its_header_when_empty(spark, tmp_path):
    export_csv(run_rules(staging(spark)), str(tmp_path / "out"))
    files = [f for f in (tmp_path / "out").iterdir() if f.name.endswith(".csv")]
    assert len(files) == 1
    assert files[0].read_text().strip() == "rule_id,dataset,record_key,severity,issue_description,suggested_action,detected_at"


def test_csv_export_round_trip(spark, tmp_path):
    df = spark.createDataFrame([('a "q", b', ["x", "y"]), (None, [])], "t string, l array<string>")
    export_csv(df, str(tmp_path / "out"))
    rows = []
    for f in sorted((tmp_path / "out").glob("*.csv")):
        rows += list(csv.reader(f.open()))[1:]
    assert sorted(rows) == sorted([['a "q", b', "x; y"], ["", ""]])


def test_write_table_can_be_repeated(spark, tmp_path):
    df = spark.range(10)
    for _ in range(2):
        assert write_table(df, str(tmp_path / "t")).count() == 10


def test_row_counts(spark):
    got = row_counts({"a": spark.range(3), "b": spark.range(0)}).collect()
    assert {r.table_name: r.row_count for r in got} == {"a": 3, "b": 0}


MOMENT = datetime(2025, 6, 1)


@pytest.fixture(scope="module")
def job(spark, tmp_path_factory):
    """The derived feeds as files, the job run twice over them; (feeds, first tables' rows, second tables)."""
    stg = fixtures.staging(spark, SMALL)
    feed, out = tmp_path_factory.mktemp("feed"), str(tmp_path_factory.mktemp("run"))
    for name, columns in RAW_COLUMNS.items():
        rows = getattr(stg, name).orderBy("source_row").select(*columns).collect()
        with open(feed / SOURCE_FILES[name], "w", newline="", encoding="utf-8") as f:
            if name == "support_tickets":
                f.writelines(json.dumps({k: v for k, v in r.asDict().items() if v is not None}) + "\n" for r in rows)
            else:
                writer = csv.writer(f)
                writer.writerow(columns)
                writer.writerows(rows)
    first = run(spark, str(feed), out, detected_at=MOMENT)
    before = {n: Counter(map(str, df.collect())) for n, df in first.items()}
    return stg, before, run(spark, str(feed), out, detected_at=MOMENT)


def test_rerun_gives_the_same_tables(job):
    _, before, again = job
    assert before == {n: Counter(map(str, df.collect())) for n, df in again.items()}


def test_job_on_files_equals_the_plans_on_the_feeds(spark, job):
    stg, _, tables = job
    for name, build in BUILDERS.items():
        assert Counter(tables[name].collect()) == Counter(build(stg).collect()), name
        assert [(f.name, f.dataType) for f in tables[name].schema] == [
            (f.name, f.dataType) for f in struct_of(CURATED[name])
        ]
    assert Counter(tables["dq_exception_report"].collect()) == Counter(run_rules(stg, detected_at=MOMENT).collect())
    queries = driver.queries()
    for name in ("q1_revenue_by_month", "q2_top_customers", "q4_revenue_by_state", "q5_sentiment_link", "ingest_row_counts",
                 "q3_summary", "q3_order_issues", "q3_distinct_rules", "dq_by_rule_severity", "rule_reference", "reconcile_totals",
                 "numbers_not_held", "dq_summary", "dq_by_rule", "dq_samples_per_rule", "curated_row_counts"):
        assert Counter(tables[name].collect()) == Counter(queries[name](spark, SMALL).collect()), name
    sentences = {r.question: r.finding for r in tables["findings"].collect()}
    assert sentences == {f"q{i}": queries[f"finding_q{i}"](spark, SMALL).first()[0] for i in range(1, 6)}


EXTRACT = {
    "customers": """customer_id,first_name,last_name,email,phone,country,state,signup_date,loyalty_tier
A1,Mia,Ray,mia@ray.org,555-1,USA,OH,2024-05-01,Gold
A2,Leo,Fox,,555-2,united states,Ohio,05/02/2024,Silver
A3,Mia,Ray,MIA2@ray.org ,555-1,US,TX,2024/05/03,Gold
A2,Leo,Fox,leo@fox.org,555-9,USA,OH,2024-05-04,Silver
""",
    "products": """product_id,product_name,category,unit_price,active_flag
X1,lamp,home,12.50,Y
X2,"desk, small",home,80.00,N
""",
    "orders": """order_id,customer_id,order_ts,product_id,quantity,order_status,shipping_state,order_total
R1,A1,2025-01-05 10:00:00,X1,2,completed,OH,25.00
R1,A1,2025-01-05 10:00:00,X1,2,completed,OH,25.00
R2,A2,01/20/2025 09:30,X2,1,completed,ohio,80.00
R3,A9,2025/02/01 08:00,X1,1,completed,TX,12.50
R4,A1,2025-02-03T12:00:00Z,X2,1,completed,TX,85.00
R5,A3,2025-02-04,X9,1,completed,TX,7.00
R6,A3,02-05-2025 10:00,X1,-1,completed,NY,-12.50
R7,A2,2025-02-06,X1,4,cancelled,OH,50.00
""",
    "payments": """payment_id,order_id,payment_ts,payment_method,payment_status,amount
M1,R1,2025-01-05 10:01,card,settled,25.00
M2,R2,2025-01-20 09:31,card,settled,80.00
M3,R3,2025-02-01 08:01,paypal,settled,12.50
M4,R4,2025-02-03 12:01,card,settled,80.00
M5,R77,2025-02-04 10:00,card,settled,5.00
M6,R6,2025-02-05 10:01,card,refunded,-12.50
""",
    "support_tickets": "".join(
        json.dumps(dict(zip(RAW_COLUMNS["support_tickets"], row))) + "\n"
        for row in [
            ("K1", "A1", "2025-02-10T09:00:00", "chat", "late", "Negative", "late again"),
            ("K2", "A3", "soon", "email", "praise", "positive", "fine"),
            ("K3", "A8", "2025-02-11", "phone", "other", "neutral", "?"),
        ]
    ),
}


@pytest.fixture(scope="module")
def extract(spark, tmp_path_factory):
    """The job on the extract above; every expected value below was worked out by hand."""
    feed, out = tmp_path_factory.mktemp("extract"), str(tmp_path_factory.mktemp("answers"))
    for name, text in EXTRACT.items():
        put(feed / SOURCE_FILES[name], text)
    return run(spark, str(feed), out, detected_at=MOMENT)


def test_extract_counts(extract):
    counts = {r.table_name: r.row_count for r in extract["ingest_row_counts"].collect()}
    assert counts == {"customers": 4, "products": 2, "orders": 8, "payments": 6, "support_tickets": 3}
    assert extract["dim_customer"].count() == 3 and extract["fact_order"].count() == 7
    per_rule = {r.rule_id: r.violations for r in extract["dq_by_rule"].collect()}
    assert per_rule == {
        "DQ001": 1, "DQ002": 1, "DQ003": 2, "DQ004": 1, "DQ005": 1, "DQ006": 1, "DQ007": 1, "DQ008": 1, "DQ009": 1, "DQ010": 1,
        "DQ011": 1, "DQ012": 1,
    }
    assert tuple(extract["dq_summary"].first()) == (13, 12, 8, 5)


def test_extract_curated_values(extract):
    people = {r.customer_key: r for r in extract["dim_customer"].collect()}
    assert {k: r.duplicate_resolution_flag for k, r in people.items()} == {"A1": False, "A2": False, "A3": True}
    assert (people["A2"].email, people["A2"].standard_state, people["A2"].standard_country) == (None, "OH", "USA")
    assert people["A2"].signup_date == date(2024, 5, 2) and people["A3"].email == "mia2@ray.org"
    order = {r.order_key: r for r in extract["fact_order"].collect()}
    assert (order["R4"].gross_order_amount, order["R4"].calculated_order_amount, order["R4"].order_amount_variance) == (
        Decimal("85.00"), Decimal("80.00"), Decimal("5.00"),
    )
    assert order["R5"].calculated_order_amount is None and order["R2"].shipping_state == "OH"
    assert {r.product_key: r.active_flag for r in extract["dim_product"].collect()} == {"X1": True, "X2": False}
    assert extract["fact_customer_issue"].filter("ticket_id = 'K2'").first().created_date is None
    assert [r.order_key for r in extract["orders_missing_payment"].collect()] == ["R5"]


def test_extract_answers(extract):
    q1 = [tuple(r) for r in extract["q1_revenue_by_month"].orderBy("month").collect()]
    assert q1 == [(date(2025, 1, 1), Decimal("105.00"), 2), (date(2025, 2, 1), Decimal("92.00"), 4)]
    q2 = [tuple(r) for r in extract["q2_top_customers"].orderBy(F.desc("completed_value")).collect()]
    assert q2 == [
        ("A1", "Mia Ray", "OH", Decimal("110.00"), 2), ("A2", "Leo Fox", "OH", Decimal("80.00"), 1), ("A3", "Mia Ray", "TX", Decimal("-5.50"), 2),
    ]
    q3 = {r.order_key: (r.triggered_rules, r.issue_count) for r in extract["q3_order_exceptions"].collect()}
    assert q3 == {
        "R1": (["DQ004"], 1), "R3": (["DQ005"], 1), "R4": (["DQ008", "DQ010"], 2), "R5": (["DQ006"], 1), "R6": (["DQ007"], 1),
    }
    issues = sorted(r.issue_description for r in extract["q3_order_issues"].filter("order_key = 'R4'").collect())
    assert issues == [
        "order_id=R4: order_total=85.00 vs quantity*unit_price=80.00 (diff=5.00).",
        "payment_id=M4: settled payment 80.00 != completed order total 85.00 (diff=5.00).",
    ]
    assert tuple(extract["q3_distinct_rules"].first()) == (5, 6)
    q4 = {r.state: (r.completed_revenue, r.completed_orders) for r in extract["q4_revenue_by_state"].collect()}
    assert q4 == {"OH": (Decimal("105.00"), 2), "TX": (Decimal("104.50"), 3), "NY": (Decimal("-12.50"), 1)}
    q5 = {r.cohort: tuple(r)[1:] for r in extract["q5_sentiment_link"].collect()}
    assert q5 == {"has_negative_ticket": (1, 2, 2, 100.0), "no_negative_ticket": (2, 4, 2, 50.0)}
    totals = {r.measure: (r.curated_total, r.raw_total) for r in extract["reconcile_totals"].collect()}
    assert totals == {
        "completed orders": (Decimal("197.00"), Decimal("197.00")), "settled payments": (Decimal("202.50"), Decimal("202.50")),
    }


def test_extract_findings(extract):
    assert {r.question: r.finding for r in extract["findings"].collect()} == {
        "q1": "Total completed revenue is $197.00 across 6 orders. Peak month is 2025-01 with $105.00 from 2 orders.",
        "q2": "Top customer is A1 (Mia Ray, OH) with $110.00 across 2 completed orders.",
        "q3": "5 distinct orders triggered at least one exception. Affected order keys are in q3_order_exceptions.",
        "q4": "Top revenue state is OH with $105.00 from 2 completed orders.",
        "q5": "Among 1 customers with negative support tickets, 100.0% of their orders triggered exceptions, versus 50.0% for "
              "customers without negative tickets.",
    }


def test_a_run_that_fails_leaves_the_tables_before_it(spark, tmp_path, monkeypatch):
    feed, out = tmp_path / "feed", str(tmp_path / "out")
    feed.mkdir()
    for name, text in EXTRACT.items():
        put(feed / SOURCE_FILES[name], text)
    with pytest.raises(FileNotFoundError):
        runs.current(spark, out)
    run(spark, str(feed), out, detected_at=MOMENT)
    first = runs.current(spark, out)
    before = {n: Counter(map(str, df.collect())) for n, df in runs.open_tables(spark, out).items()}
    assert {"fact_order", "dq_exception_report", "q1_revenue_by_month", "findings", "exception_counts"} <= before.keys()

    put(feed / SOURCE_FILES["orders"], EXTRACT["orders"] + "R9,A1,2025-02-06,X1,4,completed,OH,50.00\n")
    with monkeypatch.context() as m:
        m.setattr(batch, "findings", lambda written: written["q2_top_customers"].select(F.raise_error(F.lit("stop"))))
        with pytest.raises(FAILED_READ, match="stop"):
            run(spark, str(feed), out, detected_at=MOMENT)
    assert runs.current(spark, out) == first
    assert before == {n: Counter(map(str, df.collect())) for n, df in runs.open_tables(spark, out).items()}

    run(spark, str(feed), out, detected_at=MOMENT, keep=1)
    after = runs.open_tables(spark, out)
    assert runs.current(spark, out) != first and after["fact_order"].count() == 8
    assert not (tmp_path / "out" / "runs" / first.name).exists() and len(list((tmp_path / "out" / "manifests").glob("*.json"))) == 1


def test_the_report_is_counted_once_for_all_count_tables(job):
    _, _, tables = job
    counts, report = tables["exception_counts"], tables["dq_exception_report"]
    assert counts.agg(F.sum("n")).first()[0] == report.count() == tables["dq_summary"].first().total_exceptions
    assert counts.count() == report.select("dataset", "rule_id", "severity").distinct().count()
