"""Every registered query against its DuckDB statement on the small tables."""

from __future__ import annotations

import pytest
from compare import connect, differences
from conftest import SMALL

import __spark_entry__ as driver

OPTIONAL = driver._training_data_queries()
QUERIES = {name: query for name, query in driver.queries().items() if name not in OPTIONAL}
STATEMENTS = driver.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = connect(SMALL)
    yield con
    con.close()


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(STATEMENTS) - set(OPTIONAL)


# Queries whose result must not be empty on the feeds, so that an empty answer cannot pass for a right one.
NEVER_EMPTY = set(QUERIES) - {"dq_exceptions_filtered"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_statement(spark, duck, name):
    got = QUERIES[name](spark, SMALL)
    assert differences(got, duck, STATEMENTS[name]) == []
    assert name not in NEVER_EMPTY or not got.isEmpty()


def test_entry(spark):
    rows = driver.entry(spark).collect()
    assert rows and set(rows[0].asDict()) == {"month", "completed_revenue", "completed_orders"}


def test_finding_of_question_3_says_the_same_at_every_size(spark):
    from pyspark.sql import functions as F

    from tidyledger.plans import answers

    q3 = spark.range(5000).select(F.concat(F.lit("O"), "id").alias("order_key"))
    text = "{} distinct orders triggered at least one exception. Affected order keys are in q3_order_exceptions."
    assert answers.finding_q3(q3).first()[0] == text.format(5000)
    assert answers.finding_q3(q3.limit(1)).first()[0] == text.format(1)
    empty = q3.filter(F.lit(False))
    assert answers.finding_q3(empty).first()[0] == "No orders triggered data-quality or reconciliation exceptions."


def test_findings_on_empty_results(spark):
    from tidyledger.plans import answers

    q1 = spark.createDataFrame([], "month date, completed_revenue decimal(22,2), completed_orders bigint")
    q2 = spark.createDataFrame(
        [], "customer_key string, full_name string, standard_state string, completed_value decimal(22,2), completed_orders bigint"
    )
    q4 = spark.createDataFrame([], "state string, completed_revenue decimal(22,2), completed_orders bigint")
    q5 = spark.createDataFrame([], "cohort string, customer_count bigint, pct_orders_with_exception double")
    assert answers.finding_q1(q1).first()[0] == "No completed orders with valid order dates were found."
    assert answers.finding_q2(q2).first()[0] == "No completed orders linked to valid customers were found."
    assert answers.finding_q4(q4).first()[0] == "No completed orders with a standardized shipping state were found."
    assert answers.finding_q5(q5).first()[0] == "No customer cohort comparison could be computed."
