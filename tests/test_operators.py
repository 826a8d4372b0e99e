"""Duplicates, lookups and repeated rows against plain-Python answers, including hot groups and splits."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidyledger.operators.dedup import exact_dropped, exact_kept, key_losers, key_winners, mark_soft_duplicates
from tidyledger.operators.lookups import known_keys, lookup
from tidyledger.operators.rows import first_per_group, repeat_rows


def random_rows(seed: int, n: int = 400):
    """A third of the rows share one key, some keys are NULL, contents repeat."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rng.random() < 0.33 else rng.choice(["a", "b", None, f"k{rng.randrange(80)}"])
        rows.append((key, rng.choice(["x", "y", None]), i * 3))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("parts", [1, 7])
def test_duplicates(spark, seed, parts):
    data = random_rows(seed)
    df = spark.createDataFrame(data, "k string, v string, source_row bigint").repartition(parts)

    first_content, first_key = {}, {}
    for k, v, i in data:
        first_content.setdefault((k, v), i)
        first_key.setdefault(k, i)
    kept = {r for r in data if first_content[r[:2]] == r[2]}
    winners = {r for r in data if first_key[r[0]] == r[2]}
    assert {tuple(r) for r in exact_kept(df).collect()} == kept
    assert {tuple(r) for r in exact_dropped(df).collect()} == set(data) - kept
    assert {tuple(r) for r in key_winners(df, ["k"]).collect()} == winners
    assert {tuple(r) for r in key_losers(df, ["k"]).collect()} == set(data) - winners

    flags = {r.source_row: r.duplicate_resolution_flag for r in mark_soft_duplicates(df, ["k", "v"]).collect()}
    assert flags == {i: k is not None and v is not None and first_content[(k, v)] != i for k, v, i in data}


def test_soft_duplicates_on_another_row_id(spark):
    data = [("a", "x", 3, "r3"), ("a", "x", 1, "r1"), ("a", None, 2, "r2"), ("b", "x", 4, "r4")]
    df = spark.createDataFrame(data, "k string, v string, source_row bigint, id string")
    got = mark_soft_duplicates(df, ["k", "v"], row_id="id").collect()
    assert {r.id: r.duplicate_resolution_flag for r in got} == {"r1": False, "r2": False, "r3": True, "r4": False}


def test_composite_key_winners_keep_columns_in_order(spark):
    df = spark.createDataFrame([("a", 1, "p", 9), ("a", 1, "q", 2), ("a", 2, "r", 5)], "k string, n int, v string, source_row bigint")
    got = key_winners(df, ["k", "n"])
    assert got.columns == df.columns
    assert sorted(tuple(r) for r in got.collect()) == [("a", 1, "q", 2), ("a", 2, "r", 5)]


def test_lookup_has_one_row_per_known_key(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("b", 4)], "k string, n int")
    assert sorted(tuple(r) for r in lookup(df, "k", F.max("n").alias("n")).collect()) == [("a", 2), ("b", 4)]
    assert sorted(tuple(r) for r in known_keys(df, "k", "known").collect()) == [("a", True), ("b", True)]


def test_repeat_rows(spark):
    df = spark.createDataFrame([("a", 1), ("b", 0), ("c", 7), (None, 3), ("d", 10)], "k string, times bigint")
    for chunk in (1, 3, 5, 1000):
        got = repeat_rows(df, "times", chunk).groupBy("k").count().collect()
        assert {r.k: r["count"] for r in got} == {"a": 1, "c": 7, None: 3, "d": 10}


def test_a_large_count_is_written_by_many_tasks(spark):
    df = spark.createDataFrame([("hot", 80_000)], "k string, times bigint")
    rows = repeat_rows(df, "times", chunk=1000).withColumn("task", F.spark_partition_id())
    sizes = [r["count"] for r in rows.groupBy("task").count().collect()]
    assert sum(sizes) == 80_000 and len(sizes) >= 4 and max(sizes) <= 40_000


def test_first_per_group(spark):
    df = spark.createDataFrame([("a", i) for i in range(50)] + [("b", 1)], "g string, n int")
    got = first_per_group(df, "g", [F.desc("n")], 3, "rank").collect()
    assert sorted(tuple(r) for r in got) == [("a", 47, 3), ("a", 48, 2), ("a", 49, 1), ("b", 1, 1)]
