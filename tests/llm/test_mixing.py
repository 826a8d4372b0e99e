"""Targets against an exact version, copies against the rule, and the defined results of odd inputs."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from fractions import Fraction

import pytest
from llm_tables import SMALL, documents  # noqa: F401
from pyspark.sql import functions as F

from tidyledger.llm.mixing import mix, mixed, targets


def exact_targets(sizes: dict, weights=(5, 2, 1), share=Fraction(3, 2), most=2) -> dict:
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, capped = share * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in capped]
        if not free:
            return capped
        rest = left - sum(capped.values())
        level = rest / sum(weight[s] for s in free)
        over = [s for s in free if weight[s] * level > most * sizes[s]]
        if not over:
            return {**capped, **{s: weight[s] * level for s in free}}
        capped.update({s: Fraction(most * sizes[s]) for s in over})


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 10, "b": 10, "c": 10},
        {"a": 1, "b": 1000, "c": 50, "d": 3, "e": 70, None: 5},
        {"": 5, "Z": 5, "a": 5, "é": 5, "\U0001f600": 100, "￮": 7},
        {"a": 0, "b": 9},
        {"a": 0},
        {f"s{i}": (i * 7919) % 1000 + 1 for i in range(200)},
    ],
)
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r.source: r for r in targets(df).collect()}
    want = exact_targets(sizes)
    assert set(got) == set(want)
    for s, t in want.items():
        assert got[s].target == pytest.approx(float(t))
        assert got[s].rate == pytest.approx(float(t) / sizes[s] if sizes[s] else 0.0)


def test_copies_follow_the_rule_on_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = mixed(docs).collect()
    size = {r.doc_id: len(re.findall("[^\x20\x09-\x0d]+", r.text)) for r in docs.collect()}
    sums = Counter()
    for r in rows:
        sums[r.row.source] += size[r.row.doc_id]
    want = exact_targets(dict(sums))
    assert len(rows) == docs.count()
    for r in rows:
        rate = float(want[r.row.source]) / sums[r.row.source]
        draw = int(hashlib.md5(f"mix:{r.row.doc_id}".encode()).hexdigest()[:13], 16) / 2**52
        assert (r.size, r.source_size) == (size[r.row.doc_id], sums[r.row.source])
        assert r.copies == math.floor(rate) + (draw < rate - math.floor(rate)) and r.copies <= 2
    again = mix(docs)
    assert again.columns == docs.columns
    assert Counter(r.doc_id for r in again.collect()) == Counter({r.row.doc_id: r.copies for r in rows if r.copies})


def test_copies_come_near_their_target(spark):
    docs = spark.range(40_000).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 50 + 1).cast("int")).alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 4)).alias("source"),
    )
    got = mixed(docs).groupBy("row.source").agg(F.first("target").alias("t"), F.sum(F.col("size") * F.col("copies")).alias("n"))
    assert all(abs(r.n / r.t - 1) < 0.03 for r in got.collect())


def test_odd_rows(documents):
    docs = documents((1, None, "en", "a"), (2, "", "en", "a"), (3, "x y", "en", None), (3, "x y", "en", None), (None, "z", "en", "b"))
    rows = mixed(docs.withColumn("rate", F.lit(1)).withColumn("target", F.lit(2))).collect()
    assert len(rows) == 5 and {r.size for r in rows if r.row.source == "a"} == {0}
    assert len({r.copies for r in rows if r.row.doc_id == 3}) == 1
    assert mixed(docs.filter("false")).count() == 0 and mix(docs.filter("false")).count() == 0


def test_rows_without_an_id_are_drawn_apart(spark):
    """Their sources come near their targets, and equal texts get equal copies."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").withColumn("doc_id", F.lit(None).cast("bigint"))
    docs = docs.withColumn("source", F.concat(F.lit("s"), F.pmod(F.xxhash64("text"), F.lit(3)).cast("string")))
    rows = mixed(docs).collect()
    assert 1 < len({r.copies for r in rows}) and {r.source_size for r in rows}
    for source in {r.row.source for r in rows}:
        own = [r for r in rows if r.row.source == source]
        assert 0.6 * own[0].target < sum(r.size * r.copies for r in own) < 1.4 * own[0].target
    per_text: dict = {}
    for r in rows:
        per_text.setdefault((r.row.source, r.row.text), set()).add(r.copies)
    assert {len(v) for v in per_text.values()} == {1}


def test_any_column_names(spark):
    names = ["_size", "_copies", "_copy", "_target", "_rate", "_source", "_source_size", "size", "row", "copies", "a.b", "id", "of"]
    docs = spark.createDataFrame([(i, "a b c", "s", *range(len(names))) for i in range(4)], ["doc_id", "text", "source", *names])
    rows = mix(docs)
    assert rows.columns == docs.columns and rows.count() > 0
    assert {tuple(r)[3:] for r in rows.collect()} == {tuple(range(len(names)))}
