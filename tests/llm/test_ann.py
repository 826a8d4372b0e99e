"""Recall and exact scores against brute force, and the defined results of odd inputs."""

from __future__ import annotations

import numpy as np
import pytest
from llm_tables import SMALL

from tidyledger.llm import ann
from tidyledger.llm.ann import neighbours


def brute(ids, x, query, k):
    keep = [i for i in range(len(ids)) if ids[i] != ids[query]]
    far = {ids[i]: float(np.sqrt(((x[i] - x[query]) ** 2).sum())) for i in keep}
    return sorted(far.items(), key=lambda p: (p[1], p[0]))[:k]


def table(spark, ids, x):
    return spark.createDataFrame([(int(i), [float(c) for c in v]) for i, v in zip(ids, x, strict=True)], "vec_id bigint, embedding array<float>")


def recall(got, want):
    return sum(len({v for v, _ in w} & {v for v, _ in got.get(q, [])}) for q, w in want.items()) / sum(len(w) for w in want.values())


def results(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_on_embeddings(spark, sf):
    rows = spark.read.parquet(f"{SMALL}/../{sf}/embeddings.parquet")
    local = rows.collect()
    ids, x = [r.vec_id for r in local], np.array([r.embedding for r in local], np.float32).astype(float)
    got = results(neighbours(rows, rows.filter("vec_id % 100 = 0")))
    want = {ids[i]: brute(ids, x, i, 10) for i in range(len(ids)) if ids[i] % 100 == 0}
    assert recall(got, want) >= 0.9
    exact = {(ids[i], ids[j]): float(np.sqrt(((x[j] - x[i]) ** 2).sum())) for i in range(len(ids)) if ids[i] in want for j in range(len(ids))}
    assert all(s == pytest.approx(exact[q, v], abs=1e-12) and q != v for q, found in got.items() for v, s in found)
    assert all(len(found) == 10 and found == sorted(found, key=lambda p: (p[1], p[0])) for found in got.values())


def test_recall_with_clusters_and_many_blocks(spark):
    rng = np.random.default_rng(3)
    x = np.r_[rng.normal(size=(600, 24)), rng.normal(size=(1, 24)) + 0.05 * rng.normal(size=(300, 24))].astype(np.float32)
    rows = table(spark, range(900), x)
    got = results(neighbours(rows.repartition(5), rows.filter("vec_id % 100 = 0"), block_bytes=3 * 24 * 8))
    want = {i: brute(list(range(900)), x.astype(float), i, 10) for i in range(0, 900, 100)}
    assert recall(got, want) >= 0.9


def test_ties_repeats_and_few_rows(spark):
    rows = table(spark, [100, 5, 4, 3, 3, 100], [[1, 0], [1, 0.5], [1, 0.5], [1, 0.5], [1, 0.5], [1, 0]])
    got = neighbours(rows, rows.filter("vec_id = 100"), probes=4)
    assert [(r.rank, r.vec_id, r.score) for r in got.orderBy("rank").collect()] == [(1, 3, 0.5), (2, 4, 0.5), (3, 5, 0.5)]


@pytest.mark.parametrize("n", [0, 1, 2, 8, 12])
def test_few_rows_of_64_dimensions_are_all_found(spark, n):
    x = np.random.default_rng(n).normal(size=(n, 64)).astype(np.float32)
    rows = table(spark, range(n), x)
    longer = table(spark, range(100, 140), np.random.default_rng(99).normal(size=(40, 80)))
    want = {i: [(v, pytest.approx(s, abs=1e-12)) for v, s in brute(list(range(n)), x.astype(float), i, 10)] for i in range(n)}
    assert results(neighbours(rows.unionAll(longer), rows)) == {i: w for i, w in want.items() if w}


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0, 2.0, 3.0]), (None, [1.0, 2.0]), (8, [2.0, 4.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").selectExpr("*", "1 as score", "2 as v", "3 as rank")
    got = neighbours(df, df.filter("vec_id in (0, 1, 2, 3, 4, 5, 6, 7) or vec_id is null"), probes=4)
    assert [tuple(r) for r in got.collect()] == [(0, 1, 8, pytest.approx(5**0.5))]
    assert neighbours(df.filter("false"), df).count() == 0 and neighbours(df, df.filter("false")).count() == 0


def test_hadamard_is_a_rotation():
    x = np.random.default_rng(0).normal(size=(5, 16))
    y = ann.hadamard(x)
    assert np.allclose(np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)) and np.allclose(ann.hadamard(y), x)
