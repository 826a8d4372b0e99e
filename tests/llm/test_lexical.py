from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from tidyledger.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text: str | None) -> list[str]:
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(low)


def by_definition(docs, items, k):
    """{(item, text): [(doc_id, score)]}, every document scored for every item."""
    counts = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    counts = [(d, c) for d, c in counts if c]
    n_docs, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    weight = lambda t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
    out = {}
    for item, text in set(items):
        rows = []
        for doc_id, c in counts:
            m = 75 + 25 * sum(c.values()) * n_docs // total
            score = sum(weight(t) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m)) for t in terms(text))
            if score > 0:
                rows.append((-score, doc_id is None, doc_id or 0, doc_id))
        out[item, text] = [(r[3], -r[0]) for r in sorted(rows)[:k]]
    return out


def check(spark, docs, items, k=20, **more):
    found = lexical.ranked(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"), k, **more
    ).collect()
    want = by_definition(docs, items, k)
    by_item: dict = {}
    for (item, _), rows in want.items():
        by_item.setdefault(item, []).extend((i + 1, *r) for i, r in enumerate(rows))
    got: dict = {}
    for r in found:
        got.setdefault(r.item_id, []).append((r["rank"], r.doc_id, r.score))
    order = lambda d: {i: sorted(rows, key=str) for i, rows in d.items() if rows}
    assert order(got) == order(by_item)
    return found


def corpus(n: int, seed: int = 3):
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.7)) % 200}" for _ in range(4000)]
    return [(i, " ".join(rng.choices(words, k=rng.choice([0, 1, 5, 40, 400])))) for i in range(n)]


@pytest.mark.parametrize(("bucket", "slab"), [(4096, 1 << 22), (7, 300)])
def test_equals_every_score(spark, monkeypatch, bucket, slab):
    """Small buckets and slabs: most queries are pruned or met in parts."""
    monkeypatch.setattr(lexical, "BUCKET", bucket)
    monkeypatch.setattr(lexical, "SLAB", slab)
    docs = corpus(300)
    items = [(i, " ".join(random.Random(i).choices([f"w{j}" for j in range(220)], k=i % 17 + 1))) for i in range(40)]
    check(spark, docs, items, k=5)


def test_odd_rows(spark):
    docs = [
        (1, "Alpha beta"), (2, "alpha BETA"), (2, "alpha beta"), (None, "alpha beta"), (3, None), (4, ""), (5, " .,; "),
        (6, "ÄRGER straße 日本語 x1y2"), (7, "alpha " * 5000), (8, "gamma\x00delta_epsilon"), (9, "İ K"),
    ]
    items = [
        (1, "alpha"), (1, "alpha"), (2, "beta beta alpha"), (2, "gamma"), (3, None), (4, "..."), (5, "nowhere"), (6, "ÄRGER 日本語"),
        (7, "delta epsilon X1Y2"), (None, "beta"), (8, "ärger"), (9, "İ"),
    ]
    found = check(spark, docs, items)
    assert {r.item_id for r in found} == {1, 2, 6, 7, 9, None}  # only A-Z is lowered
    check(spark, docs, items, k=2)


def test_ties_go_to_the_smaller_id(spark):
    docs = [(i, "same words here") for i in (9, 4, 30, 2, 11)] + [(1, "other")]
    found = check(spark, docs, [(1, "same")], k=3)
    assert [r.doc_id for r in sorted(found, key=lambda r: r["rank"])] == [2, 4, 9]


def test_blocks_of_queries(spark):
    docs, items = corpus(60), [(i, f"w{i} w{i + 1} w1") for i in range(12)]
    check(spark, docs, items, k=4, block_terms=5)


def test_empty_tables_and_names(spark):
    docs = spark.createDataFrame([(1, "one two", "x")], "`the.id` int, body string, rank string")
    items = spark.createDataFrame([("q", "two", 1)], "`item.id` string, words string, score int")
    names = {"id_col": "the.id", "text_col": "body", "item_col": "item.id", "item_text_col": "words"}
    row = lexical.ranked(docs, items, **names).collect()
    assert [(r.item_id, r["rank"], r.doc_id) for r in row] == [("q", 1, 1)]
    assert lexical.ranked(docs.limit(0), items, **names).collect() == []
    assert lexical.ranked(docs, items.limit(0), **names).collect() == []


def test_sizes_beyond_64_bits():
    import numpy as np

    n = np.array([10**9, 3])
    assert lexical._spread(n, 10**12, 10**15).tolist() == [75 + 25 * 10**21 // 10**15, 75]
