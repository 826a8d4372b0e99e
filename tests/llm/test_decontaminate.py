"""Containment search against all pairs, and the defined results of odd inputs."""

from __future__ import annotations

from llm_tables import SMALL, documents  # noqa: F401

from tidyledger.llm.decontaminate import clean, leaks, shingle_set


def brute(docs, items):
    out = []
    for d, text in docs:
        have = shingle_set(text)
        for i, item in items:
            want = shingle_set(item)
            both = len(want & have)
            if want and 100 * both >= 80 * len(want):
                out.append((d, i, len(want), both))
    return sorted(out, key=str)


def found(docs, items, **options):
    return sorted((tuple(r) for r in leaks(docs, items, **options).collect()), key=str)


def items_of(spark, *rows):
    return spark.createDataFrame(list(rows), "item_id bigint, text string")


def test_equals_all_pairs_on_the_tables(spark):
    docs, items = spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/benchmark.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert want
    assert found(docs, items) == want
    assert found(docs, items, block_bytes=500) == want  # many blocks


def test_part_of_an_item_inside_a_long_document(spark, documents):
    words = [f"w{i}" for i in range(44)]  # 40 shingles
    filler = [f"f{i}" for i in range(60_000)]
    rows = [
        (1, " ".join(filler[:30_000] + words + filler[30_000:])),  # whole
        (2, " ".join(filler[:9] + words[:36] + filler[9:50])),  # 32 of 40
        (3, " ".join(filler[:9] + words[:35] + filler[9:50])),  # 31 of 40
        (4, " ".join(words[22:] + filler[:30] + words[:22])),  # 36 of 40, in two parts
        (5, " ".join(words).upper()),
    ]
    got = found(documents(*rows), items_of(spark, (7, " ".join(words))))
    assert got == brute(rows, [(7, " ".join(words))])
    assert [r[0] for r in got] == [1, 2, 4, 5]


def test_odd_rows(spark, documents):
    docs = [(1, None), (2, ""), (3, "One two"), (4, "one two three"), (None, "a b c d e f"), (5, "a b c d e f"), (5, "a b c d e f")]
    items = [(1, None), (2, ""), (3, "one TWO"), (4, "a b c d e f"), (4, "a b c d e f"), (None, "a b c d e"), (6, " ")]
    assert found(documents(*docs), items_of(spark, *items)) == brute(docs, items)


def test_empty_tables_and_clashing_columns(spark, documents):
    docs, items = documents((1, "a b c d e")), items_of(spark, (2, "a b c d e"))
    assert found(docs.filter("false"), items) == [] and found(docs, items.filter("false")) == []
    wide = docs.selectExpr("*", "1 as item_id", "2 as n_item", "3 as n_shared")
    assert found(wide, items.selectExpr("*", "9 as doc_id")) == [(1, 2, 1, 1)]


def test_clean_keeps_the_rest_as_it_is(spark, documents):
    docs = documents((1, "a b c d e"), (2, "x"), (2, "x"), (None, "a b c d e"), (3, None))
    assert sorted(clean(docs, items_of(spark, (2, "a b c d e"))).collect(), key=str) == sorted(docs.filter("not doc_id <=> 1").collect(), key=str)
