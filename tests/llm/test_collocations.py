from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from tidyledger.llm import automata, collocations


def by_definition(rows, least, top=2000, share=100):
    """[(lang, rank, phrase, a, l, r, n, score)]"""
    f: dict[str, Counter] = {}
    total = Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, 6):
                f.setdefault(lang, Counter()).update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, count in f.items():
        often = [p for p in count if len(p) >= 2 and count[p] >= least]
        inside = {
            p[i : i + k] for p in often for k in range(2, len(p)) for i in range(len(p) - k + 1) if 100 * count[p] >= share * count[p[i : i + k]]
        }
        listed = []
        for p in often:
            if p not in inside:
                a, n = count[p], total[lang]
                score, k = min((1000 * a * n // (count[p[:k]] * count[p[k:]]), k) for k in range(1, len(p)))
                listed.append((-score, -a, " ".join(p).encode(), p, a, count[p[:k]], count[p[k:]], n, score))
        for rank, (*_, p, a, left, right, n, score) in enumerate(sorted(listed)[:top], 1):
            out.append((lang, rank, " ".join(p), a, left, right, n, score))
    return sorted(out)


def check(spark, rows, least, top=2000, share=100, **more):
    df = spark.createDataFrame(rows, "lang string, text string")
    got = sorted(tuple(r) for r in collocations.collocations(df, least, top, share, **more).collect())
    assert got == by_definition(rows, least, top, share)
    return got


def corpus(n: int, seed: int = 11):
    rng = random.Random(seed)
    words = ["the", "of", "New", "york", "times", "a", "é", "日本", "x", "y"] + [f"w{i}" for i in range(60)]
    marks = [" "] * 12 + [", ", ". ", "\n", "\t", "  ", "!?"]
    fixed = ["new york times square", "once upon a time there", "é 日本 é 日本 é", "a a a a a a a"]
    rows = []
    for _ in range(n):
        parts = [rng.choice(fixed) if rng.random() < 0.1 else rng.choice(words) for _ in range(rng.choice([0, 1, 3, 30, 90]))]
        rows.append((rng.choice(["en", "en", "en", "de", None, "und", ""]), "".join(p + rng.choice(marks) for p in parts)))
    return rows


@pytest.mark.parametrize("share", [100, 60])
def test_equals_the_definition(spark, share):
    got = check(spark, corpus(250), 4, share=share)
    assert {r[0] for r in got} == {"en", "de", "und", ""} and max(len(r[2].split()) for r in got) == 5


def test_many_ranges_shards_and_copies(spark, monkeypatch):
    """Everything in small steps: ranges of a few n-grams, shards written early, transducers copied, a full filter."""
    monkeypatch.setattr(collocations, "RANGE", 20)
    monkeypatch.setattr(collocations, "HELD", 300)
    monkeypatch.setattr(collocations, "GATHERED", 500)
    monkeypatch.setattr(collocations, "FILTER_BITS", 1 << 13)
    monkeypatch.setattr(automata, "FAN", 3)
    check(spark, corpus(200), 3, shard_size=100, asked_size=50)


def test_top_and_ties(spark):
    rows = [("en", "b c. c d. a b. d e")] * 4
    got = check(spark, rows, 4, top=3)
    assert [r[2] for r in got] == ["a b", "d e", "b c"]


def test_odd_rows(spark):
    check(spark, [("en", None), (None, None), ("de", ""), ("en", " .,\t\n "), ("en", "one two"), ("en", "ONE\ttwo"), ("en", "one. two")], 2)
    check(spark, [("en", "a a a a a a"), ("en", "x" * 5000 + " y")] * 3, 2)
    check(spark, [("en", "word " * 20_000)] * 2, 100)
    assert check(spark, [("en", "nothing is repeated here")], 2) == []


def test_empty_table_and_names(spark):
    df = spark.createDataFrame([("en", "a b", 1)] * 3, "`l.g` string, body string, rank int")
    got = collocations.collocations(df, 3, text_col="body", lang_col="l.g").collect()
    assert [tuple(r) for r in got] == [("en", 1, "a b", 3, 3, 3, 6, 2000)]
    assert collocations.collocations(df.limit(0), 3, text_col="body", lang_col="l.g").collect() == []


def test_products_beyond_64_bits(spark):
    answers = spark.createDataFrame(
        [("en", "a b", 3 * 10**12, 2, 1, "l", 4 * 10**12), ("en", "a b", 3 * 10**12, 2, 1, "r", 5 * 10**12)],
        "lang string, phrase string, a bigint, words int, cut int, side string, f bigint",
    )
    totals = spark.createDataFrame([("en", 7 * 10**15)], "lang string, n bigint")
    row = collocations._lowest(answers, totals).first()
    assert row.score == 1000 * 3 * 10**12 * 7 * 10**15 // (4 * 10**12 * 5 * 10**12) and (row.l, row.r) == (4 * 10**12, 5 * 10**12)


def test_automata():
    rng = random.Random(2)
    parts = []
    for _ in range(9):
        paths = {tuple(rng.choices("abcd", k=rng.randint(1, 5))): rng.randint(1, 9) for _ in range(60)}
        parts.append(paths)
    total = Counter()
    for p in parts:
        total.update(p)
    whole = automata.Sum()
    for p in parts:
        whole.add(automata.build(sorted(p.items())))
    assert dict(whole.paths()) == dict(total) and [p for p, _ in whole.paths()] == sorted(total)
    built = automata.build(whole.paths())
    asked = sorted([*total, ("z",), ("a",) * 9, ("a", "z"), ("d", "d", "d", "d", "d", "d")])
    assert list(built.weights_of(asked)) == [total[p] for p in asked]
    shared = automata.build([(("a", "x", "y"), 1), (("b", "x", "y"), 1)])
    assert len(shared.weights) == 4  # the common end is stored once
    table = [c[0].as_py() for c in built.columns()]
    assert dict(automata.Automaton.read(*table).paths()) == dict(total)
