"""Near duplicates against a brute-force version, and the defined results of odd inputs."""

from __future__ import annotations

import random
from itertools import combinations

import pytest
from llm_tables import SMALL, documents  # noqa: F401

from tidyledger.llm.components import components
from tidyledger.llm.decontaminate import shingle_set
from tidyledger.llm.ngram_join import near_duplicates


def brute(texts: list[tuple[int | None, str | None]]) -> list[tuple]:
    sets = [frozenset(shingle_set(t)) for _, t in texts]
    label = list(range(len(texts)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, j in combinations(range(len(texts)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
            label[max(find(i), find(j))] = min(find(i), find(j))
    smallest: dict[int, int | None] = {}
    for i, (doc_id, _) in enumerate(texts):
        known = [x for x in (smallest.get(find(i)), doc_id) if x is not None]
        smallest[find(i)] = min(known, default=None)
    return sorted(
        ((d, len(s), smallest[find(i)] if s else d) for i, ((d, _), s) in enumerate(zip(texts, sets, strict=True))), key=str
    )


def found(df) -> list[tuple]:
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in near_duplicates(df).collect()), key=str)


def edited(rng: random.Random, words: list[str], edits: int) -> str:
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def corpus() -> list[tuple[int, str]]:
    """Families around the threshold, sizes around the sketch's, a passage that many texts share, and chains."""
    rng = random.Random(5)
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    texts: list[str] = []
    for size in (5, 6, 9, 30, 50, 55, 60, 66, 70, 80, 90, 150, 400):
        base = fresh(size)
        texts += [edited(rng, base, e) for e in (0, 0, 1, 1, 2, 3, 4, 6)]
    passage = fresh(60)
    texts += [" ".join(passage + fresh(rng.choice([3, 8, 12, 14, 16, 40, 200]))) for _ in range(120)]
    texts += [" ".join(fresh(rng.choice([4, 10])) + passage) for _ in range(60)]
    chain = fresh(100)
    for i in range(40):  # each linked with the next, the ends with nothing in common
        chain[2 * i : 2 * i + 2] = fresh(2)
        texts.append(" ".join(chain))
    rng.shuffle(texts)
    return list(enumerate(texts, 10))


def test_equals_brute_force(documents, corpus):
    assert found(documents(*corpus)) == brute(corpus)


def test_odd_rows(documents):
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "Two words"), (5, "two\x0bWORDS"), (6, "two words more"), (7, "x " * 50_000),
        (8, "x x x x x"), (None, "two words"), (None, None), (9, "a b c d e f"), (9, "a b c d e f"), (12, "É a b c d"),
        (11, "é a b c d"),
    ]
    assert found(documents(*rows)) == brute(rows)


def test_a_group_without_any_id(documents):
    assert found(documents((None, "a b c d e f"), (None, "a b c d e f"))) == [(None, 2, None)] * 2


def test_empty_table_and_clashing_columns(documents, spark):
    assert found(documents((1, "a")).filter("false")) == []
    df = documents((1, "a b c d e"), (2, "a b c d e")).selectExpr("*", "1 as n_shingles", "2 as set_id", "3 as low", "4 as id", "5 as component_id")
    assert found(df) == [(1, 1, 1), (2, 1, 1)]


def test_equals_brute_force_on_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert found(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(20, 90)] + [(3, 3), (None, 3), (1, 2), (2, 1), (1, 2)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 7 for i in (7, *range(20, 90))}, 1: 1, 2: 1}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_partial_overlaps_sum_over_all_fragments(documents):
    """Large sets are decided by the sum over fragments, whatever each fragment holds."""
    base = [f"v{i}" for i in range(3000)]
    near, far = list(base), list(base)
    for i in range(0, 3000, 50):  # 60 edits: about 300 of 2,996 shingles differ
        near[i] = f"x{i}"
    for i in range(0, 3000, 30):  # 100 edits: similarity 0.71
        far[i] = f"y{i}"
    rows = [(1, " ".join(base)), (2, " ".join(near)), (3, " ".join(far))]
    assert found(documents(*rows)) == brute(rows) == [(1, 2996, 1), (2, 2996, 1), (3, 2996, 3)]
