"""The table against its definition, placement, balance and what moves when shards come and go."""

from __future__ import annotations

import hashlib
from collections import Counter

import pytest
from llm_tables import SMALL, documents  # noqa: F401

from tidyledger.llm.sharding import SHARDS, SLOTS, fill, shard, shard_names, write_shards


def naive_fill(names, slots):
    """Every shard's whole preference list, walked from its start at every turn."""
    h = lambda part, n: int(hashlib.md5(f"{part}:{n}".encode()).hexdigest()[:13], 16)
    lists = [[(h("offset", n) + j * (h("skip", n) % (slots - 1) + 1)) % slots for j in range(slots)] for n in names]
    owner: dict[int, int] = {}
    turn = 0
    while len(owner) < slots:
        owner[next(s for s in lists[turn % len(names)] if s not in owner)] = turn % len(names)
        turn += 1
    return [owner[i] for i in range(slots)]


@pytest.mark.parametrize(("shards", "slots"), [(1, 2), (3, 7), (5, 101), (64, 641)])
def test_table(shards, slots):
    assert fill(shard_names(shards), slots) == naive_fill(shard_names(shards), slots)


def test_table_is_even_and_stable():
    before = fill(shard_names(SHARDS), SLOTS)
    counts = Counter(before)
    assert max(counts.values()) - min(counts.values()) <= 1
    after = fill(shard_names(SHARDS - 1), SLOTS)
    moved = sum(a != b for a, b in zip(before, after, strict=True) if a != SHARDS - 1)
    assert moved < SLOTS * 0.1


@pytest.mark.parametrize(("shards", "slots"), [(0, 7), (3, 8), (9, 7), (1, 1)])
def test_bad_sizes(shards, slots):
    with pytest.raises(ValueError):
        fill(shard_names(shards), slots)


def test_placement_on_documents(spark):
    owner = naive_fill(shard_names(SHARDS), SLOTS)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = shard(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        slot = int(hashlib.md5(str(r.doc_id).encode()).hexdigest()[:13], 16) % SLOTS
        assert (r.slot, r.shard) == (slot, owner[slot])


def test_odd_rows(documents):
    docs = documents((1, None), (1, "x"), (None, "a"), (None, "b"), (None, None), (None, ""))
    wide = docs.selectExpr("*", "7 as slot", "8 as shard", "9 as _x")
    rows = shard(wide).collect()
    assert len(rows) == 6 and all(0 <= r.shard < SHARDS for r in rows)
    assert len({r.slot for r in rows if r.doc_id == 1}) == 1
    assert len({r.slot for r in rows if r.doc_id is None}) == 4
    assert shard(docs.filter("false")).count() == 0


def test_main_path_is_native(documents):
    plan = shard(documents((1, "x")))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_written_shards_hold_every_row_once(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    write_shards(docs, str(tmp_path / "out"), files_per_shard=2)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.doc_id for r in back.collect()) == sorted(r.doc_id for r in docs.collect())


def test_any_column_names(spark):
    docs = spark.createDataFrame([(i, "t", 1, 2, 3, 4) for i in range(50)], ["doc_id", "text", "_slot", "_shard", "a.b", "row"])
    rows = shard(docs)
    assert rows.columns == [*docs.columns, "slot", "shard"] and {tuple(r)[2:6] for r in rows.collect()} == {(1, 2, 3, 4)}
    plain = {r.doc_id: r.shard for r in shard(docs.select("doc_id", "text")).collect()}
    assert {r.doc_id: r.shard for r in rows.collect()} == plain
