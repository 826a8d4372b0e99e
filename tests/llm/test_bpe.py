from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
import regex
import tiktoken

from tidyledger.llm import bpe
from tidyledger.llm.queries import op12_byte_bpe

RANKS = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def one_at_a_time(raw: bytes, ranks: dict[bytes, int]) -> list[int]:
    """By definition: the leftmost pair of minimum rank, one contraction after the other."""
    parts = [raw[i : i + 1] for i in range(len(raw))]
    while True:
        pairs = [(ranks[parts[i] + parts[i + 1]], i) for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in ranks]
        if not pairs:
            return [ranks[p] for p in parts]
        _, i = min(pairs)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def ids_of(row) -> list[int]:
    return [int.from_bytes(row.ids[i : i + 4], "little") for i in range(0, len(row.ids), 4)]


def round_trip(df, ranks=RANKS, **more):
    return bpe.decode(bpe.encode(df, ranks, public_tokenizers.PATTERN, **more), ranks)


TEXTS = [
    None, "", " ", "\n\n  \t x", "it's 'tis we'll I'd''s", "Hello, wörld! 12 345  ", "<|endoftext|> <s>", "\x00\x1f\x7f",
    "日本語のテキスト、句読点なし" * 40, "🙂👩‍👩‍👧 é​", "a" * 3000, " " * 2500, "ab" * 900, " 　 x y",
]


def test_odd_texts_equal_the_library(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (1, "twice"), (1, "twice")]
    found = round_trip(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: r for r in found if r.doc_id != 1}
    for i, text in rows:
        if i != 1:
            assert ids_of(by_id[i]) == LIBRARY.encode_ordinary(text or ""), text
            assert by_id[i].decoded == (text or "").encode() and by_id[i].n_tokens == len(ids_of(by_id[i]))


def test_whole_table_equals_the_library(spark):
    sf_dir = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = op12_byte_bpe(spark, sf_dir).collect()
    assert len(got) == len(texts)
    for row in got:
        ids = LIBRARY.encode_ordinary(texts[row.doc_id])
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        assert (row.n_tokens, row.ids_sha256) == (len(ids), hashlib.sha256(packed).hexdigest())
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()


@pytest.mark.parametrize("long", [0, bpe.LONG])
def test_contraction_by_definition_for_any_ranks(long):
    """Vocabularies whose merges reach back: a new pair may have a lower rank than the one that made it."""
    rng = random.Random(5)
    for _ in range(25):
        tokens = {bytes([b]) for b in range(256)}
        for _ in range(60):
            tokens.add(b"".join(rng.choices([t for t in tokens if set(t) <= set(b"abc")], k=2))[:9])
        order = sorted(tokens, key=lambda t: (len(t) > 1, rng.random()))
        ranks = {t: i for i, t in enumerate(order)}
        words = ["".join(rng.choices("abc", k=rng.randint(1, 40))) for _ in range(30)] + ["a" * 33, "abab" * 9, "b" * 64, "ac" * 32]
        words = [w for w in words if w.encode() not in ranks]
        words = list(dict.fromkeys(words))
        encoder = bpe.Encoder(ranks, bpe.merge_table(ranks), [{}, {}], 1000)
        encoder.long = long  # which of the two queries
        for w, ids in zip(words, encoder.encode(words)):
            assert [int.from_bytes(ids[i : i + 4], "little") for i in range(0, len(ids), 4)] == one_at_a_time(w.encode(), ranks), w


def test_a_worker_that_forgets_gives_the_same(spark):
    df = spark.createDataFrame([(i, f"some words {i} and more of {i * i}") for i in range(50)], "doc_id bigint, text string")
    told = lambda d: {(r.doc_id, bytes(r.ids)) for r in d.collect()}
    assert told(round_trip(df)) == told(round_trip(df, words=3))


def test_texts_and_tokens_in_steps(monkeypatch):
    monkeypatch.setattr(bpe, "CHARS", 50)
    monkeypatch.setattr(bpe, "PIECES", 7)
    monkeypatch.setattr(bpe, "TOKENS", 11)
    encoder = bpe.Encoder(RANKS, bpe.merge_table(RANKS), [{}, {}], 20)
    texts = ["a b", "", "many words " * 40, "and so on " * 3, "x" * 400, ""]
    found = list(bpe._encoded(encoder, regex.compile(public_tokenizers.PATTERN), texts))
    assert [len(f) // 4 for f in found] == [len(LIBRARY.encode_ordinary(t)) for t in texts]
    assert found == [b"".join(i.to_bytes(4, "little") for i in LIBRARY.encode_ordinary(t)) for t in texts]


def test_names_empty_tables_and_wrong_ids(spark):
    df = spark.createDataFrame([("x", "one two", 1)], "`my.id` string, `a text` string, ids int")
    row = round_trip(df, id_col="my.id", text_col="a text").first()
    assert (row.doc_id, row.decoded) == ("x", b"one two")
    assert round_trip(df.limit(0), id_col="my.id", text_col="a text").count() == 0
    wrong = spark.createDataFrame([(1, 1, bytearray(b"\xff\xff\xff\x00"))], "doc_id bigint, n_tokens bigint, ids binary")
    with pytest.raises(Exception, match="not in the vocabulary"):
        bpe.decode(wrong, RANKS).collect()
    none = spark.createDataFrame([(1, 0, None)], "doc_id bigint, n_tokens bigint, ids binary")
    assert bpe.decode(none, RANKS).first().decoded == b""
