"""Byte-level BPE encoding and decoding with DuckDB inside the tasks.

A vocabulary is a map from byte strings to ranks, read from a file of rank lines whose path is a parameter. Texts are cut
into pieces by the vocabulary's pattern. A piece that is itself a token is that token; any other starts as one row per byte,
(word, position, token), and a recursive query joins the rows with the merge table: every round contracts the leftmost
pair of minimum rank in each word, until no pair of a word is in the table. Pieces of more than LONG bytes go
through a second query that contracts, in one round, all pairs of the minimum rank from the left up to the first one after
which a lower rank appears; so a run of 10,000 equal letters takes a few rounds. Both give what contracting one pair at a
time gives.

Each distinct piece is encoded once as long as a Python worker remembers it (the last WORDS pieces used, at least); the
memory is a pure lookup, and forgetting it changes no result. A task holds one Arrow batch, a chunk of about half a megabyte and its pieces; a
longer text is cut into pieces in steps.

Decoding lists the tokens of (text, position, token) by an ordered aggregate and picks their bytes from the vocabulary.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain, islice

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pieces a Python worker remembers before it forgets those it has not met since it last forgot any.
WORDS = 3 << 17
#: Bits that hold a position in a short piece, packed beside a word's number; a piece of more bytes is contracted rank by rank.
BITS = 6
LONG = 1 << BITS
#: Characters of one text that are cut into pieces at once; pieces of one encoding round; tokens decoded at once.
CHARS, PIECES, TOKENS = 1 << 20, 1 << 17, 1 << 20
#: Both queries give (w, ids): the tokens of each word in order.
_ORDERED = "list(id ORDER BY {place}) AS ids FROM step WHERE id >= 0 GROUP BY w ORDER BY w"

#: A row is a token: key (word * LONG + position of its first byte), id, key of the token after it or -1. A token that was
#: eaten by its left neighbour has id -1. One pair of a word is contracted a round: that of the least rank, then position.
_ONE = f"""
WITH RECURSIVE step(k, id, n) USING KEY (k) AS (
  SELECT k, id, n FROM start
  UNION ALL (
  WITH pair AS (SELECT a.k, a.id, a.n, b.id AS bid, b.n AS after FROM step a LEFT JOIN step b ON b.k = a.n WHERE a.id >= 0),
  best AS (
    SELECT k >> {BITS} AS w, min(m.rank::BIGINT * {LONG * LONG} + ((k & {LONG - 1}) << {BITS}) + (n & {LONG - 1})) AS best
    FROM pair JOIN merges m ON m.pair = id::BIGINT * 4294967296 + bid GROUP BY 1),
  chosen AS (
    SELECT w, (best // {LONG * LONG})::INTEGER AS rank, w * {LONG} + best // {LONG} % {LONG} AS place, w * {LONG} + best % {LONG} AS eaten FROM best)
  SELECT k, CASE k WHEN place THEN rank WHEN eaten THEN -1 ELSE id END, CASE k WHEN place THEN after ELSE n END
  FROM pair JOIN chosen ON w = k >> {BITS}))
SELECT k >> {BITS} AS w, {_ORDERED.format(place="k")}"""

#: The same with rows (word, position, id), and all pairs of the least rank a round.
_MANY = f"""
WITH RECURSIVE step(w, pos, id) USING KEY (w, pos) AS (
  SELECT w, pos, id FROM start
  UNION ALL (  WITH live AS (
    SELECT w, pos, id, lead(id) OVER o AS next, lead(id, 2) OVER o AS beyond, lag(id) OVER o AS before, row_number() OVER o AS k
    FROM step WHERE id >= 0 WINDOW o AS (PARTITION BY w ORDER BY pos)),
  pair AS (
    SELECT live.*, m.rank, min(m.rank) OVER (PARTITION BY w) AS low
    FROM live LEFT JOIN merges m ON m.pair = live.id::BIGINT * 4294967296 + live.next),
  hit AS (  -- pairs that overlap lie in one run
    SELECT *, rank IS NOT DISTINCT FROM low AS hit,
      k - row_number() OVER (PARTITION BY w, rank IS NOT DISTINCT FROM low ORDER BY k) AS run
    FROM pair WHERE low IS NOT NULL),
  odd AS (SELECT *, hit AND row_number() OVER (PARTITION BY w, hit, run ORDER BY k) % 2 = 1 AS taken FROM hit),
  near AS (
    SELECT *, CASE WHEN lag(taken, 2) OVER o THEN low ELSE before END AS at_left, lag(taken) OVER o AS eaten
    FROM odd WINDOW o AS (PARTITION BY w ORDER BY k)),
  last AS (  -- the first contraction that makes a pair of lower rank is the last of this round
    SELECT near.*, min(CASE WHEN a.rank < low OR b.rank < low THEN k END) OVER (PARTITION BY w) AS last
    FROM near LEFT JOIN merges a ON taken AND a.pair = at_left::BIGINT * 4294967296 + low LEFT JOIN merges b ON taken AND b.pair = low::BIGINT * 4294967296 + beyond)
  SELECT w, pos, CASE WHEN taken AND k <= coalesce(last, k) THEN low WHEN eaten AND k - 1 <= coalesce(last, k) THEN -1 ELSE id END
  FROM last))
SELECT w, {_ORDERED.format(place="pos")}"""

_DECODE = """
SELECT text, array_to_string(list_select(pieces, ids), '') AS decoded
FROM (SELECT text, list(place ORDER BY pos) AS ids FROM tokens GROUP BY text), vocabulary ORDER BY text"""


def load_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a file with one base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge_table(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(left, right, rank) of every split of a token into two tokens."""
    rows = [
        (ranks[token[:i]], ranks[token[i:]], rank)
        for token, rank in ranks.items()
        for i in range(1, len(token))
        if token[:i] in ranks and token[i:] in ranks
    ]
    left, right, rank = np.array(rows, np.int32).reshape(-1, 3).T
    return left, right, rank


def _connection() -> duckdb.DuckDBPyConnection:
    """In memory only, one thread, as each task has one core."""
    return duckdb.connect(config={"threads": 1, "memory_limit": "1GB", "temp_directory": ""})


class Encoder:
    """Encodes pieces; ``memory``, two maps from pieces to their ids, outlives the task in its Python worker."""

    def __init__(self, ranks: dict[bytes, int], merges: tuple[np.ndarray, ...], memory: list[dict[str, bytes]], words: int):
        self.ranks, self.memory, self.words, self.long = ranks, memory, words, LONG
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.con = _connection()
        self.con.register("given", pa.table(dict(zip(("l", "r", "rank"), merges, strict=True))))
        self.con.execute("CREATE TABLE merges AS SELECT l::BIGINT * 4294967296 + r AS pair, rank FROM given")

    def _contract(self, raw: list[bytes], long: bool) -> list[bytes]:
        size = np.array([len(p) for p in raw])
        data = np.frombuffer(b"".join(raw), np.uint8)
        w = np.repeat(np.arange(len(raw)), size)
        pos = np.arange(len(data)) - np.repeat(np.cumsum(size) - size, size)
        if long:
            start = {"w": w, "pos": pos, "id": self.bytes[data]}
        else:
            key = w * LONG + pos
            start = {"k": key, "id": self.bytes[data], "n": np.where(pos == size[w] - 1, -1, key + 1)}
        self.con.register("start", pa.table(start))
        ids = self.con.sql(_MANY if long else _ONE).to_arrow_table()["ids"].combine_chunks()
        self.con.unregister("start")
        flat, ends = ids.values.to_numpy().astype("<u4").tobytes(), (4 * ids.offsets.to_numpy()).tolist()
        return [flat[a:b] for a, b in zip(ends, ends[1:], strict=False)]

    def encode(self, pieces: Sequence[str]) -> list[bytes]:
        """The ids of each piece; the distinct ones not known yet are encoded together."""
        if len(self.memory[0]) > self.words:
            self.memory[:] = {}, self.memory[0]
        known, older = self.memory
        new: dict[bool, list[tuple[str, bytes]]] = {False: [], True: []}
        for piece in set(pieces) - known.keys():
            if piece in older:
                known[piece] = older[piece]
                continue
            raw = piece.encode()
            rank = self.ranks.get(raw)
            if rank is not None:
                known[piece] = rank.to_bytes(4, "little")
            else:
                new[len(raw) > self.long].append((piece, raw))
        for long, found in new.items():
            if found:
                known.update(zip([piece for piece, _ in found], self._contract([raw for _, raw in found], long), strict=True))
        return [known[p] for p in pieces]


def _cut(pattern: regex.Pattern, text: str) -> Iterator[list[str]]:
    """The pieces of a text; those of a very long one in steps."""
    if len(text) <= CHARS:
        yield pattern.findall(text)
        return
    found = (m[0] for m in pattern.finditer(text))
    while step := list(islice(found, PIECES)):
        yield step


def _encoded(encoder: Encoder, pattern: regex.Pattern, texts: Iterable[str]) -> Iterator[bytes]:
    """The ids of each text, little-endian; the pieces of neighbouring texts are encoded together."""
    block: list[list[str]] = []
    held = 0
    for text in chain(texts, [None]):
        if block and (text is None or held > PIECES or len(text) > CHARS):
            ids = iter(encoder.encode(list(chain.from_iterable(block))))
            yield from (b"".join(islice(ids, len(own))) for own in block)
            block, held = [], 0
        if text is None:
            return
        if len(text) > CHARS:
            yield b"".join(chain.from_iterable(map(encoder.encode, _cut(pattern, text))))
        else:
            block += _cut(pattern, text)
            held += len(block[-1])


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """(doc_id, n_tokens long, ids binary): the token ids of every whole text as little-endian unsigned 32-bit numbers.

    ``ranks`` must hold all 256 single bytes; no special tokens are known, so their strings are ordinary text. A NULL or
    empty text has no tokens. Each row is encoded on its own: repeated ids, NULL ids and equal texts need no care, an empty
    table gives an empty result. Other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast((ranks, merge_table(ranks), [{}, {}]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, cutter = Encoder(*shared.value, words), regex.compile(pattern)
        for batch in batches:
            texts = (x.as_py() or "" for x in batch.column(1))
            ids = list(_encoded(encoder, cutter, texts))
            n = np.array([len(x) // 4 for x in ids], np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(ids, pa.binary())], ["doc_id", "n_tokens", "ids"])

    columns = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return columns.mapInArrow(run, f"doc_id {columns.schema['doc_id'].dataType.simpleString()}, n_tokens bigint, ids binary")


def _decoded(con: duckdb.DuckDBPyConnection, valid: np.ndarray, column: pa.Array) -> list[bytes]:
    """The bytes of each row's ids; rows are worked on TOKENS tokens at a time."""
    out: list[list[bytes]] = [[] for _ in range(len(column))]
    block: list[tuple[int, np.ndarray]] = []

    def flush() -> None:
        ids = np.concatenate([b[1] for b in block])
        if len(ids) and not (ids.max() < len(valid) and valid[ids].all()):
            raise ValueError("an id is not in the vocabulary")
        text = np.repeat(np.array([b[0] for b in block], np.int32), [len(b[1]) for b in block])
        con.register("tokens", pa.table({"text": text, "pos": np.arange(len(ids), dtype=np.int32), "place": ids.astype(np.int64) + 1}))
        table = con.sql(_DECODE).to_arrow_table()
        con.unregister("tokens")
        for row, decoded in zip(table["text"].to_pylist(), table["decoded"].to_pylist(), strict=True):
            out[row].append(decoded.encode("latin-1"))
        block.clear()

    size = 0
    for row, packed in enumerate(column):
        ids = np.frombuffer(packed.as_py() or b"", "<u4")
        for at in range(0, len(ids), TOKENS):
            block.append((row, ids[at : at + TOKENS]))
            size += len(block[-1][1])
            if size >= TOKENS:
                flush()
                size = 0
    if block:
        flush()
    return [b"".join(parts) for parts in out]


def decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded binary): what ``encode`` gave, with the bytes its ids stand for.

    NULL or empty ids are no bytes. An id outside the vocabulary is an error.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = shared.value
        valid = np.zeros(max(ranks.values()) + 1, bool)
        valid[list(ranks.values())] = True
        con = _connection()
        # bytes as characters of the same number, as text concatenates faster than blobs; a row of all pieces by id
        pieces = [""] * len(valid)
        for token, rank in ranks.items():
            pieces[rank] = token.decode("latin-1")
        con.register("given", pa.table({"pieces": pa.array([pieces])}))
        con.execute("CREATE TABLE vocabulary AS SELECT * FROM given")
        for batch in batches:
            decoded = pa.array(_decoded(con, valid, batch.column(2)), pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, decoded], ["doc_id", "n_tokens", "ids", "decoded"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    columns = encoded.select("doc_id", "n_tokens", "ids")
    return columns.mapInArrow(run, f"doc_id {kind}, n_tokens bigint, ids binary, decoded binary")
