"""Phrase collocations: phrases of up to five words that occur far more often than their parts let expect.

Counts are exact and come from weighted acyclic automata:

1. Each task counts the n-grams of its texts (a shard) that may reach ``least`` occurrences in all, sorts them, and builds count
   transducers from them, one per prefix range: a path is the language and the words, its weight the count.
2. The transducers of a range meet in one task, which walks all of them at once, sums weights, and keeps what reaches
   ``least``: the range's transducer. Each n-gram has one range, whatever its shard. Ranges are cut from a sample of
   the n-grams themselves, so a frequent first word is spread over many.
3. Every phrase asks for the counts of its parts. Requests go to the range of the part, sorted, and are composed with its
   transducer. A range that is asked much is copied to several tasks.

What may reach ``least`` is known from two passes before: all words and pairs, then all triples of pairs left, are
counted by 32-bit hashes, with counts cut at ``least``. Hashes that reach it go into a bit filter of fixed size, the one
thing broadcast. An n-gram that occurs ``least`` times passes for sure, as do all parts of it, so a filter that is too full costs
work but changes nothing.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidyledger.llm import automata
from tidyledger.llm.automata import Automaton, Path
from tidyledger.llm.grams import Words, chunks, mix
from tidyledger.llm.runtime import cut

LEAST, LONGEST, TOP, SHARE = 100, 5, 2000, 100

#: Slices of the space of 32-bit hashes, bits of the filter, hashes a task gathers before it reduces them.
SLICES, FILTER_BITS, GATHERED = 1024, 1 << 25, 1 << 23
#: Distinct n-grams a shard holds before its transducers are written; n-grams a range should hold; sampled n-grams.
SHARD, RANGE, SAMPLE = 1 << 20, 1 << 15, 1 << 13
#: N-gram occurrences a shard holds before equal ones are joined.
HELD = 1 << 21
#: Requests that one task answers.
ASKED = 1 << 17

_MARKS = b".,;:!?\n\x0b\x0c\r"

_PARTS = ("labels", "arcs", "label", "target", "weights")
_REQUEST = {
    "range": pa.int32(), "path": pa.list_(pa.string()), "lang": pa.string(), "phrase": pa.string(), "a": pa.int64(),
    "words": pa.int32(), "cut": pa.int32(), "side": pa.string(),
}
_ANSWER = ["lang", "phrase", "a", "words", "cut", "side", "f"]


class Pieces:
    """The words of a chunk: spans, rows, and the piece each is in."""

    def __init__(self):
        self.words = Words(LONGEST)
        self.mark = np.zeros(256, bool)
        self.mark[list(_MARKS)] = True
        self.words.space[:] = self.mark
        self.words.space[[9, 32]] = True
        self.lower = np.arange(256, dtype=np.uint8)
        self.lower[65:91] += 32
        self.seeds: dict[str, int] = {}

    def chunks(self, batch: pa.RecordBatch) -> Iterator[Chunk]:
        """Column 0 is the language, column 1 the text."""
        for at, data, offsets in chunks(batch.column(1)):
            langs = batch.column(0).slice(at, len(offsets) - 1).fill_null("und").to_pylist()
            yield Chunk(self, data, offsets, langs)


class Chunk:
    def __init__(self, pieces: Pieces, data: np.ndarray, offsets: np.ndarray, langs: list[str]):
        self.pieces, self.data, self.langs = pieces, data, langs
        self.begin, self.end, self.row = pieces.words.spans(data, offsets)
        marks = np.cumsum(pieces.mark[data]) if len(data) else np.zeros(0, np.int64)
        self.piece = marks[self.begin] + self.row if len(self.begin) else np.zeros(0, np.int64)
        self.hashes = pieces.words.hashes(data, self.begin, self.end)
        for lang in set(langs) - pieces.seeds.keys():
            pieces.seeds[lang] = int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")
        self.seed = np.array([pieces.seeds[x] for x in langs], np.uint64)[self.row]

    def whole(self, n: int) -> np.ndarray:
        """Which words begin ``n`` words of one piece."""
        out = np.zeros(len(self.piece), bool)
        if len(out) >= n:
            out[: len(out) - n + 1] = self.piece[: len(out) - n + 1] == self.piece[n - 1 :]
        return out

    def keys(self, n: int) -> np.ndarray:
        """A 64-bit hash of language and words of the n-gram that begins at each word, as far as there is one."""
        size = max(0, len(self.hashes) - n + 1)
        total = self.seed[:size] + np.uint64(n)
        for j in range(n):
            total = total + self.hashes[j : j + size] * self.pieces.words.factors[j]
        return np.r_[mix(total), np.zeros(len(self.hashes) - size, np.uint64)]

    def texts(self, words: np.ndarray) -> pa.Array:
        """The lowered text of some words."""
        size = self.end[words] - self.begin[words]
        first = np.cumsum(size) - size
        place = np.arange(size.sum()) + np.repeat(self.begin[words] - first, size)
        offsets = np.r_[0, np.cumsum(size)]
        data = self.pieces.lower[self.data[place]]
        return pa.LargeStringArray.from_buffers(len(words), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data.tobytes()))


def _passes(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the filter has the bit of each key: the leading bits of its 32."""
    at = (keys >> np.uint64(64 - (FILTER_BITS - 1).bit_length())).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _reduced(keys: list[np.ndarray], counts: list[np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 32-bit hashes, ascending, with their counts summed and cut at ``least``."""
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, sums = key[order], np.r_[0, np.cumsum(count[order])]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][: len(key)])
    last = np.r_[first[1:], len(key)]
    return key[first], np.minimum(sums[last] - sums[first], least)


def _hashed(rows: DataFrame, keys_of: Callable[[Chunk], np.ndarray], least: int) -> DataFrame:
    """(slice, keys, counts): each task's hashes by slice; and (lang, n): its words, with NULL as the slice."""
    kind = np.dtype(np.min_scalar_type(least)).newbyteorder("<")
    slices, gathered = SLICES, GATHERED

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, keys, counts, size = Pieces(), [], [], 0
        words: dict[str, int] = {}

        def written(key: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
            at = np.searchsorted(key, np.arange(slices, dtype=np.uint64) * np.uint64((1 << 32) // slices))
            spans = [(i, s, e) for i, (s, e) in enumerate(zip(at, np.r_[at[1:], len(key)], strict=True)) if e > s]
            low, few = key.astype("<u4"), count.astype(kind)
            columns = [
                pa.array([i for i, _, _ in spans], pa.int32()),
                pa.array([low[s:e].tobytes() for _, s, e in spans], pa.binary()),
                pa.array([few[s:e].tobytes() for _, s, e in spans], pa.binary()),
                pa.nulls(len(spans), pa.string()), pa.nulls(len(spans), pa.int64()),
            ]
            return pa.RecordBatch.from_arrays(columns, ["slice", "keys", "counts", "lang", "n"])

        for batch in batches:
            for chunk in pieces.chunks(batch):
                for lang, n in zip(chunk.langs, np.bincount(chunk.row, minlength=len(chunk.langs)).tolist(), strict=True):
                    words[lang] = words.get(lang, 0) + n
                key = keys_of(chunk) >> np.uint64(32)
                keys.append(key)
                counts.append(np.ones(len(key), np.int64))
                size += len(key)
                if size >= gathered:
                    key, count = _reduced(keys, counts, least)
                    keys, counts, size = [key], [count], len(key)
                    if 2 * size >= gathered:
                        yield written(key, count)
                        keys, counts, size = [], [], 0
        if size:
            yield written(*_reduced(keys, counts, least))
        n = len(words)
        columns = [pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())]
        columns += [pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["slice", "keys", "counts", "lang", "n"])

    return rows.mapInArrow(run, "slice int, keys binary, counts binary, lang string, n bigint")


def _filter(hashed: DataFrame, least: int) -> np.ndarray:
    """The bit filter of the hashes that reach ``least``; one slice at a time is counted in a task."""
    kind = np.dtype(np.min_scalar_type(least)).newbyteorder("<")
    width, bits = (1 << 32) // SLICES, FILTER_BITS // SLICES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, counts = None, np.zeros(width, np.uint32)

        def written() -> pa.RecordBatch:
            often = (counts >= least).reshape(bits, -1).any(axis=1)
            packed = np.packbits(often, bitorder="little").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([held], pa.int32()), pa.array([packed], pa.binary())], ["slice", "bits"])

        for batch in batches:
            for at, keys, few in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                if held is not None and at != held:
                    yield written()
                    counts[:] = 0
                held = at
                key = np.frombuffer(keys, "<u4") - np.uint32(at * width)
                counts[key] = np.minimum(counts[key] + np.frombuffer(few, kind), least)
        if held is not None:
            yield written()

    parts = hashed.filter("slice is not null").select("slice", "keys", "counts")
    counted = parts.repartition("slice").sortWithinPartitions("slice").mapInArrow(run, "slice int, bits binary")
    out = np.zeros((SLICES, bits // 8), np.uint8)
    for row in counted.toLocalIterator():  # SLICES rows of fixed size
        out[row["slice"]] = np.frombuffer(row["bits"], np.uint8)
    return out.reshape(-1)


def _pairs(chunk: Chunk) -> np.ndarray:
    return np.r_[chunk.keys(1), chunk.keys(2)[chunk.whole(2)]]


def _triples(shared) -> Callable[[Chunk], np.ndarray]:
    """Hashes of the triples of which both pairs may be frequent."""

    def keys(chunk: Chunk) -> np.ndarray:
        pair = chunk.whole(2) & _passes(shared.value, chunk.keys(2))
        return chunk.keys(3)[chunk.whole(3) & pair & np.r_[pair[1:], False][: len(pair)]]

    return keys


def _sampled(rows: DataFrame, shared, rate: int) -> DataFrame:
    """(path): words and pairs that may be frequent, those whose hash is divisible by ``rate``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, seen = Pieces(), set()
        for batch in batches:
            for chunk in pieces.chunks(batch):
                for n in (1, 2):
                    keys = chunk.keys(n)
                    chosen = np.flatnonzero(chunk.whole(n) & (keys % np.uint64(rate) == 0) & _passes(shared.value, keys))
                    _, first = np.unique(keys[chosen], return_index=True)
                    words = [chunk.texts(chosen[first] + j).to_pylist() for j in range(n)]
                    langs = [chunk.langs[r] for r in chunk.row[chosen[first]]]
                    new = set(zip(langs, *words, strict=True)) - seen
                    seen = new if len(seen) > SAMPLE else seen | new
                    yield pa.RecordBatch.from_arrays([pa.array([list(p) for p in new], pa.list_(pa.string()))], ["path"])

    return rows.mapInArrow(run, "path array<string>").distinct()


def _cuts(rows: DataFrame, shared) -> list[Path]:
    """First paths of the prefix ranges but the first, in order."""
    count = int(np.unpackbits(shared.value).sum())
    ranges = 1 + count // RANGE
    if ranges == 1:
        return []
    sample = cut(_sampled(rows, shared, max(1, count // SAMPLE)))
    n = max(1, sample.count())
    kept = sample.filter(F.pmod(F.xxhash64("path"), F.lit(n)) < SAMPLE)  # so about SAMPLE rows at any size
    paths = sorted(tuple(r[0]) for r in kept.collect())
    return sorted({paths[i * len(paths) // ranges] for i in range(1, ranges)}) if paths else []


class Shard:
    """Counts of the n-grams of a task by exact words."""

    def __init__(self):
        self.words: dict[str, int] = {}
        self.langs: dict[str, int] = {}
        self.parts: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.size = 0

    def add(self, chunk: Chunk, pairs: np.ndarray, triples: np.ndarray) -> None:
        """The n-grams of a chunk that may be frequent; of four and five words, those of frequent triples."""
        if not len(chunk.row):
            return
        often = [_passes(pairs, chunk.keys(1))]
        often.append(chunk.whole(2) & _passes(pairs, chunk.keys(2)))
        often.append(chunk.whole(3) & _passes(triples, chunk.keys(3)))
        for n in range(4, LONGEST + 1):
            often.append(chunk.whole(n) & often[-1] & np.r_[often[-1][1:], False])
        coded = chunk.texts(np.flatnonzero(often[0])).dictionary_encode()
        known = np.array([self.words.setdefault(x, len(self.words)) for x in coded.dictionary.to_pylist()], np.int32)
        ids = np.full(len(chunk.row), -1, np.int32)
        if len(known):
            ids[often[0]] = known[coded.indices.to_numpy()]
        lang = np.array([self.langs.setdefault(x, len(self.langs)) for x in chunk.langs], np.int32)[chunk.row]
        for n, mask in enumerate(often, 1):
            at = np.flatnonzero(mask)
            for j in range(n):  # a filter may let through what a part shows to be rare
                at = at[ids[at + j] >= 0]
            rows = np.full((len(at), 1 + LONGEST), -1, np.int32)
            rows[:, 0] = lang[at]
            for j in range(n):
                rows[:, 1 + j] = ids[at + j]
            self.parts.append(rows)
            self.counts.append(np.ones(len(at), np.int64))
            self.size += len(at)

    def reduce(self) -> int:
        """Equal n-grams become one; the number left."""
        rows, counts = np.concatenate(self.parts), np.concatenate(self.counts)
        order = np.lexsort(rows.T[::-1])
        rows, sums = rows[order], np.r_[0, np.cumsum(counts[order])]
        first = np.flatnonzero(np.r_[True, (rows[1:] != rows[:-1]).any(axis=1)][: len(rows)])
        last = np.r_[first[1:], len(rows)]
        self.parts, self.counts, self.size = [rows[first]], [sums[last] - sums[first]], len(first)
        return self.size

    def paths(self) -> list[tuple[Path, int]]:
        """The n-grams as paths in ascending order."""
        self.reduce()
        langs, words = list(self.langs), list(self.words)
        return sorted(
            ((langs[r[0]], *(words[i] for i in r[1:] if i >= 0)), c)
            for r, c in zip(self.parts[0].tolist(), self.counts[0].tolist(), strict=True)
        )


def _row(at: int, automaton: Automaton) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), *automaton.columns()], ["range", *_PARTS])


def _read(batch: pa.RecordBatch | pa.Table, row: int) -> Automaton:
    return Automaton.read(*(batch.column(name)[row].as_py() for name in _PARTS))


def _transducers(rows: DataFrame, pairs, triples, cuts: list[Path], shard_size: int) -> DataFrame:
    """(range, automaton): the count transducers of every shard, one per prefix range."""
    held = HELD

    def written(shard: Shard) -> Iterator[pa.RecordBatch]:
        paths = shard.paths()
        ends = [*(bisect_left(paths, c, key=lambda p: p[0]) for c in cuts), len(paths)]
        for at, (begin, end) in enumerate(zip([0, *ends], ends, strict=False)):
            if end > begin:
                yield _row(at, automata.build(paths[begin:end]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, shard = Pieces(), Shard()
        for batch in batches:
            for chunk in pieces.chunks(batch):
                shard.add(chunk, pairs.value, triples.value)
                if shard.size >= held and shard.reduce() >= shard_size:
                    yield from written(shard)
                    shard = Shard()
        if shard.size:
            yield from written(shard)

    return rows.mapInArrow(run, f"range int, {automata.SCHEMA}")


def _united(shards: DataFrame, least: int) -> DataFrame:
    """(range, automaton): one transducer per range, of the n-grams that reach ``least`` in all shards together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = None, automata.Sum()

        def written() -> Iterator[pa.RecordBatch]:
            whole = automata.build((path, n) for path, n in total.paths() if n >= least)
            if whole.arcs[-1]:
                yield _row(held, whole)

        for batch in batches:
            for row, at in enumerate(batch.column(0).to_pylist()):
                if held is not None and at != held:
                    yield from written()
                    total = automata.Sum()
                held = at
                total.add(_read(batch, row))
        if held is not None:
            yield from written()

    by_range = shards.repartition("range").sortWithinPartitions("range")
    return by_range.mapInArrow(run, f"range int, {automata.SCHEMA}")


def _requests(united: DataFrame, cuts: list[Path]) -> DataFrame:
    """(range, path, lang, phrase, a, words, cut, side): each phrase asks for both parts of each of its cuts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                out: list[tuple] = []
                for path, n in _read(batch, row).paths():
                    lang, *words = path
                    for k in range(1, len(words)):
                        for side, part in (("l", words[:k]), ("r", words[k:])):
                            asked = (lang, *part)
                            out.append((bisect_right(cuts, asked), list(asked), lang, " ".join(words), n, len(words), k, side))
                columns = list(zip(*out, strict=True)) if out else [[]] * len(_REQUEST)
                arrays = [pa.array(c, kind) for c, kind in zip(columns, _REQUEST.values(), strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, list(_REQUEST))

    kinds = "range int, path array<string>, lang string, phrase string, a bigint, words int, cut int, side string"
    return united.mapInArrow(run, kinds)


def _answered(requests: DataFrame, united: DataFrame, asked_size: int) -> DataFrame:
    """The requests with ``f``, the count of their part: composed with the transducer of its range.

    A range that is asked more than ``asked_size`` times is copied, and its requests are dealt to the copies by phrase.
    """
    n = requests.groupBy("range").agg(F.count(F.lit(1)).alias("asked"))
    copies = n.select("range", F.ceil(F.col("asked") / asked_size).cast("int").alias("copies"))
    copies = F.broadcast(copies)  # one row a range
    dealt = requests.join(copies, "range").withColumn("copy", F.pmod(F.xxhash64("phrase", "cut"), "copies").cast("int"))
    copied = united.join(copies, "range").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))

    def compose(asked: pa.Table, automaton: pa.Table) -> pa.Table:
        paths = [tuple(p) for p in asked["path"].to_pylist()]
        order = sorted(range(len(paths)), key=paths.__getitem__)
        found = np.zeros(len(paths), np.int64)
        if len(automaton):
            found[order] = list(_read(automaton, 0).weights_of(paths[i] for i in order))
        return asked.select(_ANSWER[:-1]).append_column("f", pa.array(found))

    grouped = dealt.drop("copies").groupBy("range", "copy").cogroup(copied.drop("copies").groupBy("range", "copy"))
    return grouped.applyInArrow(compose, "lang string, phrase string, a bigint, words int, cut int, side string, f bigint")


def _lowest(answers: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of the lowest-scoring cut of every phrase, in exact decimals."""
    part = lambda side, k: F.max(F.when((F.col("side") == side) & (F.col("cut") == k), F.col("f")))
    parts = [part(side, k).alias(f"{side}{k}") for side in "lr" for k in range(1, LONGEST)]
    phrases = answers.groupBy("lang", "phrase").agg(F.max("a").alias("a"), *parts).join(totals, "lang")

    def cut_at(k: int) -> Column:
        wide = "cast({} as decimal(19, 0))"
        above, below = f"{wide.format('1000 * a')} * {wide.format('n')}", f"{wide.format(f'l{k}')} * {wide.format(f'r{k}')}"
        fields = f"(({above}) div ({below})) as score, {k} as cut, l{k} as l, r{k} as r"
        return F.expr(f"case when l{k} is not null then struct({fields}) end")

    best = phrases.withColumn("best", F.array_min(F.array(*(cut_at(k) for k in range(1, LONGEST)))))
    return best.select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")


def collocations(
    docs: DataFrame, least: int = LEAST, top: int = TOP, share: int = SHARE, text_col: str = "text", lang_col: str = "lang",
    shard_size: int = SHARD, asked_size: int = ASKED,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of every language by score.

    Texts are lowered in A-Z, split at . , ; : ! ? and line ends into pieces, and those at spaces and tabs into words. A phrase
    of 2 to 5 words with ``a`` >= ``least`` occurrences within pieces is a candidate; cut after its first words, its parts occur
    l and r times, and its score is floor(1000 a n / (l r)), n the language's words; the lowest-scoring cut counts, of
    equal ones the earliest. A candidate inside a longer one that occurs in ``share`` per cent of its places goes: for that
    it is enough to look at candidates of one word more, as what lies between two phrases occurs no less than the longer.
    Order: score and a descending, then the phrase's bytes.

    A NULL language is ``und``; a NULL text is empty. Every row counts, so repeated rows count each time. An
    empty table, or one without candidates, gives no rows. Other columns are not read.
    """
    rows = docs.select(F.col(f"`{lang_col}`").alias("lang"), F.col(f"`{text_col}`").alias("text"))
    share_out = rows.sparkSession.sparkContext.broadcast
    hashed = cut(_hashed(rows, _pairs, least))
    totals = cut(hashed.filter("n is not null").groupBy("lang").agg(F.sum("n").alias("n")))
    pairs = share_out(_filter(hashed, least))
    cuts = _cuts(rows, pairs)
    triples = share_out(_filter(_hashed(rows, _triples(pairs), least), least))
    united = cut(_united(_transducers(rows, pairs, triples, cuts, shard_size), least))
    requests = cut(_requests(united, cuts))
    answers = cut(_answered(requests, united, asked_size))
    held = answers.filter("words > 2 and (cut = 1 and side = 'r' or cut = words - 1 and side = 'l')")
    held = held.filter(F.lit(100) * F.col("a") >= F.lit(share) * F.col("f"))
    inside = held.select("lang", F.when(F.col("side") == "r", F.expr("substring_index(phrase, ' ', 1 - words)")).otherwise(
        F.expr("substring_index(phrase, ' ', words - 1)")).alias("phrase")).distinct()
    left = _lowest(answers, totals).join(inside, ["lang", "phrase"], "left_anti")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    for keys in ([F.col("lang"), F.pmod(F.xxhash64("phrase"), F.lit(64))], [F.col("lang")]):  # a large language in parts first
        left = left.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= top)
    return left.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
