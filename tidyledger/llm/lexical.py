"""Ranked lexical search: the documents of highest impact score for each of a set of queries, by norm buckets.

A document is a vector of integer impacts over its terms, a query one of integer weights; the score is their product. Each
task takes its documents' vectors in slabs of SLAB entries, orders a slab by vector length and cuts it into buckets of BUCKET
rows. For one bucket and one query, with ``floor`` the score that a document has to reach:

* Cauchy-Schwarz: if the query's length times the bucket's largest length is below ``floor``, the bucket is passed over.
  Both sides carry the square root of a term's weight, which makes the bound tight for common terms.
* Coordinate bounds: a term adds at most its weight times the largest impact in the bucket. Terms are put in order of
  that bound; those whose bounds together stay below ``floor`` cannot make a result alone, so only the postings of the
  others are read, and of the documents met only those that the open bounds can still lift to ``floor`` survive.
* Survivors are scored again from their whole vectors, in 64-bit integers.

Floors come from a first round over the longest bucket of every slab: the k-th best of all its scores is reached by
k documents, so no result lies below it. In the second round a task raises its own floors as it finds better documents.
All bounds are integers or carry a margin for rounding, and equal scores are never pruned, so the result is exact.

Only terms of the queries enter the vectors. Queries are taken in blocks of about BLOCK distinct terms, one pass over the
texts each; what is broadcast is a block's terms, weights and floors. Terms are compared by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidyledger.llm.grams import Words, chunks, lists
from tidyledger.llm.runtime import cut

#: Terms of the queries of one block; entries of the vectors that a task orders at once; rows of a bucket.
BLOCK, SLAB, BUCKET = 1 << 20, 1 << 22, 4096

# The impact of a term and the weight of a document's length.
SCALE, TERM, LENGTH, BASE, SLOPE = 1_000_000_000, 1000, 12, 75, 25


def _terms() -> Words:
    """Terms are runs of ASCII letters and digits and of all characters from U+0080 on."""
    words = Words()
    words.space[:128] = True
    words.space[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False
    return words


def _counted(words: Words, data: np.ndarray, offsets: np.ndarray, vocabulary: np.ndarray | None) -> tuple[np.ndarray, ...]:
    """Terms with repeats per row, then (row, term, count) of the distinct terms, by place in ``vocabulary`` if one is given."""
    begin, end, row = words.spans(data, offsets)
    terms = words.hashes(data, begin, end)
    n = np.bincount(row, minlength=len(offsets) - 1)
    if vocabulary is not None:
        at = np.searchsorted(vocabulary, terms)
        at[at == len(vocabulary)] = 0
        hit = vocabulary[at] == terms if len(vocabulary) else np.zeros(len(terms), bool)
        terms, row = at[hit], row[hit]
    order = np.lexsort((terms, row))
    row, terms = row[order], terms[order]
    new = np.r_[True, (row[1:] != row[:-1]) | (terms[1:] != terms[:-1])][: len(row)]
    first = np.flatnonzero(new)
    return n, row[first], terms[first], np.diff(np.r_[first, len(row)])


def _ragged(values: np.ndarray, row: np.ndarray, rows: int, kind: pa.DataType) -> pa.Array:
    offsets = np.r_[0, np.cumsum(np.bincount(row, minlength=rows))].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def _questions(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(item_id, terms, counts) of the items that have a term; rows that repeat an item and its text count once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _terms()
        for batch in batches:
            for at, data, offsets in chunks(batch.column(1)):
                rows = len(offsets) - 1
                _, row, terms, count = _counted(words, data, offsets, None)
                split = np.split(terms, np.cumsum(np.bincount(row, minlength=rows))[:-1])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, rows), lists(split), _ragged(count, row, rows, pa.int64())], ["item_id", "terms", "counts"]
                )

    given = items.select(F.col(f"`{item_col}`").alias("item_id"), F.col(f"`{text_col}`").alias("text")).distinct()
    kind = given.schema["item_id"].dataType.simpleString()
    return given.mapInArrow(run, f"item_id {kind}, terms array<bigint>, counts array<bigint>").filter(F.size("terms") > 0)


def _vectors(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """(doc_id, n, terms, counts): all terms of a document counted, those of the vocabulary by their place in it."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _terms()
        for batch in batches:
            for at, data, offsets in chunks(batch.column(1)):
                rows = len(offsets) - 1
                n, row, terms, count = _counted(words, data, offsets, shared.value)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, rows), pa.array(n, pa.int64()), _ragged(terms, row, rows, pa.int32()), _ragged(count, row, rows, pa.int64())],
                    ["doc_id", "n", "terms", "counts"],
                )

    return docs.mapInArrow(run, "doc_id bigint, n bigint, terms array<int>, counts array<bigint>")


class Bucket:
    """Vectors of similar length: by row, and by term for the bounds."""

    def __init__(self, rows: np.ndarray, known: np.ndarray, ids: np.ndarray, size: np.ndarray, terms: np.ndarray, impacts: np.ndarray):
        self.rows, self.known, self.ids = rows, known, ids
        self.first, self.size, self.terms, self.impacts = np.cumsum(size) - size, size, terms, impacts
        owner = np.repeat(np.arange(len(size)), size)
        order = np.argsort(terms, kind="stable")
        by_term = terms[order]
        self.starts = np.flatnonzero(np.r_[True, by_term[1:] != by_term[:-1]][: len(terms)])
        self.ends = np.r_[self.starts[1:], len(terms)]
        self.present, self.owner, self.impact = by_term[self.starts], owner[order], impacts[order]
        self.peak = np.maximum.reduceat(self.impact, self.starts) if len(terms) else np.zeros(0, np.int64)

    def survivors(self, terms: np.ndarray, gain: np.ndarray, floor: int) -> np.ndarray:
        """Rows that may reach ``floor``, by the coordinate bounds."""
        at = np.searchsorted(self.present, terms)
        at[at == len(self.present)] = 0
        here = self.present[at] == terms
        at, gain = at[here], gain[here]
        bound = gain * self.peak[at]
        order = np.argsort(bound, kind="stable")
        at, gain, open_bound = at[order], gain[order], np.cumsum(bound[order])
        if not len(at) or open_bound[-1] < floor:
            return np.zeros(0, np.int64)
        rest = int(np.searchsorted(open_bound, floor, side="left"))
        met = np.zeros(len(self.size), np.int64)
        for t, g in zip(at[rest:], gain[rest:], strict=True):
            met[self.owner[self.starts[t] : self.ends[t]]] += g * self.impact[self.starts[t] : self.ends[t]]
        return np.flatnonzero((met > 0) & (met + (open_bound[rest - 1] if rest else 0) >= floor))

    def scores(self, rows: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """The whole products of some rows, in integers."""
        size = self.size[rows]
        place = np.arange(size.sum()) + np.repeat(self.first[rows] - (np.cumsum(size) - size), size)
        sums = np.r_[0, np.cumsum(weight[self.terms[place]] * self.impacts[place])]
        ends = np.cumsum(size)
        return sums[ends] - sums[ends - size]


def _spread(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """A document's length against the mean, in whole numbers of any size."""
    if len(n) and SLOPE * int(n.max()) * n_docs >= 1 << 63:
        return np.array([BASE + SLOPE * int(x) * n_docs // n_terms for x in n], np.int64)
    return BASE + SLOPE * n * n_docs // n_terms


def _top(score: np.ndarray, known: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best: by score, then the smaller id, a NULL id last."""
    return np.lexsort((ids, ~known, -score))[:k]


def _search(vectors: DataFrame, n_docs: int, n_terms: int, block: list[tuple], weight: np.ndarray, floors: np.ndarray, k: int, longest: bool) -> DataFrame:
    """Each task's best documents for every query of the block, from all buckets or only the longest of each slab."""
    plain = [(terms, weight[terms] * counts, float(np.sqrt((weight[terms] * counts**2).sum()))) for _, terms, counts in block]
    shared = vectors.sparkSession.sparkContext.broadcast((plain, weight, floors))
    bucket_rows, slab_entries = BUCKET, SLAB

    def buckets(slab: list[tuple]) -> Iterator[tuple[float, Bucket]]:
        known, ids, size, terms, impacts, length = (np.concatenate(x) for x in zip(*slab, strict=True))
        first = np.cumsum(size) - size
        order = np.argsort(-length, kind="stable")
        for at in range(0, len(order), bucket_rows):
            rows = order[at : at + bucket_rows]
            n = size[rows]
            place = np.arange(n.sum()) + np.repeat(first[rows] - (np.cumsum(n) - n), n)
            yield float(length[rows[0]]), Bucket(rows, known[rows], ids[rows], n, terms[place], impacts[place])
            if longest:
                return

    def slabs(batches: Iterator[pa.RecordBatch], weight: np.ndarray) -> Iterator[list[tuple]]:
        slab: list[tuple] = []
        entries = 0
        for batch in batches:
            for at in range(0, len(batch), bucket_rows):
                part = batch.slice(at, bucket_rows)
                size = part.column(2).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
                terms, counts = (part.column(c).flatten().to_numpy(zero_copy_only=False) for c in (2, 3))
                n = part.column(1).to_numpy(zero_copy_only=False)
                spread = _spread(n, n_docs, n_terms)
                impacts = SCALE * counts // (TERM * counts + LENGTH * np.repeat(spread, size))
                square = np.r_[0, np.cumsum(weight[terms] * impacts.astype(np.float64) ** 2)]
                ends = np.cumsum(size)
                length = np.sqrt(np.maximum(square[ends] - square[ends - size], 0)) + 1e-6 * np.sqrt(square[-1])
                ids, known = part.column(0).fill_null(0).to_numpy(), part.column(0).is_valid().to_numpy(zero_copy_only=False)
                slab.append((known, ids, size, terms, impacts, length))
                entries += len(terms) + len(size)
                if entries >= slab_entries:
                    yield slab
                    slab, entries = [], 0
        if slab:
            yield slab

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weight, floors = shared.value
        floors = floors.copy()
        empty = (np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))
        best: list[tuple[np.ndarray, ...]] = [empty] * len(queries)
        dense = np.zeros(len(weight), np.int64)
        for slab in slabs(batches, weight):
            for longest_here, bucket in buckets(slab):
                if not len(bucket.terms):
                    continue
                for q, (terms, gain, length) in enumerate(queries):
                    if length * longest_here * (1 + 1e-9) < floors[q]:
                        continue
                    rows = bucket.survivors(terms, gain, floors[q])
                    if not len(rows):
                        continue
                    dense[terms] = gain
                    score = bucket.scores(rows, dense)
                    dense[terms] = 0
                    enough = score >= floors[q]
                    rows, score = rows[enough], score[enough]
                    score, known, ids = (np.r_[a, b] for a, b in zip(best[q], (score, bucket.known[rows], bucket.ids[rows]), strict=True))
                    keep = _top(score, known, ids, k)
                    best[q] = (score[keep], known[keep], ids[keep])
                    if len(keep) == k:
                        floors[q] = max(floors[q], score[keep[-1]])
        found = np.array([len(b[0]) for b in best])
        score, known, ids = (np.concatenate([b[i] for b in best]) for i in range(3))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(best)), found), pa.int32()), pa.array(ids, mask=~known), pa.array(score)], ["query", "doc_id", "score"]
        )

    return vectors.mapInArrow(run, "query int, doc_id bigint, score bigint")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _answered(docs: DataFrame, block: list[tuple], k: int) -> DataFrame:
    """(query, rank, doc_id, score) of one block of queries; ``query`` is the place in it."""
    vocabulary = np.unique(np.concatenate([terms for _, terms, _ in block]))
    block = [(item, np.searchsorted(vocabulary, terms), counts) for item, terms, counts in block]
    vectors = cut(_vectors(docs, vocabulary))
    n_docs, n_terms = vectors.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(vocabulary), np.int64)
    for term, n in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # one row a term
        df[term] = n
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(n) + 1))) for n in df], np.int64)
    floors = np.ones(len(block), np.int64)
    first = _best(_search(vectors, n_docs, max(n_terms, 1), block, weight, floors, k, longest=True), k)
    for query, score in first.filter(F.col("rank") == k).select("query", "score").collect():  # one row a query
        floors[query] = max(1, score)
    return _best(_search(vectors, n_docs, max(n_terms, 1), block, weight, floors, k, longest=False), k)


def ranked(
    docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", block_terms: int = BLOCK,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents of highest score above 0 for each item, or all if fewer.

    A term's weight is floor(1000 ln((2 N + 2) / (2 df + 1))) in doubles; everything else is 64-bit integers (see README for
    the formula). Equal scores go by smaller doc_id, a NULL id last. NULL or empty texts have no terms: such an item gets
    no rows, such a document is in no result and not counted in N. Rows that repeat a document are documents of their own;
    rows that repeat an item and its text are one item, and an item of several texts gets one ranking for each. Empty
    tables give no rows. doc_id must be a whole number; other columns are not read.
    """
    docs = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    asked = cut(_questions(items, item_col, item_text_col))
    kind = asked.schema["item_id"].dataType.simpleString()
    parts: list[DataFrame] = []

    def run(block: list[tuple]) -> None:
        names = docs.sparkSession.createDataFrame([(i, q[0]) for i, q in enumerate(block)], f"query int, item_id {kind}")
        found = _answered(docs, block, k).join(F.broadcast(names), "query")  # a block is bounded
        parts.append(found.select("item_id", "rank", "doc_id", "score"))
        if len(parts) > 1:
            parts[:] = [cut(reduce(DataFrame.unionAll, parts))]

    block: list[tuple] = []
    size = 0
    for item, terms, counts in asked.toLocalIterator():
        block.append((item, np.array(terms, np.int64).view(np.uint64), np.array(counts, np.int64)))
        size += len(terms)
        if size >= block_terms:
            run(block)
            block, size = [], 0
    if block:
        run(block)
    return parts[0] if parts else docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint")
