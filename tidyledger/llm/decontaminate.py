"""Benchmark decontamination: size-partitioned MinHash containment search.

Items are partitioned by size class (powers of two). In class c each item is represented by its MinHash sketch: the
smallest shingle hashes, one more than may be missing from a text that contains ``percent`` of it. A text that contains
an item therefore holds one of these hashes. The largest of them is the class's threshold: a text's sketch for the
class is the part of its own hashes up to that threshold, however long the text is, so short items are found inside
documents of any length. Equal hashes within a class make a candidate; a candidate is verified by the exact
containment of the item's word shingles in the whole text.

Items are taken in blocks whose sketches fit a fixed size, and each block is broadcast and run against all documents, so
the driver holds one block at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidyledger.llm.grams import K, Words
from tidyledger.llm.runtime import cut, share, small

PERCENT = 80
#: Bytes of item texts in a block; with hashes and Python objects a block takes about thirty times that.
BLOCK_BYTES = 1 << 22


class Items:
    """A block of items: texts, shingle sets, and the sketch index by size class."""

    def __init__(self, ids: list, texts: list[str], k: int, percent: int):
        self.k, self.percent = k, percent
        keep = [(i, t, s) for i, t, s in zip(ids, texts, Words(k).sets(pa.array(texts, pa.string())), strict=True) if len(s)]
        self.ids = [i for i, _, _ in keep]
        self.texts = [t for _, t, _ in keep]
        self.sizes = np.array([len(s) for _, _, s in keep], np.int64)
        self.need = -(-self.sizes * percent // 100)
        self.size_class = np.floor(np.log2(np.maximum(self.sizes, 1))).astype(np.int64)
        self.index = []  # (threshold, sorted sketch hashes, their items) per class
        for c in np.unique(self.size_class):
            members = np.flatnonzero(self.size_class == c)
            low = [keep[i][2][: len(keep[i][2]) - self.need[i] + 1] for i in members]
            hashes, owner = np.concatenate(low), np.repeat(members, [len(x) for x in low])
            order = np.argsort(hashes, kind="stable")
            self.index.append((hashes.max(), hashes[order], owner[order]))

    def candidates(self, grams: np.ndarray) -> np.ndarray:
        """Items that share a sketch hash with a text, given its shingle hashes in any order."""
        found = []
        for threshold, hashes, owner in self.index:
            sketch = grams[grams <= threshold]
            at = np.searchsorted(hashes, sketch)
            sketch = np.unique(sketch[hashes[np.minimum(at, len(hashes) - 1)] == sketch])
            lo, hi = np.searchsorted(hashes, sketch, "left"), np.searchsorted(hashes, sketch, "right")
            found += [owner[a:b] for a, b in zip(lo, hi, strict=True)]
        return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)

    def exact(self, text: str, items: np.ndarray) -> list[tuple[int, int]]:
        """(item, shared shingles) of the candidates that the text contains, compared word by word."""
        have = shingle_set(text, self.k)
        shared = ((i, len(have & shingle_set(self.texts[i], self.k))) for i in items)
        return [(int(i), n) for i, n in shared if n >= self.need[i]]


def shingle_set(text: str | None, k: int = K) -> set[tuple[str, ...]]:
    """The distinct shingles as words; the same rule as the hashed ones."""
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall("[^\x20\x09-\x0d]+", lowered)
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def _blocks(items: DataFrame, item_col: str, text_col: str, block_bytes: int) -> Iterator[list]:
    """Items in blocks of about ``block_bytes``, streamed through the driver one partition at a time."""
    block, held = [], 0
    for row in items.select(item_col, text_col).filter(F.length(text_col) > 0).toLocalIterator():
        block.append((row[0], row[1]))
        held += len(row[1])
        if held >= block_bytes:
            yield block
            block, held = [], 0
    if block:
        yield block


def leaks(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", k: int = K, percent: int = PERCENT, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(doc_id, item_id, n_item, n_shared): every document that holds ``percent`` of an item's distinct shingles.

    An item of fewer than ``k`` words is one shingle and matches a text that is that sequence; use longer items. NULL or
    empty items and texts match nothing. Repeated documents or items are each reported, so equal rows can appear; NULL ids
    are reported as NULL. Without documents or items the result is empty. Other columns are not read.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kinds = docs.schema[id_col].dataType.simpleString(), items.schema[item_col].dataType.simpleString()
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, n_item bigint, n_shared bigint"
    parts = []
    for block in _blocks(items, item_col, item_text_col, block_bytes):
        shared = share(spark, Items([b[0] for b in block], [b[1] for b in block], k, percent))

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            known, words = shared(), Words(k)
            item_type = pa.array(known.ids).type if known.ids else pa.int64()
            low = max((x[0] for x in known.index), default=np.uint64(0))
            union = np.unique(np.concatenate([x[1] for x in known.index])) if known.index else np.zeros(0, np.uint64)
            seen = np.zeros(1 << 22, bool)
            seen[union >> np.uint64(42)] = True
            for batch in batches:
                docs, out, n_item, n_shared = [], [], [], []
                column = batch.column(1)
                for row, grams, offsets in words.chunk_shingles(column):
                    near = np.flatnonzero((grams <= low) & seen[grams >> np.uint64(42)])
                    rows = np.searchsorted(offsets, near, side="right") - 1
                    for i in np.unique(rows):
                        met = known.candidates(grams[near[rows == i]])
                        if len(met):
                            for item, n in known.exact(column[row + int(i)].as_py(), met):
                                docs.append(row + int(i))
                                out.append(known.ids[item])
                                n_item.append(int(known.sizes[item]))
                                n_shared.append(n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(docs, pa.int64())), pa.array(out, item_type), pa.array(n_item, pa.int64()), pa.array(n_shared, pa.int64())],
                    ["doc_id", "item_id", "n_item", "n_shared"],
                )

        parts.append(texts.mapInArrow(search, schema))
        if len(parts) > 1:  # many blocks: keep the plan short
            parts = [cut(reduce(DataFrame.unionAll, parts))]
    return parts[0] if parts else spark.createDataFrame([], schema)


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` without those that ``leaks`` reports. A row with a NULL id stays: it cannot be named."""
    found = small(cut(leaks(docs, items, id_col=id_col, **options).select(F.col("doc_id").alias(id_col)).distinct()))
    return docs.join(found, id_col, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
