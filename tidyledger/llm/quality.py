"""Quality scores by Bradley-Terry ranking.

Labelled rows give preference pairs (good before bad), every good row with every bad one. Weights are learned by logistic
loss on the differences of the pair's features, so a document's score is its strength in a pairwise comparison. The cut is
a quantile of the training scores, the one that separates the labels best; scores are moved so that the cut lies at
THRESHOLD. Features are shares and means over the whole text, so its length, language, source and id are no inputs.

All labelled rows outside the held-out fold are learned from; none is drawn. The sums over all pairs of a Newton step come
from one pass: rows of like score are summed in narrow bins, whose mean scores are compared, all with all; the error is of
the order of a bin's width squared. The cut is looked for between all different scores.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidyledger.llm.grams import Words, chunks
from tidyledger.llm.labelled import held_out, training_labels
from tidyledger.llm.runtime import cut, small

FOLDS, FOLD = 4, 2
THRESHOLD = 0.7
#: Bins of scores per standard deviation, near the mean; wider ones far from it keep their number small.
BINS = 512
#: Newton steps, at most, and bins compared with all others at a time.
STEPS, BLOCK = 30, 256
#: Labelled rows of a task, about: every step is two jobs over all of them.
TASK_ROWS = 100_000

FEATURES = (
    "upper", "digit", "symbol", "stop", "non_ascii", "space", "newline", "word_length", "long_words", "one_byte_words",
    "shouted_words", "marked_words", "bare_marks", "repeated_words", "repeated_pairs", "capital_after_stop",
    "upper_sqrt", "symbol_sqrt", "marked_sqrt", "bare_sqrt", "shouted_sqrt",
)

#: Added to a text's length when shares are taken.
SHORT_BYTES, SHORT_WORDS = 40, 8

_SYMBOLS = b"!#$%&*+/<=>@[\\]^_{|}~"
_STOPS = b".?!"


def _share(count: np.ndarray, of: np.ndarray, more: int = 0) -> np.ndarray:
    """``more`` keeps the shares of marks in very short texts from being large by one mark."""
    return count / np.maximum(of + more, 1)


def features(words: Words, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of FEATURES per text of a chunk; zeros for a text without words."""
    rows = len(offsets) - 1
    length = np.diff(offsets)
    kinds = np.zeros((6, 256), bool)
    kinds[0, 65:91] = True
    kinds[1, 48:58] = True
    kinds[2, list(_SYMBOLS)] = True
    kinds[3, list(_STOPS)] = True
    kinds[4, 128:] = True
    kinds[5, 10] = True
    totals = []
    for kind in kinds:
        sums = np.r_[0, np.cumsum(kind[data])]
        totals.append(sums[offsets[1:]] - sums[offsets[:-1]])
    upper, digit, symbol, stop, high, newline = totals

    begin, end, row = words.spans(data, offsets)
    n = np.bincount(row, minlength=rows)
    count = lambda mask: np.bincount(row, weights=mask, minlength=rows)
    size = end - begin
    symbol_sum = np.r_[0, np.cumsum(kinds[2][data])]
    upper_sum = np.r_[0, np.cumsum(kinds[0][data])]
    lower = np.r_[0, np.cumsum((data >= 97) & (data < 123))]
    symbols, uppers = symbol_sum[end] - symbol_sum[begin], upper_sum[end] - upper_sum[begin]
    lowers = lower[end] - lower[begin]
    shouted = (uppers >= 2) & (lowers == 0)
    marked = (symbols >= 2) & (size > symbols)
    bare = symbols == size
    hashes = words.hashes(data, begin, end)
    # distinct words, and pairs of words seen before in the same text
    key = hashes ^ (row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, where = np.unique(key, return_index=True)
    distinct = np.bincount(row[where], minlength=rows)
    pair = np.flatnonzero(row[:-1] == row[1:]) if len(row) else np.zeros(0, np.int64)
    pairs = np.bincount(row[pair], minlength=rows)
    _, where = np.unique(key[pair] * np.uint64(3) + hashes[pair + 1] if len(pair) else np.zeros(0, np.uint64), return_index=True)
    fresh = np.bincount(row[pair][where], minlength=rows)
    ends_sentence = kinds[3][data[end - 1]] if len(end) else np.zeros(0, bool)
    first_upper = kinds[0][data[begin]] if len(begin) else np.zeros(0, bool)
    follows = np.r_[False, ends_sentence[:-1] & (row[:-1] == row[1:])] if len(row) else np.zeros(0, bool)

    in_bytes = lambda count: _share(count, length, SHORT_BYTES)
    in_words = lambda mask: _share(count(mask), n, SHORT_WORDS)
    s = {
        "upper": in_bytes(upper), "digit": in_bytes(digit), "symbol": in_bytes(symbol), "non_ascii": _share(high, length),
        "stop": _share(stop, n, SHORT_WORDS), "newline": _share(newline, n, SHORT_WORDS),
        "space": in_bytes(length - count(size)), "word_length": np.minimum(_share(count(size), n), 50) / 10,
        "long_words": in_words(size > 20), "one_byte_words": in_words(size == 1), "shouted_words": in_words(shouted),
        "marked_words": in_words(marked), "bare_marks": in_words(bare), "repeated_words": _share(n - distinct, n, SHORT_WORDS),
        "repeated_pairs": _share(pairs - fresh, pairs, SHORT_WORDS),
        "capital_after_stop": _share(count(follows & first_upper), np.maximum(count(follows), 1)),
    }
    for name, of in (("upper", "upper"), ("symbol", "symbol"), ("marked", "marked_words"), ("bare", "bare_marks"), ("shouted", "shouted_words")):
        s[f"{name}_sqrt"] = np.sqrt(s[of])
    return np.where((n > 0)[:, None], np.stack([s[f] for f in FEATURES], axis=1), 0.0)


def with_features(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, x): the features of every row."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            parts = [features(words, data, offsets) for _, data, offsets in chunks(batch.column(1))]
            x = np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)))
            offsets = np.arange(len(x) + 1, dtype=np.int32) * len(FEATURES)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(x.ravel()))], ["doc_id", "x"]
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), text_col).mapInArrow(compute, f"doc_id {kind}, x array<double>")


@dataclass
class Ranking:
    """score(x) = 1 / (1 + exp(-(weights . x + bias)))"""

    weights: np.ndarray
    bias: float


class Rows(Protocol):
    """Labelled rows of standardized features z."""

    def classes(self, w: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """(numbers of rows, sums of z) of groups of like score ``w . z``, for good and for bad rows."""

    def squares(self, w: np.ndarray, good: tuple[np.ndarray, np.ndarray], bad: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Sum of z z' over all rows, weighted by the row's score: linear between (scores, weights) of its class."""


class Arrays:
    """Rows in memory; every row is a group."""

    def __init__(self, z: np.ndarray, label: np.ndarray):
        self.z, self.label = z, label

    def classes(self, w):
        return tuple((np.ones((self.label == k).sum()), self.z[self.label == k]) for k in (1, 0))

    def squares(self, w, good, bad):
        return weighted_squares(self.z, self.label, w, good, bad)


class Table:
    """Rows of (label, x) in a table. Groups are bins of scores, several thousand at most."""

    def __init__(self, rows: DataFrame, n: int, mean: np.ndarray, scale: np.ndarray):
        z = [((F.get("x", F.lit(i)) - F.lit(float(m))) * F.lit(float(s))).alias(f"z{i}") for i, (m, s) in enumerate(zip(mean, scale, strict=True))]
        self.z = [f"z{i}" for i in range(len(z))]
        self.rows = rows.select("label", *z)
        flat = np.array([-1.0, 1.0]), np.ones(2)
        self.spread = self.squares(np.zeros(len(z)), flat, flat) / n

    def width(self, w: np.ndarray) -> float:
        """Standard deviation of the scores."""
        return float(np.sqrt(max(0.0, w @ self.spread @ w)))

    def classes(self, w):
        score = sum((F.col(z) * F.lit(float(v)) for z, v in zip(self.z, w, strict=True)), F.lit(0.0))
        grouped = self.rows.groupBy("label", bin_of(score, self.width(w)).alias("bin"))
        table = grouped.agg(F.count(F.lit(1)).alias("n"), *[F.sum(z).alias(z) for z in self.z]).toArrow()
        label, n = table["label"].to_numpy(), table["n"].to_numpy().astype(float)
        sums = np.stack([table[z].to_numpy() for z in self.z], axis=1)
        return tuple((n[label == k], sums[label == k]) for k in (1, 0))

    def squares(self, w, good, bad):
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((len(w), len(w)))
            for batch in batches:
                z = np.stack([c.to_numpy() for c in batch.columns[1:]], axis=1)
                total += weighted_squares(z, batch.column(0).to_numpy(), w, good, bad)
            yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()])], ["total"])

        parts = self.rows.mapInArrow(add, "total array<double>").collect()  # one matrix a task
        return np.sum([r.total for r in parts], axis=0).reshape(len(w), len(w))


def bin_of(score: Column, width: float) -> Column:
    """Number of the bin of a score; ``width`` is the standard deviation of the scores, their mean is 0."""
    return F.floor(F.asinh(score / F.lit(max(width, 1e-9))) * BINS)


def weighted_squares(z: np.ndarray, label: np.ndarray, w: np.ndarray, good: tuple[np.ndarray, np.ndarray], bad: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    score = z @ w
    weight = np.where(label == 1, np.interp(score, *good), np.interp(score, *bad))
    return (z * weight[:, None]).T @ z


def bradley_terry(rows: Rows, size: int, penalty: float = 1e-3) -> np.ndarray:
    """Weights from preferences of all good rows over all bad ones, by Newton steps on the logistic loss of differences."""
    w, before, step, least = np.zeros(size), np.zeros(size), np.zeros(size), np.inf
    for _ in range(STEPS):
        (n_good, s_good), (n_bad, s_bad) = rows.classes(w)
        at_good, at_bad = s_good @ w / n_good, s_bad @ w / n_bad
        pairs = n_good.sum() * n_bad.sum()
        loss, gradient, cross = 0.0, np.zeros(size), np.zeros((size, size))
        c_good, c_bad = np.zeros(len(n_good)), np.zeros(len(n_bad))
        for first in range(0, len(n_good), BLOCK):
            part = slice(first, first + BLOCK)
            gap = np.clip(at_good[part, None] - at_bad, -30, 30)
            lose = 1 / (1 + np.exp(gap))
            loss += n_good[part] @ np.logaddexp(0, -gap) @ n_bad
            gradient += (lose @ n_bad) @ s_good[part] - (n_good[part] @ lose) @ s_bad
            lose *= 1 - lose
            c_good[part] = lose @ n_bad
            c_bad += n_good[part] @ lose
            cross += s_good[part].T @ lose @ s_bad
        loss = loss / pairs + penalty / 2 * w @ w
        if loss > least + 1e-6:  # too long a step
            step = step / 2
            w = before + step
            continue
        up_good, up_bad = np.argsort(at_good), np.argsort(at_bad)
        squares = rows.squares(w, (at_good[up_good], c_good[up_good]), (at_bad[up_bad], c_bad[up_bad]))
        curvature = (squares - cross - cross.T) / pairs + penalty * np.eye(size)
        step = np.linalg.solve(curvature, gradient / pairs - penalty * w)
        before, least, w = w, loss, w + step
        if np.abs(step).max() < 1e-5:
            break
    return w


def best_cut(ranges: Sequence[tuple[float, int, int, float, float | None]]) -> float:
    """The lowest of the cuts with fewest errors, halfway between two scores, or 1 beyond all.

    ``ranges`` of scores in ascending order: (lowest score; good less bad rows in all; the least of good less bad rows up to
    and with a score of the range; that score, the lowest if several; the next score in the range).
    """
    at, least, before = ranges[0][0] - 1.0, 0, 0
    for i, (_, total, level, score, after) in enumerate(ranges):
        if before + level < least:
            least = before + level
            if after is None and i + 1 < len(ranges):
                after = ranges[i + 1][0]
            at = score + 1.0 if after is None else (score + after) / 2
        before += total
    return at


def one_label(size: int, good: bool, threshold: float = THRESHOLD) -> Ranking:
    """Nothing to compare: all rows score like the one label, or as good without any."""
    return Ranking(np.zeros(size), float(np.log(threshold / (1 - threshold))) + (1.0 if good else -1.0))


def learn(x: np.ndarray, label: np.ndarray, threshold: float = THRESHOLD) -> Ranking:
    """``fit`` for rows in memory, each compared by itself with all of the other label."""
    if len(x) == 0 or label.min() == label.max():
        return one_label(x.shape[1] if x.ndim == 2 else len(FEATURES), not (len(label) and label[0] == 0), threshold)
    scale = scale_of(x.std(0))
    w = bradley_terry(Arrays((x - x.mean(0)) * scale, label), x.shape[1]) * scale
    scores, place = np.unique(x @ w, return_inverse=True)
    gain = np.bincount(place, weights=2 * label - 1)
    at = best_cut([(s, g, g, s, None) for s, g in zip(scores.tolist(), gain.tolist(), strict=True)])
    return Ranking(w, float(np.log(threshold / (1 - threshold))) - at)


def scale_of(spread: np.ndarray) -> np.ndarray:
    return np.where(spread > 1e-9, 1 / np.maximum(spread, 1e-9), 0.0)


def strength(weights: np.ndarray, bias: float = 0.0) -> Column:
    """weights . x + bias"""
    total = F.lit(float(bias))
    for i, w in enumerate(weights):
        total = total + F.get("x", F.lit(i)) * F.lit(float(w))
    return total


def fit(
    featured: DataFrame, labels: DataFrame, folds: int = FOLDS, fold: int = FOLD, label_col: str = "quality", threshold: float = THRESHOLD
) -> Ranking:
    """Learns from all labelled rows outside the held-out fold: weights, and the bias that puts the best cut at ``threshold``.

    An id counts once; of several feature lists of one id the smallest is taken.
    """
    known = small(cut(training_labels(labels, label_col, folds, fold, rows=1 << 62)))
    rows = cut(featured.join(known, "doc_id").groupBy("doc_id").agg(F.min("x").alias("x"), F.first("label").alias("label")).select("label", "x"))
    size = len(FEATURES)
    each = [F.get("x", F.lit(i)) for i in range(size)]
    n, good, *stats = rows.agg(F.count(F.lit(1)), F.sum("label"), *map(F.avg, each), *map(F.stddev_pop, each)).first()
    if not n or good in (0, n):
        return one_label(size, not (n and good == 0), threshold)
    mean, scale = np.array(stats[:size]), scale_of(np.array(stats[size:]))
    rows = rows.coalesce(-(-n // TASK_ROWS))
    table = Table(rows, n, mean, scale)
    w = bradley_terry(table, size)
    own = w * scale
    scores = rows.select(strength(own).alias("score"), (2 * F.col("label") - 1).alias("gain"))
    bins = scores.withColumn("bin", bin_of(F.col("score") - F.lit(float(own @ mean)), table.width(w)))
    ascending = Window.partitionBy("bin").orderBy("score")
    steps = bins.groupBy("bin", "score").agg(F.sum("gain").alias("gain")).select(
        "bin", "score", F.sum("gain").over(ascending).alias("level"), F.lead("score").over(ascending).alias("after")
    )
    ranges = steps.groupBy("bin").agg(
        F.min("score").alias("lowest"), F.max_by("level", "score").alias("total"), F.min(F.struct("level", "score", "after")).alias("least")
    )
    at = best_cut(sorted(tuple(r) for r in ranges.select("lowest", "total", "least.*").collect()))
    return Ranking(own, float(np.log(threshold / (1 - threshold))) - at)


def scored(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    An empty or NULL text has all features 0. A NULL id is held out. Equal texts score alike. Without labels, or with one
    label only, all rows get the same score. An empty table gives an empty result. Other columns are not read.
    """
    featured = cut(with_features(docs, id_col, text_col))
    model = fit(featured, labels)
    score = F.lit(1.0) / (F.lit(1.0) + F.exp(-strength(model.weights, model.bias)))
    return featured.select(
        F.col("doc_id").alias(id_col), held_out("doc_id", FOLDS, FOLD).alias("held_out"), score.alias("score"),
        (score >= threshold).cast("int").alias("predicted"),
    )
