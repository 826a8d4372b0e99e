"""Quality and toxicity: held-out accuracy, no leak of labels or metadata into scores, and odd inputs."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm_tables import SMALL, documents  # noqa: F401

from tidyledger.llm import quality, toxicity
from tidyledger.llm.toxicity import Automaton, Matcher, allowed_edits

SF = f"{SMALL}/../sf0.1"


def tables(spark, sf=SF):
    return spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")


@pytest.mark.parametrize(("module", "label", "folds", "fold", "least"), [(quality, "quality", 4, 2, 0.95), (toxicity, "toxic", 3, 1, 0.85)])
def test_held_out_accuracy_and_leaks(spark, module, label, folds, fold, least):
    docs, labels = tables(spark)
    rows = {r.doc_id: r for r in module.scored(docs, labels).collect()}
    assert len(rows) == docs.count()
    for doc_id, r in rows.items():
        assert r.held_out == (zlib.crc32(str(doc_id).encode()) % folds == fold)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    truth = {r.doc_id: r[label] for r in labels.collect()}
    held = [(rows[d].predicted, y) for d, y in truth.items() if rows[d].held_out]
    # about one toxic document in ten of these tables holds no toxic word
    each = [np.mean([p == y for p, y in held if y == k]) for k in (0, 1)]
    assert min(each) >= least, each
    # labels of held-out rows, lang, source and doc_id are no inputs
    other = labels.selectExpr("doc_id", "quality", "toxic").rdd.map(
        lambda r: (r[0], 1 - r[1], 1 - r[2]) if zlib.crc32(str(r[0]).encode()) % folds == fold else tuple(r)
    ).toDF("doc_id bigint, quality int, toxic int")
    again = module.scored(docs.selectExpr("doc_id", "text", "'xx' as lang", "'yy' as source", "0 as n_chars"), other)
    assert {r.doc_id: r.score for r in again.collect()} == pytest.approx({d: r.score for d, r in rows.items()})


@pytest.mark.parametrize("module", [quality, toxicity])
def test_odd_rows(spark, documents, module):
    docs = documents((1, None), (2, ""), (3, " \n"), (4, "a"), (5, "word " * 60_000), (6, "x y."), (6, "x y."), (None, "x y."))
    _, labels = tables(spark, SMALL)
    wide = docs.selectExpr("*", "1 as x", "2 as hits", "3 as label", "4 as score", "5 as held_out")
    some = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (4, None, None), (None, 1, 1), (3, 1, 1), (3, 1, 1), (5, 0, 0)], "doc_id bigint, quality int, toxic int")
    for use in (labels, some, labels.filter("false")):
        rows = module.scored(wide, use).collect()
        assert len(rows) == 8 and all(0 <= r.score <= 1 and r.score == r.score for r in rows)
        assert len({r.score for r in rows if r.doc_id == 6 or r.doc_id is None}) == 1
        assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1
    assert module.scored(docs.filter("false"), labels).count() == 0


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_automaton_equals_edit_distance():
    terms = ("scum", "idiot", "moron", "worthless", "worth", "pathetic", "sâle", "vequ*", "lowei*", "achlich*")
    automaton, rng = Automaton(terms), np.random.default_rng(1)
    words = []
    for _ in range(4000):
        word = list(terms[rng.integers(len(terms))].replace("*", ("", "er", "isch")[rng.integers(3)]))
        for _ in range(rng.integers(0, 4)):
            at = rng.integers(0, len(word) + 1)
            kind = rng.integers(3)
            if kind == 0:
                word.insert(at, "abcdefghijklmnopqrstuvwxyzé"[rng.integers(27)])
            elif at < len(word):
                word[at : at + 1] = [] if kind == 1 else ["imtowrs"[rng.integers(7)]]
        words.append("".join(word))
    far = lambda w, t: min(distance(w[:n], t[:-1]) for n in range(len(w) + 1)) if t[-1] == "*" else distance(w, t)
    for word in words:
        want = min(((far(word, t), n) for n, t in enumerate(automaton.terms) if far(word, t) <= allowed_edits(t)), default=None)
        data = np.frombuffer(word.encode(), np.uint8)
        got = [(e, t) for _, t, e, _ in Matcher(automaton).hits(data, np.array([0, len(data)]))]
        assert got == ([want] if want else []), word


def matched(text: str) -> list[tuple[str, int, bool]]:
    automaton = Automaton(toxicity.LEXICON)
    data = np.frombuffer(text.encode(), np.uint8)
    return [(automaton.terms[t], e, q) for _, t, e, q in Matcher(automaton).hits(data, np.array([0, len(data)]))]


def test_hits_and_context():
    assert matched("Such an IDIOT, such scum!") == [("idiot", 0, False), ("scum", 0, False)]
    assert matched("an 1d10t and a m0ron$$$") == [("idiot", 0, False), ("moron", 0, False)]
    assert matched("idoit iidiot idit worthles wrthlss scums") == [("idiot", 1, False)] * 2 + [("worthless", 1, False), ("worthless", 2, False)]
    assert matched('the word "idiot" is old') == [("idiot", 0, True)]
    assert matched("you said idiot") == [("idiot", 0, False)]
    assert matched("they wrote that a moron came") == [("moron", 0, True)]
    assert matched("") == matched("clean text here") == []


def test_bradley_terry_ranks_good_before_bad():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3))
    label = (x[:, 0] - 2 * x[:, 1] > 0).astype(int)
    model = quality.learn(x, label)
    score = 1 / (1 + np.exp(-(x @ model.weights + model.bias)))
    assert ((score >= 0.7) == label).mean() > 0.97


def test_quality_learns_from_all_labelled_rows_and_pairs(spark):
    rng, n = np.random.default_rng(3), 30_000
    x = rng.random((n, len(quality.FEATURES))) * np.r_[1e-3, 5.0, np.ones(len(quality.FEATURES) - 2)]
    x[:2000] = x[rng.integers(2000, 2020, 2000)]  # copies: equal scores
    x[:, 7] = 0.3
    label = (x[:, 2] + x[:, 3] - x[:, 4] + rng.normal(0, 0.3, n) > -0.4).astype(np.int32)
    ids = np.arange(n)
    featured = spark.createDataFrame(pa.table({"doc_id": ids, "x": list(x)})).repartition(7)
    labels = spark.createDataFrame(pa.table({"doc_id": ids, "quality": label})).repartition(3)
    model = quality.fit(featured, labels)
    known = np.array([zlib.crc32(str(i).encode()) % 4 != 2 for i in ids])
    x, label = x[known], label[known]
    assert len(x) > 22_000 and 500 < (label == 0).sum() < 2_000
    # the loss over all pairs is least at the weights: its gradient is zero
    spread = np.where(x.std(0) > 1e-9, x.std(0), np.inf)
    z = (x - x.mean(0)) / spread
    w = model.weights * np.where(np.isfinite(spread), spread, 0)
    good, bad = z[label == 1], z[label == 0]
    gradient = np.zeros(len(w))
    for b in bad:
        lose = 1 / (1 + np.exp((good - b) @ w))
        gradient += lose @ good - lose.sum() * b
    gradient = gradient / len(good) / len(bad) - 1e-3 * w
    assert np.abs(gradient).max() < 1e-5
    # no cut has fewer errors over all rows, and the lowest of those that have as few is taken
    score = x @ model.weights
    above = np.searchsorted(np.sort(score[label == 0]), cuts := (np.unique(score)[1:] + np.unique(score)[:-1]) / 2)
    wrong = (label == 0).sum() - above + np.searchsorted(np.sort(score[label == 1]), cuts)
    assert np.log(0.7 / 0.3) - model.bias == pytest.approx(cuts[wrong.argmin()])


def test_cuts_beyond_all_scores():
    assert quality.best_cut([(2.0, 3, 1, 2.0, 2.5), (4.0, 1, 1, 4.0, None)]) == 1.0  # all good
    assert quality.best_cut([(2.0, -3, -3, 2.5, None), (4.0, -1, -1, 4.0, None)]) == 5.0  # all bad
    assert quality.best_cut([(2.0, -1, -2, 2.0, 2.5), (4.0, -1, -1, 4.0, None)]) == 2.25  # as few errors as above all: the lowest
    assert quality.best_cut([(2.0, -3, -3, 2.5, None), (4.0, 1, 1, 4.0, None)]) == 3.25
