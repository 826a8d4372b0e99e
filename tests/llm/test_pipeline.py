"""The pipeline against a plain version of its stages, and its stages on odd inputs."""

from __future__ import annotations

from collections import Counter

from llm_tables import SMALL, documents  # noqa: F401

import corpus_pipeline
from tidyledger.llm.decontaminate import shingle_set
from tidyledger.llm.mixing import mixed


def test_stages_on_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "ngram_jaccard_join", "benchmark_decontamination", "mixing", "sharding"]
    stage = dict(corpus_pipeline.STAGES)

    kept = stage["language_id"](spark, docs, SMALL)
    assert kept.columns == docs.columns and kept.count() == docs.count()  # all documents have a language

    sets = {r.doc_id: shingle_set(r.text) for r in kept.collect()}
    single = stage["ngram_jaccard_join"](spark, kept, SMALL)
    stay = {r.doc_id for r in single.collect()}
    label = {d: d for d in sets}

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                label[max(find(i), find(j))] = min(find(i), find(j))
    assert single.columns == docs.columns and stay == {d for d in ids if find(d) == d} and len(stay) < len(ids)

    clean = stage["benchmark_decontamination"](spark, single, SMALL)
    items = [shingle_set(r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    leaked = {d for d in stay if any(100 * len(i & sets[d]) >= 80 * len(i) for i in items)}
    assert leaked and clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == stay - leaked

    mixture = stage["mixing"](spark, clean, SMALL)
    want = Counter({r.row.doc_id: r.copies for r in mixed(clean).collect() if r.copies})
    assert mixture.columns == docs.columns and Counter(r.doc_id for r in mixture.collect()) == want

    placed = stage["sharding"](spark, mixture, SMALL)
    assert placed.columns == [*docs.columns, "slot", "shard"] and Counter(r.doc_id for r in placed.collect()) == want
    whole = corpus_pipeline.run(spark, SMALL)
    assert Counter(map(tuple, whole.collect())) == Counter(map(tuple, placed.collect()))


def test_odd_rows(spark, documents):
    words = "the and of to in is that for with as it"
    docs = documents(
        (1, words), (1, words), (None, words), (None, None), (2, ""), (None, words + " x y z a b c"), (None, words + " x y z a b c"), (3, words + " q r s t u v w"),
    )
    stage = dict(corpus_pipeline.STAGES)
    left = stage["language_id"](spark, docs, SMALL)
    assert left.count() == 6 and left.columns == docs.columns  # the two without letters go
    single = stage["ngram_jaccard_join"](spark, docs, SMALL)
    got = Counter((r.doc_id, r.text) for r in single.collect())
    assert got == Counter([(1, words), (None, None), (2, ""), (None, words + " x y z a b c"), (3, words + " q r s t u v w")])
    for name, function in corpus_pipeline.STAGES:
        assert function(spark, docs.filter("false"), SMALL).count() == 0, name


def test_leaks_go_by_row_not_by_id(spark, documents):
    item = spark.read.parquet(f"{SMALL}/benchmark.parquet").first().text
    docs = documents((None, item), (None, "a b c d e f"), (7, item), (7, "g h i j k l"), (8, f"x {item} y"), (9, None))
    clean = dict(corpus_pipeline.STAGES)["benchmark_decontamination"](spark, docs, SMALL)
    assert clean.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in clean.collect()) == Counter([(None, "a b c d e f"), (7, "g h i j k l"), (9, None)])


def test_rows_that_share_an_id_are_decided_by_their_texts(spark, documents):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcd")
    docs = documents((1, a), (5, f"{a} z"), (5, b), (6, c), (6, d), (6, d), (7, f"{d} z"))
    single = dict(corpus_pipeline.STAGES)["ngram_jaccard_join"](spark, docs, SMALL)
    assert Counter((r.doc_id, r.text) for r in single.collect()) == Counter([(1, a), (5, b), (6, c), (6, d)])
