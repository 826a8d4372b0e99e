"""Language ID: accuracy against the labels, what each kind of evidence does, and odd inputs."""

from __future__ import annotations

import numpy as np
import pytest
from llm_tables import SMALL, documents  # noqa: F401

from tidyledger.llm.langid import accepted, document_evidence, fit, identify, page_evidence, trigrams
from tidyledger.llm.queries import op10_language_id

SF = f"{SMALL}/../sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def model(docs):
    return fit(docs)


def evidence(spark, *rows):
    return spark.createDataFrame(list(rows), "id bigint, _text string, _declared string, _suffix string, _host string")


def test_documents_and_pages(spark, docs):
    rows = op10_language_id(spark, SF).collect()
    truth = {r.doc_id: r.lang for r in docs.collect()}
    got = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert got.keys() == truth.keys()
    assert sum(got[d].lang == truth[d] for d in truth) >= 0.98 * len(truth)
    assert all(r.accepted for r in got.values())
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    of_page = {r.page_id: r.lang for r in rows if r.page_id is not None}
    assert of_page.keys() == pages.keys()
    declared = {p: r.html.split('lang="')[1][:2] for p, r in pages.items()}
    assert sum(of_page[p] == declared[p] for p in pages) >= 0.95 * len(pages)


def test_held_out_accuracy(spark, docs):
    fitted = fit(docs.filter("doc_id % 2 = 0"))
    rest = docs.filter("doc_id % 2 = 1")
    got = {r.doc_id: r.lang for r in identify(document_evidence(rest), fitted).collect()}
    assert sum(got[r.doc_id] == r.lang for r in rest.collect()) >= 0.98 * rest.count()


def test_other_evidence_decides_where_the_text_does_not(spark, docs, model):
    text = {r.lang: r.text for r in docs.filter("n_chars > 2000").collect()}
    rows = [(i, text["de"], "de", "net", "a.x.net") for i in range(30)] + [(i, text["fr"], "fr", "org", "b.y.org") for i in range(30, 60)]
    # a text that says as little as possible between the four
    logp = {c: model.logp[trigrams(np.frombuffer(c.encode(), np.uint8), np.array([0, 1]))[0][0], :4] for c in "abcdefghijklmnopqrstuvwxyz"}
    e = min(logp, key=lambda c: np.ptp(logp[c]))
    rows += [(100, e, None, None, "a.x.net"), (101, e, None, None, "b.y.org"), (102, e, "fr", None, None), (103, e, "de", None, None)]
    rows += [(104, e, None, "net", "new.x.net"), (105, e, None, "org", None)]
    got = {r.id: r.lang for r in identify(evidence(spark, *rows), model).collect()}
    assert [got[i] for i in range(100, 106)] == ["de", "fr", "fr", "de", "de", "fr"]


def test_odd_rows(spark, model):
    noise = "".join(chr(0x4E00 + (i * 7919) % 20000) for i in range(4000))
    rows = [(1, None, None, None, None), (2, "", "de", "de", "h"), (3, "123 !!", None, None, None), (4, noise, None, None, None), (4, noise, None, None, None)]
    got = identify(evidence(spark, *rows).selectExpr("*", "1 as lang_", "2 as n"), model).collect()
    assert [(r.lang, r.accepted) for r in got] == [("und", False)] * 5
    assert all(r.confidence == 1.0 for r in got if r.id < 4)
    assert identify(evidence(spark, *rows).filter("false"), model).count() == 0


def test_without_labels(spark, documents):
    docs = documents((1, "a b", None), (2, None, None))
    none = fit(docs)
    assert none.languages == []
    assert [r.accepted for r in identify(document_evidence(docs), none).collect()] == [False, False]


def test_stage_keeps_all_that_has_a_language(spark, docs):
    odd = docs.limit(1).selectExpr("-1L as doc_id", "'' as text", "lang", "source", "n_chars")
    kept = accepted(docs.unionByName(odd))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in docs.collect())


def test_page_evidence(spark):
    html = '<!DOCTYPE html><HTML class="a" lang="DE-at"><style>p{}</style><body>Gu<b>ten</b><!-- x --><script>var a="</p>";</script> Tag</body>'
    rows = spark.createDataFrame([(1, "https://A.b.Example.at:80/x", html), (2, None, None), (3, "x", "plain")], "page_id bigint, url string, html string")
    got = {r.page_id: r for r in page_evidence(rows).collect()}
    assert got[1]._declared == "de" and got[1]._suffix == "at" and got[1]._host == "a.b.example.at" and got[1]._text.split() == ["Gu", "ten", "Tag"]
    assert tuple(got[2])[1:] == (None, None, None, None)
    assert (got[3]._text, got[3]._declared, got[3]._host) == ("plain", None, None)


def test_too_many_labels_are_refused(spark, documents):
    with pytest.raises(ValueError, match="more than 256"):
        fit(documents(*[(i, "a", f"l{i}") for i in range(300)]))


def test_what_is_rejected_does_not_depend_on_the_size_of_the_corpus(spark, docs):
    english = docs.filter("lang = 'en' and n_chars between 200 and 2000").orderBy("doc_id").limit(30)
    one, many = fit(english), fit(english.crossJoin(spark.range(1000)))
    assert np.allclose(one.logp, many.logp)
    foreign = "Зачем же вы так поздно пришли сегодня к нам домой, мы давно вас ждём и уже сели ужинать без вас. "
    rows = []
    for i, r in enumerate(english.collect()):
        strange = (foreign * 40).encode()[: len(r.text.encode())].decode(errors="ignore")
        rows += [(i, r.text + strange[: len(strange) // 3], None, None, None), (100 + i, strange, None, None, None)]
    for model in (one, many):
        got = {r.id: r.accepted for r in identify(evidence(spark, *rows), model).collect()}
        assert all(got[i] == (i < 100) for i in got)
