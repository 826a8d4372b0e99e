"""Language ID by Bayesian fusion of evidence.

For every row and language l the log posterior is the sum of

* the text's likelihood: mean log probability of its byte trigrams, worth at most EVIDENCE trigrams because neighbouring
  trigrams are not independent;
* log P(declared markup language | l) and log P(address suffix | l);
* log P(l | host): host counts smoothed towards the parent domain's, and those towards the counts of all rows.

The last three come from grouped sums of the text's own posteriors over all rows. A further class, ``und``, gives every
trigram the same probability: a text that no known language explains better, or that has no letters, is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidyledger.llm.grams import chunks
from tidyledger.llm.runtime import cut, small, unused

BUCKETS = 1 << 16
LANGUAGES = 256
EVIDENCE = 100.0
KAPPA = 10.0
UNKNOWN = "und"
#: Prior probability of ``und``.
UNKNOWN_PRIOR = 1e-3
#: Share of the uniform distribution in each language: an unseen trigram costs the same whatever the size of the corpus,
#: log(20) more than under ``und``, so a single one does not outweigh the other evidence.
UNSEEN = 0.05

_TAGS = r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>"
_DECLARED = r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]+)"


def trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of every byte trigram whose middle is a letter (A-Z as a-z) or part of a non-ASCII character."""
    table = np.arange(256, dtype=np.uint32)
    table[65:91] += 32
    table[[c for c in range(128) if not (65 <= c < 91 or 97 <= c < 123)]] = 32
    codes = table[data]
    before, after = np.r_[np.uint32(32), codes[:-1]], np.r_[codes[1:], np.uint32(32)]
    inner = offsets[(offsets > 0) & (offsets < len(codes))]
    before[inner], after[inner - 1] = 32, 32
    at = np.flatnonzero(codes != 32)
    value = (before[at] << np.uint32(16)) | (codes[at] << np.uint32(8)) | after[at]
    bucket = (value * np.uint32(2654435761)) >> np.uint32(16)
    return bucket, np.searchsorted(offsets, at, side="right") - 1


@dataclass
class Model:
    """Languages, and log probabilities by bucket: one column per language and one for ``und``."""

    languages: list[str]
    logp: np.ndarray


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Trigram counts per label over all rows with a label; each task sums its own before they are shuffled.

    The result has BUCKETS numbers per language; more than LANGUAGES labels are refused. Rows without label or letters say
    nothing.
    """
    if docs.filter(F.col(lang_col).isNotNull()).select(lang_col).distinct().limit(LANGUAGES + 1).count() > LANGUAGES:
        raise ValueError(f"{lang_col} holds more than {LANGUAGES} languages")
    labelled = docs.filter(F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string"), F.col(text_col).cast("string"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, number = np.unique(np.array(batch.column(0).to_pylist(), object), return_inverse=True)
            for row, data, offsets in chunks(batch.column(1)):
                bucket, owner = trigrams(data, offsets)
                own = number[row : row + len(offsets) - 1][owner] * BUCKETS + bucket
                found = np.bincount(own, minlength=len(langs) * BUCKETS).reshape(len(langs), BUCKETS)
                for lang, n in zip(langs, found, strict=True):
                    sums[lang] = sums.get(lang, 0) + n
        for lang, n in sums.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(n[at].astype(np.int64))],
                ["lang", "bucket", "n"],
            )

    counted = labelled.mapInArrow(count, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = counted.toArrow()
    names = np.array(table["lang"].to_pylist(), object)
    languages = sorted(set(names))
    counts = np.zeros((BUCKETS, len(languages)))
    if languages:
        counts[table["bucket"].to_numpy(), np.searchsorted(languages, names)] = table["n"].to_numpy()
    return Model([str(x) for x in languages], np.c_[_log_shares(counts), np.full(BUCKETS, -np.log(BUCKETS))].astype(np.float32))


def _log_shares(counts: np.ndarray) -> np.ndarray:
    """Log probabilities from counts by bucket, one column per language; the same for counts in proportion."""
    return np.log((1 - UNSEEN) * counts / counts.sum(0) + UNSEEN / BUCKETS)


def _likelihoods(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` (…, _text last) with _text replaced by _ll, the evidence of each class; NULL without letters."""
    shared = rows.sparkSession.sparkContext.broadcast(np.ascontiguousarray(model.logp.T))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logp = shared.value
        for batch in batches:
            parts = []
            for _, data, offsets in chunks(batch.column(batch.num_columns - 1)):
                bucket, owner = trigrams(data, offsets)
                n = np.bincount(owner, minlength=len(offsets) - 1)
                sums = np.zeros((len(n), len(logp)))
                full = np.flatnonzero(n)
                if len(full):
                    first = np.r_[0, np.cumsum(n)][full]
                    for i, own in enumerate(logp):  # one class at a time keeps the chunk small
                        sums[full, i] = np.add.reduceat(own[bucket], first, dtype=np.float64)
                parts.append(np.where(n[:, None] > 0, sums * np.minimum(1.0, EVIDENCE / np.maximum(n, 1))[:, None], np.nan))
            scores = np.concatenate(parts) if parts else np.zeros((0, len(logp)))
            empty = np.isnan(scores).any(1)
            offsets = np.arange(len(scores) + 1, dtype=np.int32) * scores.shape[1]
            lists = pa.ListArray.from_arrays(pa.array(offsets, mask=np.r_[empty, False]), pa.array(scores.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], lists], [*batch.schema.names[:-1], "_ll"])

    kept = [f for f in rows.schema.fields if f.name != "_text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return rows.select(*[f"`{f.name}`" for f in kept], "_text").mapInArrow(score, f"{schema}, _ll array<double>")


def _posterior(logs: Column) -> Column:
    """Probabilities from an array of log weights."""
    exps = F.transform(logs, lambda x: F.exp(x - F.array_max(logs)))
    return F.transform(exps, lambda x: x / F.aggregate(exps, F.lit(0.0), lambda a, b: a + b))


def identify(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` without _text, _declared, _suffix and _host, with lang, confidence and accepted.

    _text, _declared, _suffix and _host are strings; NULL evidence says nothing, except that a NULL host has the counts
    of all rows. A row is accepted unless its class is ``und``. A text without letters (empty, NULL) is ``und`` with
    confidence 1, whatever else is declared. Ties go to the language that sorts first. Equal rows get equal results;
    each counts in the sums. Without languages in the model every row is ``und``. An empty table gives an empty result.
    """
    own = [c for c in rows.columns if c not in ("_text", "_declared", "_suffix", "_host")]
    n = len(model.languages)
    if n == 0:
        return rows.select(*own, F.lit(UNKNOWN).alias("lang"), F.lit(1.0).alias("confidence"), F.lit(False).alias("accepted"))
    classes = [*model.languages, UNKNOWN]
    flat = F.array(*[F.lit(float(np.log((1 - UNKNOWN_PRIOR) / n)))] * n, F.lit(float(np.log(UNKNOWN_PRIOR))))
    add = lambda x, y: F.zip_with(x, y, lambda a, b: a + b)
    first = cut(_likelihoods(rows, model).withColumn("_p", _posterior(add(F.col("_ll"), flat))))

    sums = [F.sum(F.get("_p", F.lit(i))).alias(f"s{i}") for i in range(n + 1)]
    counted = lambda key: first.filter(F.col("_p").isNotNull() & key.isNotNull()).groupBy(key.alias("_key")).agg(*sums)
    held = F.array(*[F.col(f"s{i}") for i in range(n + 1)])
    total = first.agg(*sums).first()
    every = [float(x or 0.0) for x in total]
    base = [(x + 1.0) / (sum(every) + n + 1) for x in every]

    def evidence(column: str, name: str) -> DataFrame:
        """log P(value | class) per value, smoothed by how common the value is."""
        values = cut(counted(F.col(column)))
        share = values.select("_key", held.alias("h"), (F.aggregate(held, F.lit(0.0), lambda a, b: a + b) / F.lit(max(sum(every), 1.0))).alias("q"))
        logs = F.transform("h", lambda x, i: F.log((x + KAPPA * F.col("q") + 1e-9) / (F.get(F.array(*map(F.lit, every)), i) + KAPPA)))
        return small(cut(share.select(F.col("_key").alias(column), logs.alias(name))))

    domain = F.regexp_extract("_host", r"([^.]+\.[^.]+)$", 1)
    smooth = lambda h, prior: F.zip_with(
        F.transform(h, lambda x: x / (F.aggregate(h, F.lit(0.0), lambda a, b: a + b) + KAPPA)),
        F.transform(prior, lambda x: x * KAPPA / (F.aggregate(h, F.lit(0.0), lambda a, b: a + b) + KAPPA)),
        lambda a, b: a + b,
    )
    top = F.array(*map(F.lit, base))
    domains = counted(domain).select(F.col("_key").alias("_domain"), smooth(held, top).alias("dp"))
    hosts = counted(F.col("_host")).select(F.col("_key").alias("_host"), held.alias("h"), F.regexp_extract("_key", r"([^.]+\.[^.]+)$", 1).alias("_domain"))
    priors = hosts.join(domains, "_domain", "left").select("_host", smooth(F.col("h"), F.coalesce("dp", top)).alias("_prior"))
    priors = small(cut(priors))

    logged = F.transform(F.coalesce("_prior", top), lambda x: F.log(x))
    zero = F.array(*[F.lit(0.0)] * (n + 1))
    joined = first.join(evidence("_declared", "_d"), "_declared", "left").join(evidence("_suffix", "_s"), "_suffix", "left").join(priors, "_host", "left")
    fused = add(add(F.col("_ll"), logged), add(F.coalesce("_d", zero), F.coalesce("_s", zero)))
    final = joined.withColumn("_q", _posterior(fused))
    best = F.array_max("_q")
    lang = F.when(F.col("_q").isNull(), F.lit(UNKNOWN)).otherwise(
        F.element_at(F.array(*map(F.lit, classes)), F.array_position("_q", best).cast("int"))
    )
    return final.select(*own, lang.alias("lang"), F.coalesce(best, F.lit(1.0)).alias("confidence")).withColumn("accepted", F.col("lang") != UNKNOWN)


def page_evidence(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``pages`` with _text (the markup taken out), _declared, _suffix and _host, without url and html."""
    host = F.lower(F.regexp_extract(url_col, r"^[^:]*://([^/?#:]*)", 1))
    blank = lambda c: F.when(c != "", c)
    return pages.withColumns(
        {
            "_text": F.regexp_replace(html_col, _TAGS, " "),
            "_declared": blank(F.lower(F.regexp_extract(html_col, _DECLARED, 1))),
            "_host": blank(host),
            "_suffix": blank(F.regexp_extract(host, r"\.([^.]+)$", 1)),
        }
    ).drop(url_col, html_col)


def document_evidence(docs: DataFrame, text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, evidence): documents have a text and a source, which stands for the host, and no markup or address."""
    nothing = F.lit(None).cast("string")
    return docs.select(
        "doc_id", F.col(text_col).alias("_text"), nothing.alias("_declared"), nothing.alias("_suffix"),
        F.concat(F.lit("source:"), F.col(source_col)).alias("_host"),
    )


def accepted(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """The rows of ``docs`` (with the columns of documents) that language ID accepts; fits the model on them if none is given."""
    model = model or fit(docs)
    name = unused(docs, "_row")
    keyed = docs.withColumn(name, F.xxhash64("doc_id", "text", "source"))
    evidence = document_evidence(keyed.select(F.col(name).alias("doc_id"), "text", "source"))
    rejected = small(cut(identify(evidence, model).filter(~F.col("accepted")).select(F.col("doc_id").alias(name)).distinct()))
    return keyed.join(rejected, name, "left_anti").drop(name)
