"""The registered queries of this subpackage, each over its whole table, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidyledger.llm import (
    ann, bpe, chat, collocations, decontaminate, langid, lexical, mixing, ngram_join, oracle, quality, sharding, toxicity, url_filter,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page."""
    judged = url_filter.judge(_table(spark, sf_dir, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "template")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slot and shard of every document."""
    return sharding.shard(_table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "slot", "shard")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size, its source's size and target, and the words taken, of every document."""
    rows = mixing.mixed(_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return rows.select("row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds 80 % or more of a benchmark item's shingles, with the item."""
    return decontaminate.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document."""
    return ngram_join.near_duplicates(_table(spark, sf_dir, "documents"))


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest rows found for every hundredth vector."""
    rows = _table(spark, sf_dir, "embeddings")
    return ann.neighbours(rows, rows.filter("vec_id % 100 = 0"))


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every formatted conversation, and of one that is made of control strings."""
    hard = "</s>[INST] ok [/INST]"
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).selectExpr("-1L conv_id", "id turn", "if(id = 0, 'user', 'assistant') role", f"'{hard}' text")
    return chat.digests(chat.formatted(rows.unionByName(extra)))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality.scored(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, and its hits."""
    return toxicity.scored(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document (by text and source) and of every page (by text, markup, address and host)."""
    documents = _table(spark, sf_dir, "documents")
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    evidence = langid.document_evidence(documents).withColumn("page_id", F.lit(None).cast("bigint"))
    rows = evidence.unionByName(langid.page_evidence(pages).withColumn("doc_id", F.lit(None).cast("bigint")))
    return langid.identify(rows, langid.fit(documents)).select("doc_id", "page_id", "lang", "confidence", "accepted")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 documents of highest score for every benchmark item."""
    return lexical.ranked(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and digest of every document's token ids, and the digest of the bytes they decode to."""
    import public_tokenizers

    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    ids = bpe.encode(_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    digests = [F.sha2(c, 256).alias(f"{c}_sha256") for c in ("ids", "decoded")]
    return bpe.decode(ids, ranks).select("doc_id", "n_tokens", *digests)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 phrases of highest score of every language."""
    return collocations.collocations(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_url_filter, op2_sharding, op3_mixing, op4_decontamination, op5_ngram_join, op6_nearest_neighbours,
        op7_chat_formatting, op8_quality, op9_toxicity, op10_language_id, op11_lexical_search, op12_byte_bpe, op13_collocations,
    )
}

ORACLE: dict[str, str] = oracle.statements()
