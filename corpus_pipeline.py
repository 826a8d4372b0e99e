"""Five stages from documents to shards, each written as Parquet and read again by the next.

Every stage takes (spark, docs, sf_dir) and returns the rows it keeps with the columns of documents; the last adds slot
and shard. Stage tables go to the shared checkpoint folder of the session.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidyledger.llm import decontaminate, langid, mixing, ngram_join, sharding
from tidyledger.llm.runtime import checkpoint_folder, cut, small, unused


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that language ID rejects go: texts that no known language explains."""
    return langid.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one with the smallest id; of equal ids the one with the smallest hash.

    Rows are told apart by id and text. Those without an id come after all others, so one stays only if its group has no
    id. Of rows that agree in id and text, one stays.
    """
    key = F.struct(F.col("doc_id").isNull().alias("late"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.xxhash64("text").alias("hash"))
    name = unused(docs, "_key")
    keyed = docs.withColumn(name, key)
    slim = keyed.select(F.col(name).alias("key"), "text")  # whatever else the columns are called
    found = cut(ngram_join.near_duplicates(slim, id_col="key").select("key", "component_id"))
    gone = small(cut(found.filter("key <> component_id").select(F.col("key").alias(name)).distinct()))
    kept = keyed.join(gone, name, "left_anti")
    if found.groupBy("key").count().filter("count > 1").limit(1).count():
        kept = kept.dropDuplicates([name])
    return kept.drop(name)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go, told apart by id and text: also without an id, and no others of the same id."""
    name = unused(docs, "_row")
    keyed = docs.withColumn(name, F.xxhash64("doc_id", "text"))
    return decontaminate.clean(keyed, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col=name).drop(name)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target asks."""
    return mixing.mix(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its slot and shard."""
    return sharding.shard(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("mixing", mixture),
    ("sharding", shards),
]

#: Language ID, near duplicates and decontamination are not expressible in SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over documents."""
    checkpoint_folder(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            path = f"{folder}/{number}-{name}"
            docs.write.mode("overwrite").parquet(path)
            docs = spark.read.parquet(path)
    return docs
