"""Mixing sources to target weights by repetition rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidyledger.llm.runtime import cut, small

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
SEED = "mix"


def words(text: Column) -> Column:
    """The number of runs of bytes other than space and \\t \\n \\v \\f \\r; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def draw(id_col: str, text_col: str, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on the id and the seed alone: 52 bits of their MD5. A row without an id goes by its
    text, so that such rows are drawn apart; without both, by ''."""
    own = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("text:"), F.md5(F.col(text_col).cast("binary"))), F.lit(""))
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), own)), 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def _numbered(sources: DataFrame) -> DataFrame:
    """``sources`` with ``position`` from 0: by code point, NULL last.

    Sources are dealt into ranges; a range's first position is the sum of the sizes of those before it, so no task
    sees more than its range and the one row per range.
    """
    ranged = cut(sources.repartitionByRange(F.col("source").isNull(), "source").withColumn("range", F.spark_partition_id()))
    sizes = ranged.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    before = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    firsts = sizes.select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = F.row_number().over(W.partitionBy("range").orderBy(F.col("source").isNull(), "source"))
    return ranged.withColumn("within", within).join(firsts, "range").select(
        "source", "source_size", (F.col("first") + F.col("within") - 1).alias("position")
    )


def targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """(source, source_size, target, rate) from one row per source (source, source_size).

    The sources, by code point with NULL last, weigh ``weights`` in turn. Together they get ``share`` times all sizes,
    split by weight; a target stops at ``most`` times its source's size and the excess goes to the others by weight until
    none is above. A source without words gets target and rate 0. The loop brings three sums per round to the driver.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("position") % len(weights)).cast("int") + 1)
    rows = cut(_numbered(sizes).select("source", "source_size", weight.alias("weight")))
    limit = F.col("source_size") * F.lit(float(most))
    per_weight, capped = None, F.lit(False)
    while True:  # each round caps at least one more source, so it ends
        free = F.when(~capped, F.col("weight"))
        total, stuck, left = rows.agg(
            F.sum("source_size"), F.sum(F.when(capped, limit)), F.sum(free)
        ).first()
        if not left:
            break
        step = (share * (total or 0) - (stuck or 0.0)) / left
        if step == per_weight:
            break
        per_weight, capped = step, F.col("weight") * F.lit(step) > limit
    target = F.least(F.col("weight") * F.lit(float(per_weight or 0.0)), limit)
    rate = F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(F.lit(0.0))
    return rows.select("source", "source_size", target.alias("target"), rate.alias("rate"))


def mixed(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: str = SEED,
) -> DataFrame:
    """(row, size, source_size, target, copies): every row of ``docs`` as a struct, whatever its columns are called.

    copies is floor(rate) plus one if the row's draw falls below the rate's fraction, so it is never above ``most``
    where that is whole, and reruns agree. Rows with equal ids get equal copies, and so do rows without an id that have equal
    texts. A NULL or empty text has size 0; a NULL source is a source of its own, after all others. An empty table gives
    an empty result.
    """
    name = lambda c: F.col(f"`{c}`")
    sized = docs.select(
        F.struct(*map(name, docs.columns)).alias("row"), name(id_col).alias("id"), name(text_col).alias("text"),
        name(source_col).alias("of"), words(name(text_col)).alias("size"),
    )
    sums = sized.groupBy(F.col("of").alias("source")).agg(F.sum("size").alias("source_size"))
    plan = small(cut(targets(sums, weights, share, most)))
    rows = sized.join(plan, F.col("of").eqNullSafe(F.col("source")))
    whole = F.floor("rate")
    copies = whole + (draw("id", "text", seed) < F.col("rate") - whole).cast("bigint")
    return rows.select("row", "size", "source_size", "target", copies.alias("copies"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: the rows of ``docs``, each as often as ``mixed`` says. Columns as in ``docs``."""
    rows = mixed(docs, **options).filter("copies > 0")
    return rows.select("row", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))).select("row.*")
