"""Labelled rows: which may be learned from, and a bounded sample of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidyledger.llm.runtime import cut


def held_out(id_col: str, folds: int, fold: int) -> Column:
    """Whether the CRC-32 of the id's text, modulo ``folds``, is ``fold``. A NULL id is held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold, F.lit(True))


def training_labels(labels: DataFrame, label_col: str, folds: int, fold: int, rows: int, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, label) of about ``rows`` documents outside the held-out fold, chosen by a hash of the id.

    A document labelled both ways, or with NULL, is left out; a label that is repeated counts once.
    """
    known = labels.filter(F.col(label_col).isNotNull()).filter(~held_out(id_col, folds, fold))
    once = known.groupBy(F.col(id_col).alias("doc_id")).agg(F.min(label_col).alias("label"), F.max(label_col).alias("most"))
    once = cut(once.filter("label = most and label in (0, 1)").select("doc_id", F.col("label").cast("int").alias("label")))
    # the smaller class is kept whole as far as half of the bound reaches
    counts = {r[0]: r[1] for r in once.groupBy("label").count().collect()}
    few = min(counts.values(), default=0)
    quota = {label: max(rows // 2, rows - few) for label in counts}
    share = F.lit(1.0)
    for label, n in counts.items():
        share = F.when(F.col("label") == label, F.lit(min(1.0, quota[label] / n))).otherwise(share)
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    return once.filter(draw < share)
