"""Duplicate handling in source order.

No operator here sorts or windows a duplicate group. A group's first row is found by an aggregate, which
combines on the map side, so a group that holds a third of the table costs one partial row per task. Rows are
then kept or flagged by joining on ``source_row``, which is unique, so the join has no hot key. Rows after the first are
found by joining the few keys that repeat, with their first position, to the rows: that side is broadcast when it is
small, and otherwise a hot key is split by the adaptive skew join. NULL keys compare equal, as in any Spark grouping.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidyledger.schemas import SOURCE_ROW


def exact_kept(df: DataFrame, order_col: str = SOURCE_ROW) -> DataFrame:
    """One row per distinct content, the first in source order. ``order_col`` is not part of the content."""
    content = [c for c in df.columns if c != order_col]
    return df.groupBy(*content).agg(F.min(order_col).alias(order_col)).select(*df.columns)


def exact_dropped(df: DataFrame, order_col: str = SOURCE_ROW) -> DataFrame:
    """The rows ``exact_kept`` leaves out."""
    return key_losers(df, [c for c in df.columns if c != order_col], order_col)


def key_winners(df: DataFrame, keys: Sequence[str], order_col: str = SOURCE_ROW) -> DataFrame:
    """One row per key, the first in source order. The result stays partitioned by the keys."""
    first = F.min_by(F.struct(*df.columns), F.col(order_col))
    rows = df.groupBy(*keys).agg(first.alias("_first"))
    return rows.select(*[F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns])


def key_losers(df: DataFrame, keys: Sequence[str], order_col: str = SOURCE_ROW) -> DataFrame:
    """Every row after the first of its key."""
    counted = df.groupBy(*keys).agg(F.min(order_col).alias("_first"), F.count(F.lit(1)).alias("_rows"))
    repeated = counted.filter("_rows > 1").select(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)], "_first")
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_key_{i}")) for i, k in enumerate(keys)])
    return df.join(repeated, same).filter(F.col(order_col) > F.col("_first")).select(*df.columns)


def mark_soft_duplicates(
    df: DataFrame,
    keys: Sequence[str],
    flag_col: str = "duplicate_resolution_flag",
    order_col: str = SOURCE_ROW,
    row_id: str | None = None,
) -> DataFrame:
    """Flag rows that repeat all key values of an earlier row; a row with a NULL key is never flagged.

    ``row_id`` names a unique, non-NULL column to join on. It defaults to ``order_col``; pass the column ``df``
    is already partitioned by to leave the wide side in place.
    """
    row_id = row_id or order_col
    complete = F.lit(True)
    for k in keys:
        complete = complete & F.col(k).isNotNull()
    first = F.min(order_col) if row_id == order_col else F.min_by(row_id, order_col)
    firsts = (
        df.filter(complete)
        .groupBy(*keys)
        .agg(first.alias(row_id))
        .select(row_id, F.lit(True).alias("_is_first"))
    )
    return (
        df.join(firsts, row_id, "left")
        .withColumn(flag_col, complete & F.col("_is_first").isNull())
        .select(*df.columns, flag_col)
    )
