"""Repeating rows and taking a few rows per group."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Rows one task writes for one counted row before the work moves to another task.
CHUNK = 1_000_000


def repeat_rows(df: DataFrame, times: str, chunk: int = CHUNK) -> DataFrame:
    """Each row ``times`` times (0 drops it), without the column ``times``.

    A count may be in the billions, so it is cut into chunks that are spread over all tasks by a hash of
    the chunk number before the rows are written out. The partition number is explicit because the chunk
    rows are tiny and would otherwise be merged into one task.
    """
    names = [c for c in df.columns if c != times]
    n = F.col(times).cast("bigint")
    chunks = df.filter(n > 0).select(
        *df.columns, F.explode(F.sequence(F.lit(0), F.ceil(n / F.lit(chunk)).cast("int") - 1)).alias("_chunk")
    )
    size = F.least(F.lit(chunk).cast("bigint"), n - F.col("_chunk").cast("bigint") * F.lit(chunk))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = chunks.repartition(parts, *names, "_chunk")
    return spread.select(*names, F.explode(F.sequence(F.lit(1), size.cast("int"))).alias("_copy")).select(*names)


def first_per_group(df: DataFrame, group: str, order: Sequence[Column], n: int, rank: str) -> DataFrame:
    """The first ``n`` rows of each group with their rank.

    Spark limits each group on the map side before the shuffle, so at most ``n`` rows per group and task move.
    """
    position = F.row_number().over(W.partitionBy(group).orderBy(*order))
    return df.withColumn(rank, position).filter(F.col(rank) <= n)


def places_before(array: str, before: Callable[[Column], Column], bits: int = 16) -> Column:
    """How many elements at the start of a sorted array satisfy ``before``, which holds up to some place and not after it.

    A binary search folded over ``bits`` steps; the array has fewer than 2^bits elements.
    """

    def step(found: Column, bit: Column) -> Column:
        further = found + F.call_function("shiftleft", F.lit(1), bit)
        return F.when((further <= F.size(array)) & before(F.get(F.col(array), further - 1)), further).otherwise(found)

    return F.aggregate(F.sequence(F.lit(bits - 1), F.lit(0), F.lit(-1)), F.lit(0), step)
