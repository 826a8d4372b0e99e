"""Right-hand sides for lookups from a fact column that may be heavily skewed.

A lookup is left to Spark's join selection: a small right side is broadcast because its size is known, a large
one is shuffled. In the shuffled case a hot fact key is split by the adaptive skew join, which only acts when
both inputs of the sort-merge join are plain exchanges. The result of a grouping by the same key would be
joined as it lies and switch the splitting off. So a unique side hands out its key as a new value
(``own_exchange``): the join adds one narrow exchange of its own, and the hot side can be split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def own_exchange(key: str) -> Column:
    """The same text as a new column that the data is not known to be partitioned by."""
    return F.concat(F.col(key), F.lit("")).alias(key)


def lookup(df: DataFrame, key: str, *values: Column) -> DataFrame:
    """One row per non-NULL text key with aggregated ``values``, ready to be the unique side of a join on it."""
    grouped = df.filter(F.col(key).isNotNull()).groupBy(key)
    rows = grouped.agg(*values) if values else grouped.agg(F.lit(True).alias("_known"))
    return rows.select(own_exchange(key), *[c for c in rows.columns if c != key])


def known_keys(df: DataFrame, key: str, flag: str) -> DataFrame:
    """Distinct non-NULL keys with a marker column that is NULL after an unmatched left join."""
    return lookup(df, key).withColumnRenamed("_known", flag)
