"""Writers. Every write replaces its target, so a rerun gives the same tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Write Parquet and read it back: later steps start from files, not from the plan that made them."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, also when there are no rows; cells keep their spaces. Lists are joined with ``; ``."""
    flat = [
        F.array_join(f.name, "; ").alias(f.name) if isinstance(f.dataType, T.ArrayType) else F.col(f.name)
        for f in df.schema.fields
    ]
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.select(*flat).write.mode("overwrite").options(header=True, escape='"', **keep).csv(path)
