"""Cutting lineage, and broadcasts behind a check of their size."""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

T = TypeVar("T")

#: Rows of at most a few dozen bytes that a checked broadcast may hold.
BROADCAST_ROWS = 1_000_000


def checkpoint_folder(spark: SparkSession) -> None:
    """The session's own folder (``spark.checkpoint.dir``); a temporary one only where none is set and all runs in one JVM."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoints-"))


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back: later jobs do not depend on lost executors."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint if the written table ``df`` has at most ``rows`` narrow rows, else ``df`` for a shuffle join."""
    return F.broadcast(df) if df.count() <= rows else df


def unused(df: DataFrame, name: str) -> str:
    """``name``, or one that begins so and is no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def share(spark: SparkSession, thing: T) -> Callable[[], T]:
    """A function for tasks that gives them ``thing``, whose attributes are plain values such as arrays and lists.

    Only the attributes are broadcast: a broadcast names classes by their module, which executors do not have, while what a
    task's function refers to is shipped by value.
    """
    kind, values = type(thing), spark.sparkContext.broadcast(vars(thing))

    def get() -> T:
        own = kind.__new__(kind)
        own.__dict__.update(values.value)
        return own

    return get
