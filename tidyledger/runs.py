"""Runs of the job: a folder each, and a manifest that makes a finished run the current one.

A run's tables lie under ``<root>/runs/<run>``. Its manifest, ``<root>/manifests/<run>.json``, names them; it is written under
another name and moved into place, which file systems do as a whole. The manifest with the greatest name is the current
one. Readers that have opened an older run keep reading it until it is dropped.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Run:
    root: str
    name: str

    @property
    def path(self) -> str:
        return f"{self.root}/runs/{self.name}"


def new_run(spark: SparkSession, root: str) -> Run:
    """A run that nothing has been written to; names ascend with time."""
    return Run(root.rstrip("/"), f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}")


def _path(spark: SparkSession, text: str):
    """(file system, path)"""
    path = spark._jvm.org.apache.hadoop.fs.Path(text)
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), path


def _manifests(spark: SparkSession, root: str) -> list[str]:
    """Names of the finished runs, oldest first."""
    fs, folder = _path(spark, f"{root.rstrip('/')}/manifests")
    if not fs.exists(folder):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    return sorted(n.removesuffix(".json") for n in names if n.endswith(".json"))


def publish(spark: SparkSession, run: Run, tables: dict[str, str]) -> None:
    """Make the run the current one. ``tables`` are paths below its folder."""
    fs, target = _path(spark, f"{run.root}/manifests/{run.name}.json")
    _, draft = _path(spark, f"{run.root}/manifests/_{run.name}.draft")
    out = fs.create(draft)
    try:
        out.write(bytearray(json.dumps({"run": run.name, "tables": tables}, indent=1).encode()))
    finally:
        out.close()
    if not fs.rename(draft, target):
        raise OSError(f"could not move {draft} to {target}")


def current(spark: SparkSession, root: str) -> Run:
    """The last finished run."""
    names = _manifests(spark, root)
    if not names:
        raise FileNotFoundError(f"no finished run in {root}")
    return Run(root.rstrip("/"), names[-1])


def table_paths(spark: SparkSession, run: Run) -> dict[str, str]:
    text = "\n".join(r[0] for r in spark.read.text(f"{run.root}/manifests/{run.name}.json", wholetext=True).collect())
    return {name: f"{run.path}/{path}" for name, path in json.loads(text)["tables"].items()}


def open_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Every table of the current run; all are of the same run, whatever is finished meanwhile."""
    return {name: spark.read.parquet(path) for name, path in table_paths(spark, current(spark, root)).items()}


def drop_old(spark: SparkSession, root: str, keep: int) -> None:
    """Delete all finished runs but the last ``keep``, the manifest first; a run without a manifest may still be written to and stays."""
    if keep < 1:
        raise ValueError("the current run is always kept")
    for name in _manifests(spark, root)[:-keep]:
        run = Run(root.rstrip("/"), name)
        for path in (f"{run.root}/manifests/{name}.json", run.path):
            fs, target = _path(spark, path)
            fs.delete(target, True)
