"""Compare a Spark result with a DuckDB statement over the same Parquet tables."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)

_KINDS = {"VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int", "TIMESTAMP": "timestamp_ntz"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def differences(df, con, sql: str) -> list[str]:
    """Names, types and the multiset of rows; an empty list means equal."""
    result = con.execute(sql)
    described = {d[0]: str(d[1]) for d in result.description}
    want_types = {n: _KINDS.get(t, t.lower()) for n, t in described.items()}
    got_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    if want_types != got_types:
        return [f"schema: spark {got_types}, duckdb {want_types}"]
    names = sorted(described)
    place = {n: i for i, n in enumerate(described)}
    want = Counter(tuple(row[place[n]] for n in names) for row in result.fetchall())
    got = Counter(tuple(row[n] for n in names) for row in df.select(*names).collect())
    if want == got:
        return []
    only_spark, only_duck = list((got - want).items())[:3], list((want - got).items())[:3]
    return [f"{sum(got.values())} rows against {sum(want.values())}", f"only spark {only_spark}", f"only duckdb {only_duck}"]
