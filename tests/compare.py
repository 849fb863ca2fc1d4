"""Run queries on Spark and their SQL answers on DuckDB and compare the rows.

    python -m tests.compare [sf] [name ...]
"""

from __future__ import annotations

import math
import sys
import tempfile
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return float(f"{v:.10g}")
    return v


KINDS = {"bigint": "i", "int": "i", "double": "f", "string": "s", "boolean": "b", "timestamp_ntz": "t", "date": "d"}
DUCK = {"BIGINT": "i", "INTEGER": "i", "DOUBLE": "f", "VARCHAR": "s", "BOOLEAN": "b", "TIMESTAMP": "t", "DATE": "d"}
EXACT = {"bigint": "BIGINT", "int": "INTEGER"}


def mismatch(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when schema and bag of rows agree, else what differs."""
    names = sorted(df.columns)
    rel = con.sql(sql)
    if sorted(rel.columns) != names:
        return f"columns {names} vs {sorted(rel.columns)}"
    want_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    for name, kind in df.dtypes:
        duck = want_types[name]
        if KINDS.get(kind, kind) != DUCK.get(duck, duck) or EXACT.get(kind, duck) != duck:
            return f"type of {name}: {kind} vs {duck}"
    got = Counter(tuple(_plain(r[n]) for n in names) for r in df.collect())
    at = [rel.columns.index(n) for n in names]
    want = Counter(tuple(_plain(r[i]) for i in at) for r in rel.fetchall())
    if got != want:
        extra, lack = list((got - want).items())[:3], list((want - got).items())[:3]
        return f"{sum(got.values())} vs {sum(want.values())} rows; only Spark {extra}; only SQL {lack}"
    return None


def main(argv: list[str]) -> int:
    from terrace.queries import ORACLES, QUERIES
    from terrace.session import build_session

    sf = argv[0] if argv else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session(
        "compare", "local[8]", **{"spark.checkpoint.dir": tempfile.mkdtemp(prefix="compare-"), "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in argv[1:] or QUERIES:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in ORACLES:
                problem = mismatch(df, con, ORACLES[name])
                n = len(con.sql(ORACLES[name]).fetchall())
            else:
                n, problem = df.count(), None
        except Exception as error:  # noqa: BLE001
            n, problem = -1, f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        mark = "ok " if problem is None else "BAD"
        print(f"{mark} {name} rows={n} {'' if name in ORACLES else '(no sql)'} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
