"""Run registered queries against their SQL: python -m checks.compare [sf_dir] [name ...]."""

from __future__ import annotations

import sys
import time
import traceback

import duckdb

from checks.oracle import ORACLE
from checks.queries import QUERIES
from lexloom import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
KINDS = {"BIGINT": "bigint", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean"}


def check_session():
    return build_session(
        "checks", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="8g"
    )


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def compare(spark, con, name: str, sf_dir: str) -> str:
    """'ok' or what differs: names, kinds of columns, or rows."""
    df = QUERIES[name](spark, sf_dir)
    names = sorted(df.columns)
    kinds = dict(df.dtypes)
    got = sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)
    if name not in ORACLE:
        return f"no SQL, {len(got)} rows"
    result = con.execute(ORACLE[name])
    columns = {d[0]: str(d[1]) for d in result.description}
    if sorted(columns) != names:
        return f"columns {sorted(columns)} <> {names}"
    wrong = {n: (kinds[n], columns[n]) for n in names if KINDS.get(columns[n], columns[n]) != kinds[n]}
    order = [list(columns).index(n) for n in names]
    want = sorted((tuple(r[i] for i in order) for r in result.fetchall()), key=repr)
    if len(got) != len(want):
        return f"{len(got)} rows <> {len(want)}; only Spark {[x for x in got if x not in set(want)][:2]}"
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ, e.g. {bad[:2]}"
    return f"kinds {wrong}" if wrong else f"ok {len(got)}"


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark, con, failed = check_session(), database(sf_dir), 0
    spark.sparkContext.setLogLevel("ERROR")
    for name in args or QUERIES:
        start = time.time()
        try:
            outcome = compare(spark, con, name, sf_dir)
        except Exception as problem:
            outcome = f"{type(problem).__name__}: {str(problem)[:600]}"
            if args:
                traceback.print_exc()
        failed += not outcome.startswith(("ok", "no SQL"))
        print(f"{time.time() - start:6.2f}s {name:32s} {outcome[:900]}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main())
