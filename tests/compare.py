"""Run checked queries against their DuckDB oracles.

    python -m tests.compare [sf_dir] [key ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return repr(value)


def _rows(table):
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    rows = sorted(tuple(_plain(v) for v in row) for row in zip(*columns)) if columns else []
    kinds = {n: str(table.schema.field(n).type).replace("large_string", "string") for n in names}
    return names, kinds, rows


def compare(spark, sf_dir: str, query, sql: str) -> str:
    """Empty text when both sides agree, else what differs."""
    ours = _rows(query(spark, sf_dir).toArrow())
    theirs = _rows(oracle(sf_dir).sql(sql).to_arrow_table())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} / {theirs[0]}"
    if ours[1] != theirs[1]:
        return f"types { {k: (v, theirs[1][k]) for k, v in ours[1].items() if v != theirs[1][k]} }"
    if ours[2] != theirs[2]:
        a, b = set(ours[2]), set(theirs[2])
        return (
            f"rows {len(ours[2])} / {len(theirs[2])}; only ours {sorted(a - b)[:2]}; only oracle {sorted(b - a)[:2]}"
        )
    return "" if ours[2] else "both sides empty"


def main(argv: list[str]) -> int:
    from bazaar.checks import ORACLES, QUERIES
    from bazaar.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark = local_session(cores=os.environ.get("CORES", "8"))
    bad = 0
    for name in names:
        start = time.time()
        try:
            if name in ORACLES:
                word = compare(spark, sf_dir, QUERIES[name], ORACLES[name])
            else:
                word = "" if QUERIES[name](spark, sf_dir).count() else "empty"
                word = word or "(rows only)"
        except Exception as error:  # report and go on to the next query
            word = f"{type(error).__name__}: {str(error)[:700]}"
        ok = word in ("", "(rows only)")
        bad += not ok
        print(f"{'ok ' if ok else 'BAD'} {name} {time.time() - start:.1f}s {word}", flush=True)
    print(f"{len(names) - bad}/{len(names)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
