"""Compare registered queries with their check SQL on one data folder.

usage: python tools/check_queries.py DATA_DIR [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tillstone.queries import load_all  # noqa: E402
from tillstone.session import build_session  # noqa: E402
from tillstone.sources.tables import TABLES  # noqa: E402


def canonical(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    columns = []
    for name in frame.columns:
        column = frame[name]
        if str(column.dtype).startswith("datetime"):
            column = column.astype("datetime64[us]")
        columns.append([None if pd.isna(v) is True else str(v) for v in column.astype(object)])
    return sorted(zip(*columns), key=str)


def oracle(data_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{data_dir}/{table}.parquet')")
    return connection


def main() -> int:
    data_dir, names = sys.argv[1], sys.argv[2:]
    queries, checks = load_all()
    spark = build_session("check", "local[8]")
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle(data_dir)
    failed = 0
    for name in names or queries:
        started = time.time()
        try:
            result = queries[name](spark, data_dir).toArrow()
        except Exception as error:
            failed += 1
            print(f"ERROR {name}: {str(error)[:700]}")
            continue
        seconds = time.time() - started
        if name not in checks:
            print(f"rows  {name}: {result.num_rows} rows, {seconds:.1f}s")
            continue
        try:
            expected = connection.execute(checks[name]).to_arrow_table()
        except Exception as error:
            failed += 1
            print(f"SQLERR {name}: {str(error)[:700]}")
            continue
        got_types = {f.name: str(f.type) for f in result.schema}
        want_types = {f.name: str(f.type) for f in expected.schema}
        if sorted(got_types) != sorted(want_types):
            failed += 1
            print(f"COLUMNS {name}: {set(got_types) ^ set(want_types)}")
            continue
        kinds = {n: (got_types[n], want_types[n]) for n in got_types if got_types[n] != want_types[n]}
        got, want = canonical(result.to_pandas()), canonical(expected.to_pandas())
        if got == want:
            print(f"ok    {name}: {len(got)} rows, {seconds:.1f}s {kinds or ''}")
        else:
            failed += 1
            print(f"DIFF  {name}: {len(got)} vs {len(want)} rows {kinds or ''}")
            extra, missing = set(got) - set(want), set(want) - set(got)
            for label, rows in (("spark", extra), ("sql", missing)):
                for row in sorted(rows, key=str)[:2]:
                    print("   ", label, dict(zip(sorted(got_types), row)))
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
