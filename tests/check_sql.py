"""Run the queries against their SQL: python tests/check_sql.py [folder] [name ...]"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from orelode.session import local_session  # noqa: E402


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def normal(value: object) -> object:
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def rows_by_name(names: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def differences(spark_df, con, sql: str) -> str:
    """'' if both give the same columns and rows."""
    mine = rows_by_name(spark_df.columns, spark_df.collect())
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    other = rows_by_name(names, result.fetchall())
    if len(mine) != len(other):
        return f"{len(mine)} rows != {len(other)}"
    for a, b in zip(mine, other):
        if a != b:
            return f"{sum(x != y for x, y in zip(mine, other))} rows differ, first {a} != {b}"
        if [type(v) for v in a] != [type(v) for v in b]:
            return f"types differ: {a} {b}"
    return ""


def main() -> None:
    from __spark_entry__ import oracle_sql, queries

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = local_session("check-sql", 8), connect(folder)
    oracles, failed = oracle_sql(), []
    for name, query in queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            df = query(spark, folder)
            note = differences(df, con, oracles[name]) if name in oracles else f"rows only: {df.count()}"
        except Exception as e:  # noqa: BLE001 - the list goes on
            note = f"ERROR {type(e).__name__}: {str(e)[:300]}"
        good = not note or note.startswith("rows only")
        failed += [] if good else [name]
        print(f"{'ok  ' if good else 'FAIL'} {name} {time.time() - start:.1f}s {note}", flush=True)
    print(f"{len(failed)} failed: {failed}")
    sys.exit(bool(failed))


if __name__ == "__main__":
    main()
