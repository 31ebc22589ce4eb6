"""Run a query and its SQL side by side: ``python -m fiscalake.checks.compare FOLDER [NAME...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pyarrow as pa

from ..session import local_session
from .oracle import ORACLE
from .queries import QUERIES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _type(t: pa.DataType) -> str:
    text = str(t)
    return "timestamp" if text.startswith("timestamp") else text.removeprefix("large_")


def differences(con: duckdb.DuckDBPyConnection, got: pa.Table, sql: str) -> list[str]:
    """What differs between a result and its SQL twin, rows as a bag; empty if nothing."""
    want = con.sql(sql).to_arrow_table()
    if sorted(got.column_names) != sorted(want.column_names):
        return [f"columns {sorted(got.column_names)} != {sorted(want.column_names)}"]
    want = want.select(got.column_names)
    out = [
        f"type of {g.name}: {g.type} != {w.type}"
        for g, w in zip(got.schema, want.schema)
        if _type(g.type) != _type(w.type)
    ]
    if got.num_rows != want.num_rows:
        out.append(f"rows {got.num_rows} != {want.num_rows}")
    con.register("got_rows", got)
    con.register("want_rows", want)
    for a, b in (("got_rows", "want_rows"), ("want_rows", "got_rows")):
        extra = con.execute(f"SELECT * FROM {a} EXCEPT ALL SELECT * FROM {b} LIMIT 3").fetchall()
        if extra:
            out.append(f"only in {a}: {extra}")
    con.unregister("got_rows")
    con.unregister("want_rows")
    return out


def main() -> int:
    folder, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark, con, bad = local_session(), connect(folder), 0
    con.execute("SET TimeZone = 'UTC'")
    for name in names:
        start = time.perf_counter()
        try:
            got = QUERIES[name](spark, folder).toArrow()
            took = time.perf_counter() - start
            found = differences(con, got, ORACLE[name]) if name in ORACLE else ["no SQL"] * (got.num_rows == 0)
            print(f"{'ok ' if not found else 'BAD'} {name} {got.num_rows} rows {took:.2f}s", *found, sep="\n   ", flush=True)
        except Exception as error:  # noqa: BLE001 - the report goes on
            found = [str(error)[:1500]]
            print("ERR", name, found[0])
        bad += bool(found)
    print(f"{bad} of {len(names)} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main())
