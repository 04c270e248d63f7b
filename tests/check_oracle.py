"""Compare named queries with their SQL. Usage: check_oracle.py SF_DIR [name ...]"""

from __future__ import annotations

import pathlib
import sys
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from pairloom.session import local_session  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in pathlib.Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if value is None:
        return "\0null"
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(df, con, sql) -> str | None:
    """None if equal, else what differs."""
    got = df.collect()
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    want = result.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    ours, theirs = rows_of(df.columns, got), rows_of(names, want)
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"first difference {str(a)[:600]}\n     != {str(b)[:600]}"
    return None


def main() -> None:
    sf_dir, *names = sys.argv[1:]
    spark = local_session("oracle")
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if names and name not in names:
            continue
        begin = time.time()
        try:
            if name in oracle:
                verdict = compare(run(spark, sf_dir), con, oracle[name]) or "ok"
            else:
                verdict = f"rows only: {len(run(spark, sf_dir).collect())}"
        except Exception as error:  # noqa: BLE001
            verdict = f"ERROR {type(error).__name__} {str(error)[:900]}"
        bad += verdict != "ok" and not verdict.startswith("rows only")
        print(f"{name:22} {time.time() - begin:6.2f}s {verdict}", flush=True)
    print("bad:", bad)
    spark.stop()


if __name__ == "__main__":
    main()
