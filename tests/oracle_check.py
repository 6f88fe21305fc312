"""Run registered queries and their SQL twins side by side: python tests/oracle_check.py <folder> [names]."""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return float(f"{value:.12g}")
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, _plain(v)) for k, v in value.items()))
    if hasattr(value, "asDict"):
        return _plain(value.asDict())
    return value


def normal(columns: list[str], rows) -> tuple[list[str], list[str]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(repr(tuple(_plain(r[i]) for i in order)) for r in rows)


def compare(spark_df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    got_cols, got = normal(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    want_cols, want = normal([d[0] for d in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    if got != want:
        odd = [(g, w) for g, w in zip(got, want) if g != w]
        return f"{len(odd)} rows differ, first {odd[0][0]} != {odd[0][1]}"
    return None


def main() -> int:
    import __spark_entry__ as entry
    from fareloom.workspace import local_session

    sf_dir = sys.argv[1]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sql = entry.oracle_sql()
    names = sys.argv[2:] or list(entry.queries())
    bad = 0
    for name in names:
        started = time.time()
        try:
            df = entry.queries()[name](spark, sf_dir)
            if name in sql:
                problem = compare(df, con, sql[name])
                note = "ok" if problem is None else f"DIFF {problem}"
            else:
                problem, note = None, f"rows {df.count()}"
        except Exception as exc:  # noqa: BLE001
            problem, note = exc, f"FAIL {str(exc)[:1500]}"
        bad += problem is not None
        print(f"@@ {name:34s} {time.time() - started:6.2f}s {note}", flush=True)
    print(f"@@ {len(names)} queries, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main())
