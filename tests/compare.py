"""Run registered queries in Spark and their SQL in DuckDB and compare.

    python tests/compare.py [sf_dir] [key ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()

KINDS = {
    "BIGINT": "int", "INTEGER": "int", "HUGEINT": "huge", "DOUBLE": "float", "VARCHAR": "str", "BOOLEAN": "bool",
    "bigint": "int", "int": "int", "double": "float", "string": "str", "boolean": "bool",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _norm(value):
    if isinstance(value, float):
        return "nan" if value != value else f"{value + 0.0:.6f}"
    return str(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([names[i] for i in order]), sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(df, con, sql) -> str | None:
    """None when equal, else what differs."""
    got_names, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want_names, want = _rows(names, cur.fetchall())
    if got_names != want_names:
        return f"columns {got_names} / {want_names}"
    kinds = {f.name: KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    their = {d[0]: KINDS.get(str(d[1]), str(d[1])) for d in cur.description}
    if kinds != their:
        return "types " + str({k: (kinds[k], their[k]) for k in kinds if kinds[k] != their[k]})
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}"
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None


def main() -> int:
    from sessions import make_session

    from reviewloom.catalog import ORACLES, QUERIES

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or list(QUERIES)
    spark = make_session()
    con = connect(sf_dir)
    failed = 0
    for key in keys:
        start = time.time()
        try:
            df = QUERIES[key](spark, sf_dir)
            if key in ORACLES:
                problem = compare(df, con, ORACLES[key])
                note = "ok" if problem is None else f"FAIL {problem}"
            else:
                rows = df.collect()
                problem, note = None, f"rows {len(rows)} {str(rows[:2])[:300]}"
        except Exception as error:  # report and go on with the next query
            problem, note = "error", f"ERROR {str(error)[:600]}"
        failed += problem is not None
        print(f"{key:32s} {time.time() - start:6.2f}s {note}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
