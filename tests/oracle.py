"""Compare registered queries with DuckDB: python -m tests.oracle [-s sf] name..."""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# ORACLE_STRICT=1 compares doubles bit by bit.
STRICT = os.environ.get("ORACLE_STRICT") == "1"


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _norm(value):
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return value + 0.0 if STRICT else float(f"{value:.9g}") + 0.0
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(_norm(v) for v in value)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=lambda r: tuple((v is not None, type(v).__name__, v) for v in r))


def compare(spark, con, query, sf_dir) -> tuple[bool, str]:
    t0 = time.time()
    df = query.run(spark, sf_dir)
    got_cols, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    t1 = time.time()
    note = f"{len(got)} rows {t1 - t0:.1f}s"
    if query.oracle is None:
        return True, note + " (no oracle)"
    cur = con.execute(query.oracle)
    want_cols, want = _rows([d[0] for d in cur.description], cur.fetchall())
    note += f" duck {time.time() - t1:.1f}s"
    if got_cols != want_cols:
        return False, f"{note} columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        only_g = [r for r in got[:2000] if r not in set(want)][:2]
        only_w = [r for r in want[:2000] if r not in set(got)][:2]
        return False, f"{note} rows {len(got)} != {len(want)}\n   spark {only_g}\n   duck  {only_w}"
    bad = [(g, w) for g, w in zip(got, want) if g != w or [type(v) for v in g] != [type(v) for v in w]]
    if bad:
        lines = "\n".join(f"   spark {g}\n   duck  {w}" for g, w in bad[:3])
        return False, f"{note} {len(bad)} rows differ\n{got_cols}\n{lines}"
    return True, note


def main(argv: list[str]) -> int:
    from millrace.plans import load_all
    from millrace.session import get_session

    sf = "0.01"
    if argv[:1] == ["-s"]:
        sf, argv = argv[1], argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    queries = load_all()
    names = [n for n in queries if not argv or any(a == n or (a.endswith("*") and n.startswith(a[:-1])) for a in argv)
             or any(queries[n].run.__module__.endswith("." + a) for a in argv)]
    spark = get_session("oracle", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                        spark__driver__memory="8g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    failed = 0
    for name in names:
        try:
            ok, note = compare(spark, con, queries[name], sf_dir)
        except Exception as err:  # report and go on to the next query
            ok, note = False, f"{type(err).__name__}: {str(err)[:1500]}"
        failed += not ok
        print(("ok   " if ok else "FAIL ") + name, note, flush=True)
    print(f"{len(names) - failed}/{len(names)} ok")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
