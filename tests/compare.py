"""Compares every registered query with its SQL counterpart in DuckDB."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
# Spark type -> DuckDB types it may be compared with.
SAME = {"int": {"INTEGER"}, "bigint": {"BIGINT"}, "double": {"DOUBLE"}, "string": {"VARCHAR"},
        "boolean": {"BOOLEAN"}, "date": {"DATE"}, "timestamp": {"TIMESTAMP"}}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, float):
        return repr(v + 0.0)
    return str(v)


def difference(df, con, sql) -> str | None:
    """None when both results have the same columns, types and rows, else what differs."""
    got_types = {f.name: f.dataType.simpleString() for f in df.schema}
    rel = con.sql(sql)
    want_types = dict(zip(rel.columns, (str(t) for t in rel.types)))
    if sorted(got_types) != sorted(want_types):
        return f"columns {sorted(got_types)} != {sorted(want_types)}"
    wrong = [f"{c}: {t} / {want_types[c]}" for c, t in got_types.items()
             if want_types[c] not in SAME.get(t, {t})]
    names = sorted(got_types)
    got = sorted(tuple(cell(r[c]) for c in names) for r in df.collect())
    pos = [rel.columns.index(c) for c in names]
    want = sorted(tuple(cell(r[i]) for i in pos) for r in rel.fetchall())
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ, columns {names}: {bad[0]}"
    return "types " + "; ".join(wrong) if wrong else None


if __name__ == "__main__":
    from cinestrata.session import local_session
    import __spark_entry__ as e

    sf = sys.argv[1]
    only = sys.argv[2:]
    spark = local_session(8)
    con = connect(sf)
    queries, oracles = e.queries(), e.oracle_sql()
    failed = 0
    for name, job in queries.items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            df = job(spark, sf)
            if name in oracles:
                why = difference(df, con, oracles[name])
                note = "ok" if why is None else "DIFF " + why
            else:
                note = f"rows only: {len(df.collect())}"
        except Exception as err:
            note = "ERROR " + str(err)[:1500]
        failed += note.startswith(("DIFF", "ERROR"))
        print(f"{name:28s} {time.time() - start:6.2f}s {note}", flush=True)
    print("failed:", failed)
